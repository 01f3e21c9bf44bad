import datetime as dt

from pyspark.sql import functions as F

from tallymark.operators import health as H
from tallymark.operators import rules as U
from tallymark.operators.asof import as_of_join

D = dt.date


def test_found_status(spark):
    rows = {
        ("home", True, "anything", None, False): "accepted", ("blank", False, None, None, False): "pending", ("filler", False, "Unknown affiliation", None, False): "pending", ("young", False, "PhD candidate, Oak University", None, True): "rejected",
        ("field", False, "Oncology, Oak University", None, True): "rejected", ("many", False, "Oak University", 4.1, True): "rejected", ("few", False, "Oak University", 0.1, True): "rejected", ("tracked", False, "Oak University", 1.0, True): "pending",
        ("role", False, "Professor of housing", None, False): "pending", ("other", False, "Elm University", 1.0, False): "rejected",
    }
    df = spark.createDataFrame(list(rows), "k string, home boolean, text string, ratio double, tracked boolean")
    got = {r.k: r.s for r in df.select("k", U.found_status(F.col("home"), F.col("text"), F.col("ratio"), F.col("tracked")).alias("s")).collect()}
    assert got == {k[0]: v for k, v in rows.items()}


def test_decide_found(spark):
    rows = [
        (1, "accepted", 0.9, 0.95), (1, "pending", 0.7, 0.9), (1, "rejected", 0.89, 0.9),  # clear
        (2, "accepted", 0.9, 0.95), (2, "pending", 0.8, 0.9),  # too close
        (3, "accepted", 0.95, 0.95), (3, "accepted", 0.9, 0.95),  # two
        (4, "rejected", 0.9, 0.9), (5, "accepted", 0.9, 0.8), (None, "accepted", 0.99, 0.99),
    ]
    out = U.decide_found(spark.createDataFrame(rows, "p int, status string, score double, name_sim double"), "p").collect()
    assert {r.p: r.outcome for r in out if r.p} == {1: "accepted", 2: "pending", 3: "pending", 4: "rejected", 5: "pending"}
    assert sorted(r.status for r in out if r.p in (2, 3, 5)) == ["pending"] * 5 and len(out) == len(rows)


def test_apply_and_reclassify(spark):
    people = spark.createDataFrame([(1, None), (2, "x"), (3, "c"), (4, "d")], "person_id int, sid string")
    queue = spark.createDataFrame([(1, "a", "accepted", "auto"), (2, "b", "accepted", "auto"), (3, "c", "accepted", "auto"), (4, "e", "accepted", "auto"), (4, "f", "accepted", "who"), (1, "z", "rejected", "who"), (5, None, "pending", None)], "person_id int, external_id string, status string, reviewed_by string")
    assert {r.person_id: (r.sid, r.outcome) for r in U.apply_accepted(people, queue, "sid").collect()} == {1: ("a", "written"), 2: ("b", "written"), 3: ("c", "kept"), 4: ("d", "contested")}
    out = {(r.person_id, r.external_id): (r.new_status, r.is_changed, r.new_reviewed_by) for r in U.reclassify(queue, F.lit("pending"), "auto").collect()}
    assert out[1, "a"] == ("pending", True, None) and out[1, "z"] == ("rejected", False, "who") and out[5, None] == ("rejected", True, "auto") and out[4, "f"] == ("accepted", False, "who")


def test_topic_share_and_rank_text(spark):
    df = spark.createDataFrame([([("Urban Studies", 3), ("Optics", 1)],), ([],), (None,), ([(None, None)],)], "t array<struct<label: string, n: bigint>>")
    assert [r.s for r in df.select(U.topic_share(F.col("t")).alias("s")).collect()] == [0.75, 0.5, 0.5, 0.0]
    texts = {"Assoc. Professor, Oak": "associate", "Asst prof at Elm": "assistant", "Professor of maps": "full", "Research assistant to a professor": "other", "": "other"}
    got = {r.t: r.k for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", U.rank_from_text(F.col("t"), F.lit("other")).alias("k")).collect()}
    assert got == texts


def test_roster_actions(spark):
    post = lambda k, text, email=None, rank="associate", cites=500, years=20: (k, 1, rank, text, email, cites, years)
    rows = [
        post("young", "PhD student at Elm", "elm.edu"), post("thin", "Elm University", "elm.edu", cites=3), post("field", "Medicine, Elm University"), post("home", "Professor, Oak University"), post("stay", "Associate Professor, Oak University", "elm.edu"),
        post("campus", "Oak University Tacoma", "elm.edu"), post("move", "Elm University"), post("two", "Elm University and Ash College"), post("mail", "", "elm.edu"), post("leave", "Yew University", "yew.edu"), post("quiet", "Yew University", "oak.edu"), post("none", None, None),
    ]
    profiles = spark.createDataFrame(rows, "profile_id string, department_id int, rank_name string, text string, email string, cites int, years int")
    hits = spark.createDataFrame([("young", 2), ("thin", 2), ("home", 1), ("stay", 1), ("campus", 1), ("move", 2), ("two", 2), ("two", 3)], "profile_id string, department_id int")
    homes = spark.createDataFrame([(1, "oak.edu"), (2, "elm.edu")], "department_id int, domain string")
    owners = homes.select("domain", "department_id")
    got = {r.profile_id: (r.action, r.to_department) for r in U.roster_actions(profiles, hits, homes, owners).collect()}
    assert got == {
        "young": (None, None), "thin": ("wrong", None), "field": ("wrong", None), "home": ("promote", 1), "stay": (None, None), "campus": ("depart", None), "move": ("move", 2), "two": (None, None), "mail": ("move", 2),
        "leave": ("depart", None), "quiet": (None, None), "none": (None, None),
    }


def test_rank_review(spark):
    cols = "affiliation_id int, person_id int, department_id int, rank_name string, appointment_type string, is_primary int, start_day date, end_day date, source string"
    rows = [(i, i, 7, "assistant", "regular", 1, D(2015, 1, 1), D(2020, 1, 1) if i == 5 else None, "s") for i in range(1, 8)]
    told = [(1, "assistant", None), (2, "associate", D(2022, 1, 1)), (3, "emeritus", None), (4, "left the program", D(2023, 5, 1)), (5, "full", None), (6, "riddle", None)]
    decisions = spark.createDataFrame([(a, c, s, D(2026, 10, 1), "who") for a, c, s in told] + [(2, "full", None, D(2026, 9, 1), "who"), (7, None, None, None, None)], "affiliation_id int, decision string, since date, decided_on date, reviewer string")
    out = U.apply_rank_review(spark.createDataFrame(rows, cols), decisions).collect()
    kept = {r.affiliation_id: (r.outcome, r.end_day) for r in out if not r.is_new}
    assert kept == {1: ("verified", None), 2: ("rank", D(2022, 1, 1)), 3: ("type", D(2026, 10, 1)), 4: ("left", D(2023, 5, 1)), 5: ("skipped", D(2020, 1, 1)), 6: ("unknown", D(2026, 10, 1)), 7: (None, None)}
    assert {(r.affiliation_id, r.person_id, r.rank_name, r.appointment_type, r.start_day) for r in out if r.is_new} == {(8, 2, "associate", "regular", D(2022, 1, 1)), (9, 3, "assistant", "emeritus", D(2026, 10, 1))}


RUNS = "source string, started_at timestamp, day date, n_ok int, n_bad int, n_dead int, n_tried int, is_targeted boolean, is_stopped boolean"


def run(spark, day, ok, bad, dead=0, tried=None, targeted=False, stopped=False):
    return spark.createDataFrame([("s", dt.datetime(day.year, day.month, day.day), day, ok, bad, dead, tried, targeted, stopped)], RUNS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_run_rules(spark):
    day = F.to_date(F.lit("2026-11-20"))
    due = F.to_date(F.lit("2026-11-16"))
    assert rows(H.overdue(run(spark, D(2026, 11, 9), 50, 0), "r", "s", due, day)) == [("r", "2026-11-09", 1, True)]
    assert rows(H.overdue(run(spark, D(2026, 11, 16), 50, 0), "r", "s", due, day)) == []
    assert rows(H.overdue(run(spark, D(2026, 11, 17), 2, 0), "r", "s", due, day)) == [("r", "never", 1, True)]  # a repair is no collection
    assert rows(H.overdue(run(spark, D(2026, 11, 9), 50, 0), "r", "s", due, due)) == []
    assert rows(H.short_run(run(spark, D(2026, 11, 9), 40, 2, tried=50), "s")) == [("short-run", "2026-11-09", 10, True)]
    assert rows(H.short_run(run(spark, D(2026, 11, 9), 45, 5, dead=5, tried=50), "s")) == []
    assert rows(H.short_run(run(spark, D(2026, 11, 9), 97, 3), "s")) == [("short-run", "2026-11-09", 3, True)]
    assert rows(H.incomplete(run(spark, D(2026, 11, 1), 1000, 5), "s")) == [] and rows(H.incomplete(run(spark, D(2026, 11, 1), 900, 6), "s")) == [("incomplete", "2026-11-01", 6, True)]
    assert rows(H.incomplete(run(spark, D(2026, 11, 1), 900, 0, stopped=True), "s")) == [("incomplete", "2026-11-01", 0, True)] and rows(H.incomplete(run(spark, D(2026, 11, 1), 900, 9, targeted=True), "s")) == []


def test_figure_and_report_rules(spark):
    day = F.to_date(F.lit("2026-11-22"))
    make = lambda data, schema: spark.createDataFrame(data, schema)
    figures = "person_id int, cites int, works int, h int"
    inside = make([(1, 30, 4, 3), (1, 30, 4, 3), (1, 5, 1, 1), (1, 5, 1, 1)], figures)
    across = make([(1, 60, 4, 3), (2, 60, 4, 3), (3, 10, 1, 1), (4, 10, 1, 1)], figures)
    assert rows(H.repeated_records(inside, across, F.lit("e"))) == [("repeated-records", "e", 2, True)]
    assert rows(H.dead_ids(make([(1, "a"), (2, "b")], "person_id int, id string"), make([("a", "2026-01-02"), ("z", "2026-01-03")], "id string, day string"))) == [("dead-ids", "2026-01-02", 1, False)]
    assert rows(H.withdrawals(make([(1, D(2026, 11, 8)), (2, D(2026, 11, 7)), (3, D(2026, 11, 23))], "person_id int, day date"), day)) == [("audit-withdrawals", "2026-11-08", 1, True)]
    flags = make([(1, "drop", "x"), (1, "field", "y")], "person_id int, kind string, which string")
    assert rows(H.profile_flags(flags))[0][2:] == (1, False) and rows(H.profile_flags(flags)) != rows(H.profile_flags(flags.limit(1)))
    assert rows(H.empty_batch(make([(D(2026, 11, 20), 10, 8), (D(2026, 11, 21), 5, 5), (D(2026, 11, 1), 9, 9)], "day date, searched int, empty int"), day)) == [("empty-batch", "2026-11-20", 8, True)]
    status = make([("a", dt.datetime(2026, 11, 10), None), ("b", dt.datetime(2026, 11, 20), D(2026, 11, 2)), ("c", dt.datetime(2026, 11, 20), None), ("d", None, None)], "stream string, reported timestamp, stalled_since date")
    assert sorted(rows(H.silent_or_stalled(status, F.lit(3), day))) == [("silent", "a 2026-11-10", 3, True), ("silent", "d never", 3, True), ("stalled", "b 2026-11-02", 3, True)]
    assert rows(H.silent_or_stalled(status, F.lit(0), day)) == []
    last = make([(D(2026, 11, 16),)], "day date")
    quota = lambda left, d: rows(H.quota(make([(left,)], "n_left int"), last, F.to_date(F.lit(d)), 50))
    assert quota(12, "2026-11-22") == [("quota", "2026-11-23", 12, False)] and quota(0, "2026-11-23") == [("quota", "2026-11-23", 0, True)]
    assert quota(60, "2026-11-22") == quota(12, "2026-11-20") == quota(12, "2026-11-16") == []
    held = make([("a", D(2026, 11, 20)), ("b", D(2026, 11, 1)), ("c", D(2026, 11, 22))], "source string, day date")
    assert rows(H.site_stale(make([("a", D(2026, 11, 1)), ("b", D(2026, 11, 1))], "source string, day date"), held, day)) == [("site-stale", "2026-11-20", 1, True)]
    nothing = make([], H.FINDING)
    assert rows(H.job_ended(nothing, "cancelled", ["short-run"], day)) == [("job", "2026-11-22", 1, True)] and rows(H.job_ended(nothing, "success", [], day)) == []
    explained = H.told(nothing, "short-run", F.lit("e"), True)
    assert rows(H.job_ended(explained, "cancelled", ["short-run"], day)) == [] and rows(H.told(nothing, "self-test", F.lit("e"), False)) == []


def test_as_of_join(spark):
    left = spark.createDataFrame([(1, 5, "p"), (1, 1, "q"), (1, None, "r"), (None, 9, "s"), (2, 3, "t"), (1, 5, "p")], "k int, at int, own string")
    right = spark.createDataFrame([(1, 2, 20), (1, 5, 50), (1, 5, 51), (1, 9, 90), (None, 1, 7), (3, 1, 8)], "k int, at int, v int").withColumn("own", F.lit("clash"))
    got = sorted((r.own, r.v) for r in as_of_join(left, right, ["k"], "at", ["v"]).collect())
    assert sorted(got, key=str) == sorted([("p", 51), ("p", 51), ("q", None), ("r", None), ("s", None), ("t", None)], key=str)
    assert as_of_join(left, right.limit(0), ["k"], "at", ["v"]).where("v is not null").count() == 0 and as_of_join(left.limit(0), right, ["k"], "at", ["v"]).count() == 0

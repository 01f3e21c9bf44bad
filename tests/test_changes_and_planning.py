import datetime as dt

from pyspark.sql import functions as F

from tallymark.operators import changes as C
from tallymark.operators import planning as P
from tallymark.operators import presentation as V

D = lambda s: None if s is None else dt.date.fromisoformat(s)
APPT = "affiliation_id bigint, person_id bigint, department_id bigint, rank_name string, appointment_type string, is_primary int, start_day date, end_day date, is_open boolean, source string"


def appts(spark, rows):
    return spark.createDataFrame([(i, p, d, r, "regular", 1, D(a), D(b), b is None, None) for i, (p, d, r, a, b) in enumerate(rows, 1)], APPT)


def test_recent_changes(spark):
    df = appts(spark, [
        (1, 1, "assistant", "2020-01-01", "2026-09-15"), (1, 2, "assistant", "2026-09-15", None),
        (2, 1, "associate", "2020-01-01", "2026-09-15"), (2, 1, "full", "2026-09-15", None),
        (3, 1, "full", "2020-01-01", "2026-09-15"), (4, 1, "full", "2020-01-01", None),
        (5, 1, "full", "2020-01-01", "2026-03-01"), (5, 2, "full", "2026-03-01", None),
        (6, 1, "full", "2020-01-01", "2026-09-15"), (6, 1, "full", "2026-09-16", None),
        (7, 1, "full", None, "2026-09-01"), (7, 2, "full", "2026-09-01", "2026-10-02"), (7, 1, "full", "2026-10-02", None),
    ])
    got = sorted((r.person_id, r.change) for r in C.recent_changes(df, F.to_date(F.lit("2026-09-14"))).collect())
    assert got == [(1, "move"), (2, "promotion"), (3, "departed")]
    assert C.recent_changes(df, F.lit(None).cast("date")).count() == 0


def test_close_and_open(spark):
    df = appts(spark, [(1, 1, "full", "2020-01-01", None), (2, 1, "full", "2020-01-01", None), (1, 3, "full", "2010-01-01", "2020-01-01")])
    moves = spark.createDataFrame([(1, 9, "other"), (8, 7, None)], "person_id bigint, to_department bigint, to_rank string")
    rows = {r.affiliation_id: r for r in C.close_and_open(df, moves, F.to_date(F.lit("2026-01-01"))).collect()}
    assert len(rows) == 5 and rows[1].end_day == D("2026-01-01") and not rows[1].is_open and rows[2].is_open
    assert (rows[4].person_id, rows[4].department_id, rows[5].person_id) == (1, 9, 8) and rows[4].is_new
    assert C.close_and_open(df, moves.limit(0), F.to_date(F.lit("2026-01-01"))).count() == 3


def test_rules(spark):
    urls = {"https://a.luskin.ucla.edu/x": "ucla.edu", "@utexas.edu": "utexas.edu", "inu.ac.kr": "inu.ac.kr", "www.unsw.edu.au": "unsw.edu.au", "localhost": "localhost", "": None, None: None}
    got = {r.u: r.d for r in spark.createDataFrame([(u,) for u in urls], "u string").select("u", C.registrable(F.col("u")).alias("d")).collect()}
    assert got == urls
    today = F.to_date(F.lit("2026-11-13"))
    rows = [("assistant", D("2019-11-01"), None, None, 7), ("assistant", None, 2019, None, 7), ("associate", None, 1990, None, None), ("full", D("1990-01-01"), None, None, None), ("assistant", D("2015-01-01"), None, D("2025-01-01"), None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "rk string, s date, y bigint, v date, want bigint")
    assert all(r.want == r.got for r in df.select("want", C.rank_review(F.col("rk"), F.col("s"), F.col("y"), F.col("v"), today).alias("got")).collect())
    text = spark.createDataFrame([("rank verified 2026-01-02; verified 2026-03-04",), ("none",), (None,)], "n string")
    assert [r.v for r in text.select(C.verified_on(F.col("n")).alias("v")).collect()] == [D("2026-03-04"), None, None]


def test_two_readings_votes_and_ids(spark):
    rows = [(1, 100, "a", 1), (1, 120, "b", 2), (1, None, "c", 3), (1, 90, "b", 3), (2, 50, "a", 4), (3, None, "a", 5)]
    df = spark.createDataFrame(rows, "person_id bigint, v bigint, moment string, snapshot_id bigint").withColumn("day", F.col("moment"))
    two = {r.person_id: (r.latest, r.previous) for r in C.latest_two(df, "v").collect()}
    assert two == {1: (90, 120), 2: (50, None)}
    assert [r.person_id for r in C.dropped(C.latest_two(df, "v")).collect()] == [1]
    votes = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, None), (3, None)], "g int, v string")
    assert [tuple(r) for r in C.majority(votes, "g", "v").collect()] == [(1, "a", 2)]
    seen = spark.createDataFrame([("x", None), ("x", None), ("y", None), ("y", 3), ("z", None)], "k string, v int")
    assert [tuple(r) for r in C.dead_ids(seen, "k", "v").collect()] == [("x", 2)]
    held = spark.createDataFrame([(1, "A"), (2, None)], "person_id bigint, held_id string")
    claims = spark.createDataFrame([(2, "A"), (3, "B"), (2, "B")], "person_id bigint, new_id string")
    assert [tuple(r) for r in C.redirect(held, claims).collect()] == [(2, "B")]


def test_planning(spark):
    works = spark.createDataFrame([("s", c) for c in (10, 8, 5, 4, 3)] + [("t", 0), ("u", None)], "a string, c int")
    assert {r.a: (r.h_index, r.i10, r.total) for r in P.h_indexes(works, "a", "c").collect()} == {"s": (4, 1, 30), "t": (0, 0, 0)}
    holders = spark.createDataFrame([(1, "N"), (2, "O"), (3, "A"), (4, "R")], "person_id bigint, held_id string")
    seen = spark.createDataFrame([(2, "O"), (3, None), (4, "other")], "seen_person bigint, seen_id string")
    assert sorted(r.person_id for r in P.missing_readings(holders, seen).collect()) == [1, 4]
    people = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "person_id bigint")
    last = spark.createDataFrame([(1, "09-15"), (2, "03-01"), (3, "10-10")], "person_id bigint, last_day string")
    assert [r.person_id for r in P.oldest_first(people, last, 3).collect()] == [4, 2, 1]
    runs = spark.createDataFrame([(774, 1, None), (None, None, "1,050 ok, 2 failed"), (None, None, None)], "a bigint, b bigint, n string")
    ok, bad = P.run_counts(F.col("a"), F.col("b"), F.col("n"))
    assert [tuple(r) for r in runs.select(ok, bad).collect()] == [(774, 1), (1050, 2), (None, None)]
    wanted = spark.createDataFrame([("new", ["a"]), ("same", ["a"]), ("more", ["a", "b"]), ("back", ["c"]), ("quiet", ["c"])], "key string, members array<string>")
    tracked = spark.createDataFrame([("same", "open", ["a"]), ("more", "open", ["a"]), ("back", "closed", ["a"]), ("quiet", "closed", ["c"]), ("gone", "open", ["a"]), ("old", "closed", ["a"])], "key string, state string, shown array<string>")
    assert {r.key: r.action for r in P.reconcile(wanted, tracked).collect()} == {"new": "create", "same": "none", "more": "comment", "back": "reopen", "quiet": "none", "gone": "close", "old": "none"}


def test_pages(spark):
    years = spark.createDataFrame([(1, [(2022, 40), (2023, 55), (2024, 0), (2025, 70), (2027, 30)]), (2, [(2022, 1)]), (3, [])], "p int, years array<struct<year: bigint, n: bigint>>")
    series = V.gap_filled_years(years, "p")
    assert sorted(tuple(r) for r in series.collect()) == [(1, 2022, 40), (1, 2023, 55), (1, 2024, 0), (1, 2025, 70), (1, 2026, 0), (1, 2027, 30)]
    assert tuple(V.chart_points(series, "p").first()) == (1, 6, 2025, 70)
    gains = spark.createDataFrame([(1029, 1381, D("2026-09-15")), (10, 120, D("2027-01-10")), (None, None, D("2027-01-10"))], "a bigint, b bigint, d date")
    assert [r.g for r in gains.select(V.yearly_gain(F.col("a"), F.col("b"), F.col("d")).alias("g")).collect()][:2] == [1438, 127]
    tops = spark.createDataFrame([(0,), (1,), (7,), (10,), (11,), (499,), (501,), (None,)], "v bigint")
    assert [r.t for r in tops.select(V.axis_top(F.col("v")).alias("t")).collect()] == [1, 1, 10, 10, 20, 500, 1000, 1]
    marks = spark.createDataFrame([(0.93,), (0.11,), (0.015,), (1.0,), (None,)], "v double")
    assert [r.t for r in marks.select(V.ordinal(F.col("v")).alias("t")).collect()] == ["93rd", "11th", "2nd", "100th", None]
    names = spark.createDataFrame([(1, "Ánn Lee"), (2, "ann-lee"), (3, "..."), (4, None)], "i bigint, n string")
    assert sorted(tuple(r) for r in V.unique_slugs(names, "i", "n").collect()) == [(1, "ann-lee-1"), (2, "ann-lee-2"), (3, "x-3"), (4, "x-4")]


def test_search(spark):
    idx = spark.createDataFrame([("k", "ann lee", "alpha planning", 5), ("z", "zzz", None, None)], "key string, name string, place_name string, weight int")
    score = lambda q: next((r.score for r in V.search(idx, q).collect() if r.key == "k"), None)
    assert [score(q) for q in ("ann lee", "ann", "lee ann", "nn l", "lee alpha", "a planning", "lpha plan", "zed")] == [0, 1, 2, 3, 4, 4, 5, None]
    assert V.search(idx, "").count() == 0

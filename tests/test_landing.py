import datetime as dt
import json

from pyspark.sql import functions as F

from tallymark.operators import landing as L


def test_profiles(spark):
    full = {"search_parameters": {"author_id": "NEW"}, "author": {"name": "Ann Lee", "affiliations": "Alpha", "email": "Verified email at alpha.edu", "interests": [{"title": "maps"}], "website": None},
            "cited_by": {"table": [{"citations": {"all": 10, "since_2021": 4}}, {"h_index": {"all": 3, "since_2021": 2}}, {"i10_index": {"all": 1, "since_2021": 0}}], "graph": [{"year": 2024, "citations": 3}, {"year": 2025}]}}
    df = spark.createDataFrame([("OLD", json.dumps(full)), ("GONE", json.dumps({"author": {}})), ("BAD", "{x"), ("NULL", None)], "q string, body string")
    rows = L.profiles(df, "q", "body").collect()
    a = rows[0]
    assert (a.scholar_id, a.email_domain, a.citedby, a.citedby5y, a.hindex, a.hindex5y, a.i10index, a.i10index5y, a.is_gone) == ("NEW", "@alpha.edu", 10, 4, 3, 2, 1, 0, False)
    assert a.cites_per_year == {"2024": 3, "2025": 0} and list(a.interests) == ["maps"]
    assert [r.is_gone for r in rows[1:]] == [True, True, True]


def test_authors_links_and_degrees(spark):
    body = json.dumps({"organic_results": [{"publication_info": {"authors": [{"author_id": "A", "name": " Ann "}, {"name": "no id"}]}}, {"publication_info": {"authors": [{"author_id": "A", "name": "Other"}, {"author_id": "B", "name": "Bo"}]}}, {}]})
    df = spark.createDataFrame([(1, body), (2, None)], "i int, body string")
    assert sorted(tuple(r) for r in L.linked_authors(df, "i", "body").collect()) == [(1, "A", "Ann"), (1, "B", "Bo")]
    html = '<div id="gs_res_ccl"><a href="/citations?user=abcdefghijkl&hl=en">Ann</a><a href="/citations?user=abcdefghijkl">Again</a><a href="/citations?user=short">No</a></div>'
    pages = spark.createDataFrame([(1, "https://s.example/scholar?q=x", html), (2, "https://s.example/sorry", html), (3, "https://s.example/scholar?q=x", "blocked")], "i int, u string, h string")
    assert [tuple(r) for r in L.profile_links(pages, "i", "u", "h").collect()] == [(1, "abcdefghijkl", "Ann")]
    entry = lambda title, year, org: {"education-summary": {"role-title": title, "end-date": {"year": {"value": year}} if year else None, "organization": {"name": org}}}
    edu = json.dumps({"affiliation-group": [{"summaries": [entry("PhD in Planning", "2001", "Old"), entry("Ph.D.", "2010", "New"), entry("MSc", "2015", "No"), entry("Doctorate", None, "No")]}]})
    assert [tuple(r) for r in L.doctorates(spark.createDataFrame([(1, edu), (2, "{}")], "p int, b string"), "p", "b").collect()] == [(1, "2010", "New", "")]


def test_entries(spark):
    df = spark.createDataFrame([(" x ", "2021", "https://orcid.org/0000-0002-1825-009x"), ("#REF!", "2021-03-04T00:00", "none"), ("", " ", None), (None, None, None)], "c string, s string, o string")
    back = F.to_date(F.lit("2026-01-01"))
    got = [tuple(r) for r in df.select(L.cell(F.col("c")), L.since_date(F.col("s"), back), L.parse_orcid(F.col("o"))).collect()]
    assert got == [("x", dt.date(2021, 1, 1), "0000-0002-1825-009X"), (None, dt.date(2021, 3, 4), None), (None, dt.date(2026, 1, 1), None), (None, dt.date(2026, 1, 1), None)]
    people = spark.createDataFrame([(1, "0000-0000-0000-0001"), (2, None), (3, "0000-0000-0000-0003"), (4, None)], "person_id int, orcid string")
    dec = spark.createDataFrame([(1, "0000-0000-0000-0001", "a"), (2, "0000-0000-0000-0002", "a"), (3, "0000-0000-0000-0009", "b"), (3, "0000-0000-0000-0008", "a"), (4, "bad", "a")], "person_id int, orcid string, decided_at string")
    assert {r.person_id: (r.orcid[-1] if r.orcid else None, r.outcome) for r in L.apply_orcids(people, dec).collect()} == {1: ("1", "confirmed"), 2: ("2", "filled"), 3: ("9", "replaced"), 4: (None, "kept")}


def test_queues_and_records(spark):
    queue = spark.createDataFrame([(1, "a", "pending", None), (1, "b", "rejected", "reviewer a"), (2, "c", "rejected", "audit"), (3, "d", "accepted", "reviewer a"), (4, None, "none", None)], "person_id int, external_id string, status string, reviewed_by string")
    found = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (5, "e")], "person_id int, external_id string")
    after = L.upsert_matches(queue, found)
    assert {(r.person_id, r.external_id): r.status for r in after.collect()} == {(1, "a"): "accepted", (1, "b"): "rejected", (2, "c"): "accepted", (3, "d"): "accepted", (4, None): "none", (5, "e"): "accepted"}
    people = spark.createDataFrame([(1, None), (2, "have"), (9, None)], "person_id int, own string")
    assert {r.person_id: r.own for r in L.sole_accepted(people, after, "own").collect()} == {1: "a", 2: "have", 9: None}
    recs = spark.createDataFrame([(1, 12, 51, 31), (2, 12, 51, 13), (3, 12, 51, 31), (4, None, None, 9)], "record_id int, works_count bigint, cited_by_count bigint, index_count bigint")
    works = spark.createDataFrame([(1, 31, 660), (2, 13, 60), (3, 10, 100), (4, 9, 5)], "record_id int, n_works bigint, total bigint")
    assert {r.record_id: (r.works_count, r.cited_by_count) for r in L.reconcile_with_works(recs, works).collect()} == {1: (31, 660), 2: (12, 51), 3: (12, 51), 4: (9, 5)}
    runs = spark.createDataFrame([("s", "d", 1, 47, "47 ok", ["x"]), ("s", "d", 2, None, "1 ok", ["y", "x"]), ("s", "e", 1, None, "a", None), ("s", "e", 2, None, "b", None)], "source string, day string, seq int, rolling int, notes string, stale_ids array<string>")
    assert {r.day: (r.notes, list(r.stale_ids)) for r in L.merge_run_records(runs).collect()} == {"d": ("47 ok", ["x", "y"]), "e": ("b", [])}
    assert [L.weekly_plan(50, 20, x) for x in (None, 60, 25, 5, 0)] == [(50, 20), (50, 20), (25, 10), (5, 0), (0, 0)] and L.weekly_plan(0, 5, 0) == (0, 0)
    acc = spark.createDataFrame([(1, "m", 50, "U", 0.9), (1, "x", 9, "V", 0.1), (1, "y", 9, "V", 0.7), (1, "z", 2, "V", 0.1), (1, "w", 9, None, None)], "person_id int, external_id string, works_count int, institution string, topic_share double")
    assert [r.external_id for r in L.extra_records_to_review(acc, spark.createDataFrame([(1, "m")], "person_id int, primary_id string")).collect()] == ["x"]


def test_reports(spark, tmp_path):
    people = spark.createDataFrame([(1, "Zed"), (2, "Abe")], "person_id int, last_name string")
    a, b = spark.createDataFrame([(1, "drop")], "person_id int, flag string"), spark.createDataFrame([(2, "stale"), (1, "stale")], "person_id int, flag string")
    assert [(r.last_name, r.flag) for r in L.flag_report([a, b], people).collect()] == [("Abe", "stale"), ("Zed", "drop"), ("Zed", "stale")]
    L.export_json(people, f"{tmp_path}/index")
    assert sorted(json.loads(x)["last_name"] for f in (tmp_path / "index").glob("*.txt") for x in f.read_text().splitlines()) == ["Abe", "Zed"]

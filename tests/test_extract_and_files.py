import json
import re

import pytest
from pyspark.sql import functions as F

from tallymark.operators import extract as X
from tallymark.plans import text_and_streams as T
from tallymark.sources import files as S
from tallymark.streaming import follow as W

PAGE = """<html><!-- <p>draft</p> --><style>p {color: red}</style><h2>Our Faculty Members</h2>
<ul><li><b>Dr. Ines Okoro, Ph.D., MCIP</b><br/>Asst. Prof.</li><li>Jun&nbsp;Tanaka (they/them)<br>Associate Professor &amp; Chair</li></ul>
<table><tr><td>Kofi O&#8217;Shea</td><td>Full Professor</td></tr><tr><td>Lena Vogt</td><td>Visiting Professor</td></tr></table>
<div>Mara Quist</div><div>room 4</div><div>Professor</div><script>if (a < b) { document.write("<p>Nils Berg</p><p>Professor</p>") }</script>
<h2>Retired faculty</h2><p>Otto Pahl</p><p>Professor</p><h2>Current Faculty</h2><p>Petra Ruiz</p><p>Assistant Professor</p></html>"""


def column(spark, values, f):
    return {r.t: r.k for r in spark.createDataFrame([(v,) for v in values], "t string").select("t", f(F.col("t")).alias("k")).collect()}


def test_listing(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, ""), (3, None)], "page_id int, html string")
    texts = {r.page_id: r.t for r in pages.select("page_id", X.text_of(F.col("html")).alias("t")).collect()}
    assert texts[1].split("\n")[:3] == ["Our Faculty Members", "Dr. Ines Okoro, Ph.D., MCIP", "Asst. Prof."] and "Kofi O’Shea" in texts[1] and "Berg" not in texts[1] and "draft" not in texts[1]
    assert texts[2] == "" and texts[3] is None
    lines = X.page_lines(pages, "page_id", X.text_of(F.col("html")))
    got = sorted((r.name, r.rank_name) for r in X.names_with_titles(lines, "page_id").collect())
    assert got == [("Ines Okoro", "assistant"), ("Jun Tanaka", "associate"), ("Kofi O’Shea", "full"), ("Mara Quist", "full"), ("Petra Ruiz", "assistant")]


def test_titles_names_headings(spark):
    titles = {
        "Associate Professor of Planning": "associate", "Professor and Associate Dean": "full", "Asst. Prof.": "assistant", "Full Professor": "full", "Director and Professor": None, "Research Professor": None, "Professor of the Practice": None, "Adjunct Assistant Professor": None,
        "Okafor Professor of Housing": None, "Endowed professor": None, "Professor in Residence": None, "Part-time Professor": None, "Lecturer": None, "word": None, "": None, None: None,
    }
    assert column(spark, titles, X.title_rank) == titles
    names = {
        "Prof. Ines Okoro, Ph.D., MCIP": "Ines Okoro", "Jun Tanaka (they/them)": "Jun Tanaka", "Kofi O’Shea-Brandt Jr.": "Kofi O’Shea-Brandt", "Élise M. Dübel": "Élise M. Dübel", "LATEST NEWS": None, "Urban Planning": None, "Ines": None, "Ines Okoro, Professor": None, "ines okoro": None, "": None, None: None,
        "One Two Three Four Five": None,
    }
    assert column(spark, names, X.name_on) == names
    heads = {"Emeriti": "side", "Affiliated and adjunct faculty": "side", "Administrative staff": "side", "Core Faculty": "core", "Faculty": "core", "Full-time faculty members": "core", "Faculty of Law": None, "Planning": None, "": None}
    assert column(spark, heads, X.section_of) == heads


def test_ranks_of_people_on_pages(spark):
    text = "News about Ann Lee and the professor who spoke at length on a warm evening in May\nAnn Lee\nProfessor\nBo K. Roe\nroom 3\nAssociate Professor\nRoe-Hart, Cy\nDee Fox\nAssistant Professor\nEve Ash, Lecturer\nGus Orr, Assistant Professor\nHal Ito, Assistant Professor\nIda Nys, Professor"
    lines = X.page_lines(spark.createDataFrame([(1, text), (2, "Ann Lee\nProfessor")], "page_id int, text string"), "page_id", F.col("text"))
    people = [(1, "Ann", "Lee", "associate"), (2, "Bo", "Roe", "associate"), (3, "Cy", "Roe-Hart", "full"), (4, "Dee", "Fox", "full"), (5, "Eve", "Ash", "full"), (6, "Zed", "Zoe", "full")]
    roster = spark.createDataFrame([(1, *p) for p in people] + [(2, *people[0])], "page_id int, person_id int, first_name string, last_name string, rank_name string")
    everyone = spark.createDataFrame([*[p[:3] for p in people], (7, "Hal", "Ito")], "person_id int, first_name string, last_name string")
    got = {(r.page_id, r.name_key): (r.kind, r.person_id, r.new_rank) for r in X.scan_pages(lines, "page_id", roster, everyone).collect()}
    # Page 2 names one of its roster and is no listing.
    assert got == {
        (1, "ann lee"): ("promotion", 1, "full"), (1, "bo roe"): ("rank_ok", 2, "associate"), (1, "cy roe hart"): ("not_found", 3, None), (1, "dee fox"): ("demotion", 4, "assistant"), (1, "eve ash"): ("no_rank", 5, None), (1, "zed zoe"): ("not_found", 6, None),
        (1, "gus orr"): ("new_hire", None, "assistant"), (1, "hal ito"): ("possible_move", 7, "assistant"), (1, "ida nys"): ("new_hire", None, "full"),
    }
    assert X.scan_pages(lines.limit(0), "page_id", roster, everyone).count() == 0


def test_links(spark):
    page = spark.createDataFrame([(1, "https://a.example/x", '<a href="/p">1</a> <A HREF=\'https://a.example/q\'>2</A> <a href="https://b.example/">3</a> <a href="/p">4</a>')], "i int, u string, h string")
    assert [r.link for r in X.page_links(page, "i", "u", "h").orderBy("place").collect()] == ["https://a.example/p", "https://a.example/q"]
    page = spark.createDataFrame([(1, "https://a.example/", '<a href="/apply">Apply</a><a href="/w?id=3">Our <b>People</b></a><a href="/faculty/news">Faculty news</a><a href="/staff/list">x</a>')], "i int, u string, h string")
    assert [r.link for r in X.page_links(page, "i", "u", "h", keep=4, people_only=True).orderBy("place").collect()] == [f"https://a.example/{x}" for x in ("w", "staff/list", "people/", "faculty/")]


def test_scan_changes(spark):
    cols = "department_id int, name_key string, rank_name string"
    found = spark.createDataFrame([(1, "a", "full"), (1, "b", "full"), (1, "c", "full"), (1, "d", "full")], cols)
    roster = spark.createDataFrame([(1, "a", "full"), (1, "b", "associate")], cols)
    held = spark.createDataFrame([(1, "c")], "department_id int, name_key string")
    assert {r.name_key: r.kind for r in X.scan_changes(found, roster, held).collect()} == {"a": "rank_ok", "b": "rank_change", "d": "new_hire"}


def roster(tmp_path):
    (tmp_path / "department.csv").write_text("department_id,short_name,name,university,country,url,openalex_institution_id,ror_id,acsp_member,active\n1,Alpha,A,U,US,,,,full,1\n")
    (tmp_path / "person.csv").write_text('person_id,first_name,last_name,display_name,notes\n1,Ann,Lee,Ann Lee,"two\nlines ""quoted"""\n2,Bo,Roe,Bo Roe,\n')
    (tmp_path / "person_alias.csv").write_text("person_id,alias\n1,A. Lee\n1,A. Lee\n")
    (tmp_path / "affiliation.csv").write_text("affiliation_id,person_id,department_id,rank,start_date,end_date\n1,1,1,full,2020-01-01,\n2,1,1,full,2021-01-01,\n3,9,7,full,,\n")
    return str(tmp_path)


def test_load_and_validate(spark, tmp_path):
    tables = S.load_tables(spark, roster(tmp_path))
    assert tables["department"].first().kind == "planning" and tables["person"].where("person_id = 1").first().notes == 'two\nlines "quoted"'
    assert {(r.check, r.key) for r in S.validate(tables).collect()} == {
        ("person_alias unique", "1|A. Lee"), ("affiliation.person_id known", "3"), ("affiliation.department_id known", "3"), ("one current primary appointment", "1"), ("note: person without appointment", "2"),
    }
    (tmp_path / "person_alias.csv").write_text("person_id,alias,odd\n1,a,b\n")
    with pytest.raises(ValueError, match="unknown columns"):
        S.load_tables(spark, str(tmp_path))
    raw = S.read_csv(spark, f"{tmp_path}/person.csv", S.SCHEMAS["person"], keep_blank=True)
    assert raw.where("person_id = 2").first().notes == ""


def snapshots(tmp_path):
    head = "person_id,source,collected_at,total_citations,h_index,i10_index,citations_5yr,h_index_5yr,works_count,raw_json\n"
    for source, day, total in (("openalex", "2026-01-01", "5"), ("openalex", "2026-02-01", ""), ("pop", "2026-01-15", "7")):
        (tmp_path / source).mkdir(exist_ok=True)
        (tmp_path / source / f"{day}.csv").write_text(head + f'1,{source},{day},{total},1,,,,,"{{""a"": ""x""}}"\n')
    (tmp_path / "pop" / "2026-01-15.meta.json").write_text(json.dumps({"trigger": "schedule", "ok": 3, "failed": 0}))
    (tmp_path / "openalex" / "2026-01-01.meta.json").write_text("{broken")
    return str(tmp_path)


def test_snapshots_and_sinks(spark, tmp_path):
    root = snapshots(tmp_path)
    rows = S.read_snapshots(spark, root)
    assert [(r.path_source, r.path_day, r.run_id, r.total_citations, r.raw_json) for r in rows.orderBy("run_id").collect()] == [("openalex", "2026-01-01", 1, 5, '{"a": "x"}'), ("openalex", "2026-02-01", 2, None, '{"a": "x"}'), ("pop", "2026-01-15", 3, 7, '{"a": "x"}')]
    assert S.read_snapshots(spark, root, "openalex", "2026-01-15").count() == 1
    assert [r.ok for r in S.read_run_records(spark, root).collect()] == [3]
    path = f"{tmp_path}/table"
    plain = rows.select("person_id", "source", "collected_at", "total_citations")
    assert S.append_readings(plain, path) == 3 and S.append_readings(plain, path) == 0
    S.replace_table(spark.read.parquet(path).where("source = 'pop'"), path)
    assert spark.read.parquet(path).count() == 1
    sheet = f"{tmp_path}/sheet"
    S.write_review_sheet(spark.createDataFrame([(1, "")], "k int, decision string"), sheet, ["decision"])
    S.write_review_sheet(spark.createDataFrame([(1, "yes")], "k int, decision string"), sheet, ["decision"])
    with pytest.raises(ValueError, match="entries"):
        S.write_review_sheet(spark.createDataFrame([(1, "")], "k int, decision string"), sheet, ["decision"])
    assert S.read_decisions(spark, sheet, ["k"]).count() == 1
    S.write_report(plain, f"{tmp_path}/report", ["source"])
    assert len(list((tmp_path / "report").glob("*.csv"))) == 1
    (tmp_path / "d1__p.txt").write_text("https://x.example\nline\n")
    assert tuple(S.read_saved_pages(spark, root).first()) == ("d1", "https://x.example", "line\n")


def test_stream_replay(spark, tmp_path):
    rows = [(1, 1, "pop", "2026-01-01", 10), (2, 1, "pop", "2026-02-01", 20), (3, 1, "pop", "2025-01-01", 5), (2, 1, "POP ", "2026-02-01", 20), (4, 2, "openalex", "2026-01-05T10:00:00Z", 1), (5, 1, "pop", "2026-03-01", 9), (6, None, None, None, None)]
    schema = "snapshot_id bigint, person_id bigint, source string, collected_at string, total_citations bigint"
    for i, r in enumerate(rows):
        spark.createDataFrame([r], schema).coalesce(1).write.parquet(f"{tmp_path}/in/f={i}")
    stream = lambda: W.reading_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema)
    latest = W.run_to_end(W.latest_per_key(stream()), "latest", ["person_id", "source"])
    assert sorted((r.person_id, r.source, r.total_citations) for r in latest.collect()) == [(1, "pop", 9), (2, "openalex", 1)]
    weekly = W.run_to_end(W.weekly_counts(stream()), "weekly", ["week_start", "source"])
    assert ("2025-12-29", "pop", 1) in {tuple(r) for r in weekly.collect()}
    assert W.run_to_end(W.once_per_key(stream()), "once").count() == 5
    drops = W.previous_reading_drops(stream()).collect()
    assert [(r.person_id, r.previous, r.total_citations) for r in drops] == [(1, 20, 9)]


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    schema = "snapshot_id bigint, person_id bigint, source string, collected_at string, total_citations bigint"

    def arrive(n, *rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/f={n}")

    def run():
        stream = lambda: W.reading_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema, files_per_batch=1)
        drops = W.previous_reading_drops(stream(), folder=f"{tmp_path}/drops")
        latest = W.run_to_end(W.latest_per_key(stream()), "latest", ["person_id", "source"], folder=f"{tmp_path}/latest")
        once = W.run_to_end(W.once_per_key(stream()), "once", folder=f"{tmp_path}/once")
        return {(r.person_id, r.previous, r.total_citations) for r in drops.collect()}, {(r.person_id, r.total_citations) for r in latest.collect()}, once.count()

    arrive(0, (1, 1, "pop", "2026-01-01", 100), (2, 2, "pop", "2026-01-01", 50))
    assert run() == (set(), {(1, 100), (2, 50)}, 2)
    arrive(1, (3, 1, "pop", "2026-02-01", 60), (2, 2, "pop", "2026-01-01", 50))
    arrive(2, (4, 2, "pop", "2026-02-02", 49))
    # The reading before comes from the first run's state, a delivery of old is known, and unchanged keys stay.
    assert run() == ({(1, 100, 60)}, {(1, 60), (2, 49)}, 4)
    assert run() == ({(1, 100, 60)}, {(1, 60), (2, 49)}, 4)


def test_status_fold(spark):
    cols = "stream string, at timestamp, searched int, waiting int, empty int, found int, is_blocked boolean, is_skipped boolean"
    day = lambda n: __import__("datetime").datetime(2026, 11, n, 8)
    rows = [("a", day(1), 5, 9, 1, 2, False, False), ("a", day(2), 0, 4, 0, 0, True, False), ("a", day(3), 0, None, 0, 0, False, False), ("a", day(4), None, None, None, None, None, True), ("b", day(1), 0, 3, 0, 0, False, False), ("b", day(2), 0, 0, 0, 0, False, False), ("c", day(5), None, None, None, None, None, None)]
    got = {r.stream: (r.outcome, r.queued, str(r.last_searched), str(r.stalled_since), r.batches) for r in W.fold_status(spark.createDataFrame(rows, cols)).collect()}
    assert got == {"a": ("skipped", 4, "2026-11-01", "2026-11-02", "2026-11-01:5:1:2"), "b": ("idle", 0, "None", "None", ""), "c": ("failed", None, "None", "2026-11-05", "")}


def test_page_queries_read_the_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {(f"doc-{r.doc_id}", r.name, r.rank_name) for r in X.names_with_titles(X.page_lines(docs.select("doc_id", "text"), "doc_id", F.col("text")), "doc_id").collect()}
    got = {tuple(r) for r in T.page_titles(spark, sf).collect()}
    assert want and {r for r in got if r[0].startswith("doc-")} == want and len(got) > len(want)
    links = {}
    for r in T.page_links(spark, sf).collect():
        links.setdefault(r.doc_id, {})[r.place] = r.link
    lines = {r.doc_id: len(re.split("\n|[.] ", r.text)) for r in docs.where("text is not null and url is not null").collect()}
    sizes = {len(x) for x in links.values()}
    # The page itself and /people, then links of the lines and sentences, six at most.
    assert max(sizes) == 6 and len(sizes) >= 2 and all(sorted(x) == list(range(1, len(x) + 1)) for x in links.values())
    assert all(len(links[i]) == 2 + min(n, 2) for i, n in lines.items() if n < 7)

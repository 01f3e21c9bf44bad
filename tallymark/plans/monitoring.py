"""Queries of change detection, planning, monitoring and page datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.functions.names import norm_name
from tallymark.functions.text import rank_name
from tallymark.operators import changes as C
from tallymark.operators import metrics as M
from tallymark.operators import planning as P
from tallymark.operators import presentation as V
from tallymark.operators.ranking import with_ranks
from tallymark.plans.base_sql import BASE, RANK
from tallymark.session import table
from tallymark.sources.standard import appointments, readings

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
#: The day the reports are for.
TODAY = "2026-11-20"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = BASE + sql
        return f

    return add


def _today():
    return F.to_date(F.lit(TODAY))


def _scholar(spark, d):
    return readings(spark, d).where("source = 'google_scholar'")


def _current(spark, d):
    return M.current_appointments(appointments(spark, d), table(spark, d, "department"))


# ------------------------------------------------------------ change detection
_TWO = """, two AS (SELECT person_id, max(day) FILTER (n = 1) AS day, max(total_citations) FILTER (n = 1) AS latest_total, max(total_citations) FILTER (n = 2) AS previous FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY moment DESC, snapshot_id DESC) AS n FROM rd WHERE source = 'google_scholar' AND total_citations IS NOT NULL AND moment IS NOT NULL) WHERE n < 3 GROUP BY person_id)"""


@query(f"{_TWO} SELECT person_id, day, latest_total AS latest, previous FROM two")
def latest_two(spark: SparkSession, d: str) -> DataFrame:
    return C.latest_two(_scholar(spark, d), "total_citations")


@query(f"{_TWO} SELECT person_id, day, latest_total AS latest, previous FROM two WHERE previous > 0 AND latest_total <> 0 AND (previous - latest_total) / previous > 0.2e0")
def drop_over_20pct(spark: SparkSession, d: str) -> DataFrame:
    return C.dropped(C.latest_two(_scholar(spark, d), "total_citations"))


@query(f"""SELECT c.person_id, max(l.day) AS last_day FROM (SELECT DISTINCT person_id FROM cur) c JOIN person p USING (person_id) LEFT JOIN (SELECT person_id, max(day) AS day FROM rd WHERE source = 'google_scholar' GROUP BY person_id) l USING (person_id)
WHERE p.google_scholar_id <> '' AND (l.day IS NULL OR CAST(l.day AS DATE) < DATE '{TODAY}' - 182) GROUP BY c.person_id""")
def stale_readings(spark: SparkSession, d: str) -> DataFrame:
    last = _scholar(spark, d).groupBy("person_id").agg(F.max("day").alias("last_day"))
    who = _current(spark, d).select("person_id").distinct().join(table(spark, d, "person").where("google_scholar_id <> ''").select("person_id"), "person_id")
    return who.join(last, "person_id", "left").where(F.col("last_day").isNull() | (F.to_date("last_day") < F.date_sub(_today(), 7 * C.STALE_WEEKS)))


_HOST = "regexp_replace(regexp_replace(lower(trim({c})), '^([a-z][a-z0-9+.-]*://)?([^/@]*@)?', ''), '[/:?#].*$', '')"
_DOM = f"array_to_string(list_slice(string_split({_HOST}, '.'), -2, -1), '.')"


@query(f"""SELECT department_id, domain, n FROM (SELECT department_id, domain, count(*) AS n, row_number() OVER (PARTITION BY department_id ORDER BY count(*) DESC, domain) AS i FROM (
  SELECT c.department_id, {_DOM.format(c='p.personal_url')} AS domain FROM cur c JOIN person p USING (person_id) WHERE p.personal_url IS NOT NULL) GROUP BY department_id, domain) WHERE i = 1 AND n > 1""")
def home_domain_vote(spark: SparkSession, d: str) -> DataFrame:
    votes = _current(spark, d).select("person_id", "department_id").join(table(spark, d, "person").where("personal_url is not null").select("person_id", C.registrable(F.col("personal_url")).alias("domain")), "person_id")
    return C.majority(votes, "department_id", "domain")


@query(f"SELECT {_DOM.format(c='url')} AS domain, min(department_id) AS department_id FROM department WHERE url IS NOT NULL GROUP BY 1")
def domain_owner(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "department").where("url is not null").groupBy(C.registrable(F.col("url")).alias("domain")).agg(F.min("department_id").alias("department_id"))


_SID = "CASE WHEN json_valid(raw_json) THEN json_extract_string(raw_json, '$.scholar_id') END"


@query(f"""SELECT s.delivery_row_id, s.person_id FROM snapshot_delivery s JOIN person p USING (person_id)
WHERE s.source = 'google_scholar' AND p.google_scholar_id <> '' AND coalesce({_SID.replace('raw_json', 's.raw_json')}, p.google_scholar_id) = p.google_scholar_id""")
def readings_held(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "snapshot_delivery").where("source = 'google_scholar'").select("delivery_row_id", "person_id", F.get_json_object("raw_json", "$.scholar_id").alias("sid"))
    held = table(spark, d, "person").where("google_scholar_id <> ''").select("person_id", "google_scholar_id")
    return rows.join(held, "person_id").where("coalesce(sid, google_scholar_id) = google_scholar_id").select("delivery_row_id", "person_id")


_FIELDS = ["spatial statistics", "tourism", "remote-sensing", "heat exposure"]
_CASE = " ".join(f"WHEN contains(lower(interests), '{w}') THEN '{w}'" for w in _FIELDS)


@query(f"SELECT person_id, CASE {_CASE} END AS field FROM person WHERE CASE {_CASE} END IS NOT NULL")
def foreign_field(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "person").select("person_id", C.first_found(F.col("interests"), _FIELDS).alias("field")).where("field is not null")


@query("""SELECT l.person_id, arg_min(k.cited_by_count, k.candidate_id) AS namesake_total FROM latest l JOIN identity_candidates k ON k.person_id = l.person_id AND k.status IN ('accepted', 'rejected')
WHERE l.source = 'openalex' AND l.total_citations >= 25 AND k.cited_by_count <> 0 AND abs(k.cited_by_count - l.total_citations) / l.total_citations <= 0.1e0 GROUP BY l.person_id""")
def band_taint(spark: SparkSession, d: str) -> DataFrame:
    pop = M.latest_readings(readings(spark, d)).where("source = 'openalex' and total_citations >= 25").select("person_id", "total_citations")
    bad = table(spark, d, "identity_candidates").where("status in ('accepted', 'rejected') and cited_by_count <> 0").select("person_id", "candidate_id", "cited_by_count")
    near = pop.join(bad, "person_id").where("abs(cited_by_count - total_citations) / total_citations <= 0.1D")
    return near.groupBy("person_id").agg(F.min_by("cited_by_count", "candidate_id").alias("namesake_total"))


_VER = "try_cast(list_max(regexp_extract_all(a.source, 'verified (\\d{4}-\\d{2}-\\d{2})', 1)) AS DATE)"


@query(f"""SELECT affiliation_id, years FROM (SELECT a.affiliation_id, a.rank_name, {_VER} AS v,
  CASE WHEN a.start_day IS NOT NULL THEN CAST((DATE '{TODAY}' - a.start_day) // 365 AS BIGINT) WHEN a.rank_name = 'assistant' THEN 2026 - p.phd_year END AS years FROM cur a JOIN person p USING (person_id))
WHERE rank_name IN ('assistant', 'associate') AND years >= 7 AND NOT coalesce(DATE '{TODAY}' - v < 2555, false)""")
def rank_review_due(spark: SparkSession, d: str) -> DataFrame:
    rows = _current(spark, d).join(table(spark, d, "person").select("person_id", "phd_year"), "person_id")
    years = C.rank_review(F.col("rank_name"), F.col("start_day"), F.col("phd_year"), C.verified_on(F.col("source")), _today())
    return rows.select("affiliation_id", years.alias("years")).where("years is not null")


@query(f"SELECT affiliation_id, {_VER.replace('a.source', 'source')} AS verified_day, coalesce(DATE '{TODAY}' - {_VER.replace('a.source', 'source')} <= 180, false) AS is_recent FROM affiliation WHERE source LIKE '%verified%'")
def recently_verified(spark: SparkSession, d: str) -> DataFrame:
    day = C.verified_on(F.col("source"))
    return table(spark, d, "affiliation").where("source like '%verified%'").select("affiliation_id", day.alias("verified_day"), F.coalesce(F.datediff(_today(), day) <= 180, F.lit(False)).alias("is_recent"))


@query(f"SELECT affiliation_id, {RANK.format(c='rank')} AS rank_name FROM affiliation".replace("affiliation_id, CASE WHEN rank", 'affiliation_id, CASE WHEN "rank"').replace("trim(rank)", 'trim("rank")').replace("lower(rank)", 'lower("rank")'))
def rank_from_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "affiliation").select("affiliation_id", rank_name(F.col("rank")).alias("rank_name"))


_LAST = """, told AS (SELECT person_id, arg_max({'d': department_id, 'r': rank_name}, (extracted_on, loaded_at, extract_id)) AS t FROM (SELECT *, """ + RANK.format(c='"rank"') + """ AS rank_name FROM roster_extract) WHERE department_id IS NOT NULL GROUP BY person_id),
mv AS (SELECT o.person_id, told.t.d AS to_department, told.t.r AS to_rank FROM (SELECT person_id, count(*) AS n, max(department_id) AS dep FROM ap WHERE is_open AND is_primary = 1 GROUP BY person_id) o JOIN told USING (person_id) WHERE o.n = 1 AND told.t.d <> o.dep)"""


def _moves(spark, d):
    told = table(spark, d, "roster_extract").where("department_id is not null").groupBy("person_id").agg(F.max_by(F.struct("department_id", rank_name(F.col("rank")).alias("rank_name")), F.struct("extracted_on", "loaded_at", "extract_id")).alias("t"))
    open_rows = appointments(spark, d).where("is_open and is_primary = 1").groupBy("person_id").agg(F.count(F.lit(1)).alias("n"), F.max("department_id").alias("dep")).where("n = 1")
    return open_rows.join(told, "person_id").where("t.department_id <> dep").select("person_id", F.col("t.department_id").alias("to_department"), F.col("t.rank_name").alias("to_rank"))


@query(f"""{_LAST} SELECT affiliation_id, person_id, department_id, rank_name, start_day, CASE WHEN is_open AND is_primary = 1 AND person_id IN (SELECT person_id FROM mv) THEN DATE '{TODAY}' ELSE end_day END AS end_day, false AS is_new FROM ap
UNION ALL SELECT (SELECT max(affiliation_id) FROM affiliation) + row_number() OVER (ORDER BY person_id), person_id, to_department, to_rank, DATE '{TODAY}', NULL, true FROM mv""")
def apply_close_open(spark: SparkSession, d: str) -> DataFrame:
    return C.close_and_open(appointments(spark, d), _moves(spark, d), _today()).select("affiliation_id", "person_id", "department_id", "rank_name", "start_day", "end_day", "is_new")


@query("""SELECT person_id, change, closed_day, from_department, to_department FROM (
  SELECT a.person_id, a.end_day AS closed_day, a.department_id AS from_department, o.department_id AS to_department,
    CASE WHEN o.person_id IS NULL THEN 'departed' WHEN o.start_day = a.end_day AND o.department_id <> a.department_id
        AND NOT EXISTS (SELECT 1 FROM ap b WHERE b.is_primary = 1 AND b.person_id = a.person_id AND b.end_day = a.start_day AND b.department_id = o.department_id) THEN 'move'
      WHEN o.start_day = a.end_day AND o.department_id = a.department_id AND coalesce(list_position(['assistant', 'associate', 'full'], o.rank_name), 0) > coalesce(list_position(['assistant', 'associate', 'full'], a.rank_name), 0) THEN 'promotion' END AS change
  FROM ap a LEFT JOIN (SELECT * FROM ap WHERE is_primary = 1 AND is_open QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY start_day DESC NULLS LAST, affiliation_id DESC) = 1) o USING (person_id)
  WHERE a.is_primary = 1 AND a.end_day >= DATE '2020-01-01') WHERE change IS NOT NULL""")
def recent_changes(spark: SparkSession, d: str) -> DataFrame:
    return C.recent_changes(appointments(spark, d), F.to_date(F.lit("2020-01-01")))


@query("SELECT google_scholar_id AS profile, count(*) AS empty FROM person p JOIN rd r ON r.person_id = p.person_id AND r.source = 'google_scholar' WHERE google_scholar_id IS NOT NULL GROUP BY 1 HAVING count(*) = count(*) FILTER (works_count IS NULL) AND count(*) > 1")
def dead_ids(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "person").where("google_scholar_id is not null").select("person_id", F.col("google_scholar_id").alias("profile"))
    return C.dead_ids(_scholar(spark, d).join(held, "person_id"), "profile", "works_count")


@query("SELECT min(person_id) AS person_id, external_id AS new_id FROM identity_candidates WHERE status = 'rejected' AND external_id IS NOT NULL AND source = 'openalex' AND external_id NOT IN (SELECT openalex_author_id FROM person WHERE openalex_author_id IS NOT NULL) GROUP BY external_id")
def id_redirect(spark: SparkSession, d: str) -> DataFrame:
    claims = table(spark, d, "identity_candidates").where("status = 'rejected' and external_id is not null and source = 'openalex'").select("person_id", F.col("external_id").alias("new_id"))
    return C.redirect(table(spark, d, "person").select("person_id", F.col("openalex_author_id").alias("held_id")), claims)


_NORM = "trim(regexp_replace(strip_accents(lower({c})), '[^a-z]+', ' ', 'g'))"


@query(f"SELECT {_NORM.format(c='display_name')} AS name, count(*) AS n, min(person_id) AS kept FROM person GROUP BY 1 HAVING count(*) > 1")
def duplicate_people(spark: SparkSession, d: str) -> DataFrame:
    """Names that several people bear, to be looked at for one person entered twice."""
    return table(spark, d, "person").groupBy(norm_name(F.col("display_name")).alias("name")).agg(F.count(F.lit(1)).alias("n"), F.min("person_id").alias("kept")).where("n > 1")


# ------------------------------------------------------------ planning and monitoring
@query(f"""SELECT p.person_id FROM person p WHERE p.google_scholar_id <> '' AND NOT EXISTS (SELECT 1 FROM snapshot_delivery s WHERE s.source = 'google_scholar' AND s.person_id = p.person_id
  AND ({_SID.replace('raw_json', 's.raw_json')} IS NULL OR {_SID.replace('raw_json', 's.raw_json')} = p.google_scholar_id))""")
def missing_readings(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "snapshot_delivery").where("source = 'google_scholar'").select(F.col("person_id").alias("seen_person"), F.get_json_object("raw_json", "$.scholar_id").alias("seen_id")).distinct()
    holders = table(spark, d, "person").where("google_scholar_id <> ''").select("person_id", F.col("google_scholar_id").alias("held_id"))
    return P.missing_readings(holders, seen).select("person_id")


@query("SELECT person_id, last_day FROM (SELECT DISTINCT person_id FROM cur) LEFT JOIN (SELECT person_id, max(day) AS last_day FROM rd WHERE source = 'google_scholar' GROUP BY person_id) USING (person_id) ORDER BY last_day NULLS FIRST, person_id LIMIT 50")
def oldest_first_budget(spark: SparkSession, d: str) -> DataFrame:
    last = _scholar(spark, d).groupBy("person_id").agg(F.max("day").alias("last_day"))
    return P.oldest_first(_current(spark, d).select("person_id").distinct(), last, 50)


@query("SELECT DISTINCT person_id FROM rd WHERE source = 'google_scholar' AND day BETWEEN '2026-11-01' AND '2026-11-08'")
def already_done(spark: SparkSession, d: str) -> DataFrame:
    return _scholar(spark, d).where("day between '2026-11-01' and '2026-11-08'").select("person_id").distinct()


_PRI = f"""SELECT p.person_id, CASE WHEN s.last_searched IS NULL THEN 1 WHEN p.google_scholar_id IS NULL AND CAST(s.last_searched AS DATE) < DATE '{TODAY}' - 120 THEN 2 ELSE 3 END AS tier
FROM person p LEFT JOIN (SELECT person_id, max(reviewed_at) AS last_searched FROM identity_candidates GROUP BY person_id) s USING (person_id)"""


@query(_PRI)
def search_priority(spark: SparkSession, d: str) -> DataFrame:
    last = table(spark, d, "identity_candidates").where("person_id is not null").groupBy("person_id").agg(F.max("reviewed_at").alias("last_searched"))
    old = F.to_date("last_searched") < F.date_sub(_today(), 120)
    tier = F.when(F.col("last_searched").isNull(), 1).when(F.col("google_scholar_id").isNull() & old, 2).otherwise(3)
    return table(spark, d, "person").select("person_id", "google_scholar_id").join(last, "person_id", "left").select("person_id", tier.alias("tier"))


@query("""SELECT person_id, id, min(o) AS ordinal FROM (
  SELECT person_id, 0 AS o, openalex_author_id AS id FROM person UNION ALL SELECT person_id, candidate_id, external_id FROM identity_candidates WHERE status = 'accepted' AND source = 'openalex') WHERE id IS NOT NULL GROUP BY person_id, id""")
def accepted_ids(spark: SparkSession, d: str) -> DataFrame:
    acc = table(spark, d, "identity_candidates").where("status = 'accepted' and source = 'openalex'").select("person_id", F.col("candidate_id").alias("ordinal"), F.col("external_id").alias("id"))
    return P.ordered_ids(table(spark, d, "person").select("person_id", F.col("openalex_author_id").alias("held_id")), acc)


@query("SELECT candidate_id, min(candidate_id) OVER (PARTITION BY external_id) AS kept FROM identity_candidates WHERE external_id IS NOT NULL")
def dedupe_merged(spark: SparkSession, d: str) -> DataFrame:
    return P.first_by_canonical(table(spark, d, "identity_candidates").where("external_id is not null"), "external_id", "candidate_id")


@query("""SELECT l_suppkey, count(*) AS n_works, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, max(CASE WHEN CAST(l_quantity AS BIGINT) >= i THEN i ELSE 0 END) AS h_index, count(*) FILTER (l_quantity >= 10) AS i10
FROM (SELECT l_suppkey, l_quantity, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS i FROM lineitem) GROUP BY l_suppkey""")
def h_index_i10(spark: SparkSession, d: str) -> DataFrame:
    return P.h_indexes(table(spark, d, "lineitem").select("l_suppkey", "l_quantity"), "l_suppkey", "l_quantity")


@query("""SELECT person_id, CAST(sum(cited_by_count) AS BIGINT) AS total_citations, CAST(sum(works_count) AS BIGINT) AS works_count, max(h_index) AS h_index, arg_max(external_id, (coalesce(works_count, 0), -candidate_id)) AS primary_id, count(*) AS n_records
FROM identity_candidates WHERE status = 'accepted' AND external_id IS NOT NULL GROUP BY person_id""")
def record_aggregate(spark: SparkSession, d: str) -> DataFrame:
    return P.aggregate_records(table(spark, d, "identity_candidates").where("status = 'accepted' and external_id is not null"), "person_id")


_RUNS = """, runs AS (SELECT run_id, source, started_at, coalesce(n_succeeded, try_cast(replace(nullif(regexp_extract(notes, '([\\d,]+) ok', 1), ''), ',', '') AS BIGINT)) AS n_ok,
  coalesce(n_failed, try_cast(replace(nullif(regexp_extract(notes, '([\\d,]+) failed', 1), ''), ',', '') AS BIGINT)) AS n_bad FROM collection_run)"""


def _runs(spark, d):
    ok, bad = P.run_counts(F.col("n_succeeded"), F.col("n_failed"), F.col("notes"))
    return table(spark, d, "collection_run").select("run_id", "source", "started_at", ok.alias("n_ok"), bad.alias("n_bad"))


@query(f"{_RUNS} SELECT run_id, n_ok, n_bad FROM runs")
def run_counts(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d).select("run_id", "n_ok", "n_bad")


@query(f"""{_RUNS} SELECT source, CAST(max(CAST(started_at AS DATE)) AS VARCHAR) AS last_run, CAST(DATE '{TODAY}' - max(CAST(started_at AS DATE)) AS BIGINT) AS days_since, DATE '{TODAY}' - max(CAST(started_at AS DATE)) > 9 AS is_overdue
FROM runs WHERE n_ok + n_bad >= 30 GROUP BY source""")
def run_overdue(spark: SparkSession, d: str) -> DataFrame:
    last = _runs(spark, d).where("n_ok + n_bad >= 30").groupBy("source").agg(F.max(F.to_date("started_at")).alias("day"))
    gone = F.datediff(_today(), "day")
    return last.select("source", F.date_format("day", "yyyy-MM-dd").alias("last_run"), gone.cast("bigint").alias("days_since"), (gone > 9).alias("is_overdue"))


@query(f"{_RUNS} SELECT run_id, source, n_ok FROM (SELECT *, max(n_ok) OVER (PARTITION BY source) AS most FROM runs) WHERE n_ok >= 30 AND 2 * n_ok < most")
def short_run(spark: SparkSession, d: str) -> DataFrame:
    runs = _runs(spark, d)
    most = runs.groupBy("source").agg(F.max("n_ok").alias("most"))
    return runs.join(F.broadcast(most), "source").where("n_ok >= 30 and 2 * n_ok < most").select("run_id", "source", "n_ok")


@query("SELECT total_citations, h_index, works_count, count(DISTINCT person_id) AS n_people FROM latest WHERE source = 'openalex' AND total_citations > 0 AND h_index IS NOT NULL AND works_count IS NOT NULL GROUP BY ALL HAVING count(DISTINCT person_id) > 1")
def repeated_records(spark: SparkSession, d: str) -> DataFrame:
    rows = M.latest_readings(readings(spark, d)).where("source = 'openalex' and total_citations > 0 and h_index is not null and works_count is not null")
    people = rows.select("person_id", "total_citations", "h_index", "works_count").distinct()
    return people.groupBy("total_citations", "h_index", "works_count").agg(F.count(F.lit(1)).alias("n_people")).where("n_people > 1")


@query(f"""{_RUNS}, wanted AS (SELECT source AS k, list(CAST(run_id AS VARCHAR)) AS members FROM runs WHERE n_bad >= 5 GROUP BY source),
tracked AS (SELECT source AS k, CASE WHEN source IN ('pop', 'manual') THEN 'closed' ELSE 'open' END AS state, list(CAST(run_id AS VARCHAR)) AS shown FROM runs WHERE n_bad >= 3 AND source <> 'google_scholar' GROUP BY source)
SELECT coalesce(w.k, t.k) AS "key", CASE WHEN t.k IS NULL THEN 'create' WHEN w.k IS NULL THEN CASE WHEN state = 'open' THEN 'close' ELSE 'none' END WHEN list_has_all(shown, members) THEN 'none' WHEN state = 'closed' THEN 'reopen' ELSE 'comment' END AS action
FROM wanted w FULL JOIN tracked t ON w.k = t.k""")
def issue_plan(spark: SparkSession, d: str) -> DataFrame:
    runs = _runs(spark, d)
    ids = F.collect_set(F.col("run_id").cast("string"))
    wanted = runs.where("n_bad >= 5").groupBy(F.col("source").alias("key")).agg(ids.alias("members"))
    tracked = runs.where("n_bad >= 3 and source <> 'google_scholar'").groupBy(F.col("source").alias("key")).agg(ids.alias("shown")).withColumn("state", F.when(F.col("key").isin("pop", "manual"), "closed").otherwise("open"))
    return P.reconcile(wanted, tracked)


@query("SELECT source, strftime(max(delivered_on), '%Y-%m-%d') AS last_delivery FROM snapshot_delivery GROUP BY source")
def snapshot_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "snapshot_delivery").groupBy("source").agg(F.date_format(F.max("delivered_on"), "yyyy-MM-dd").alias("last_delivery"))


@query("SELECT count(*) AS searched, count(*) FILTER (status = 'none') AS no_links, count(*) FILTER (status = 'accepted') AS found, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'pending') AS waiting FROM identity_candidates")
def batch_report(spark: SparkSession, d: str) -> DataFrame:
    n = lambda s: F.count_if(F.col("status") == s)
    return table(spark, d, "identity_candidates").agg(F.count(F.lit(1)).alias("searched"), n("none").alias("no_links"), n("accepted").alias("found"), n("rejected").alias("rejected"), n("pending").alias("waiting"))


@query(f"""{_RUNS} SELECT source, string_agg(run_id || ':' || n_ok, ';' ORDER BY run_id) AS history, CAST(max(run_id) AS BIGINT) AS last_at FROM (SELECT * FROM runs WHERE n_ok IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_id DESC) <= 10) GROUP BY source""")
def status_history(spark: SparkSession, d: str) -> DataFrame:
    return P.fold_history(_runs(spark, d).where("n_ok is not null"), "source", "run_id", F.concat_ws(":", F.col("run_id").cast("string"), F.col("n_ok").cast("string")))


@query(f"{_RUNS} SELECT 'runs-' || source AS \"key\", count(*) AS n FROM runs WHERE n_bad >= 5 GROUP BY source")
def issue_marker(spark: SparkSession, d: str) -> DataFrame:
    """Keys and members through the text form and back."""
    rows = _runs(spark, d).where("n_bad >= 5").groupBy("source").agg(F.collect_list(F.col("run_id").cast("string")).alias("m"))  # runs of a fixed table
    body = rows.select(P.marker(F.concat(F.lit("runs-"), F.col("source")), F.col("m")).alias("body"))
    return body.select(P.marker_key(F.col("body")).alias("key"), F.size(P.marker_members(F.col("body"))).cast("bigint").alias("n"))


# ------------------------------------------------------------ page datasets
_YEARS = """, payload AS (SELECT person_id, arg_max(raw_json, (delivered_on, delivery_row_id)) AS j FROM snapshot_delivery
  WHERE source = 'google_scholar' AND json_valid(raw_json) AND json_type(raw_json, '$.cites_per_year') = 'OBJECT' GROUP BY person_id),
cells AS (SELECT person_id, CAST(k AS BIGINT) AS y, CAST(json_extract(j, '$.cites_per_year."' || k || '"') AS BIGINT) AS n FROM (SELECT person_id, j, unnest(json_keys(j, '$.cites_per_year')) AS k FROM payload)),
ends AS (SELECT person_id, min(y) FILTER (n > 0) AS a, max(y) AS b FROM cells GROUP BY person_id HAVING count(*) FILTER (n > 0) > 1),
series AS (SELECT person_id, e.y AS "year", coalesce(c.n, 0) AS n FROM (SELECT person_id, unnest(range(a, b + 1)) AS y FROM ends) e LEFT JOIN cells c USING (person_id, y))"""


def _payloads(spark, d):
    rows = table(spark, d, "snapshot_delivery").where("source = 'google_scholar' and raw_json is not null")
    graph = F.get_json_object("raw_json", "$.cites_per_year")
    rows = rows.where(graph.startswith("{") & F.get_json_object("raw_json", "$").isNotNull())
    rows = rows.groupBy("person_id").agg(F.max_by(F.struct(graph.alias("g"), "collected_at", "total_citations"), F.struct("delivered_on", "delivery_row_id")).alias("r"))
    years = F.transform(F.map_entries(F.from_json("r.g", "map<string,bigint>")), lambda e: F.struct(e["key"].try_cast("bigint").alias("year"), e["value"].alias("n")))
    return rows.select("person_id", F.col("r.collected_at").alias("collected_at"), years.alias("years"))


@query(f"{_YEARS} SELECT person_id, \"year\", n FROM series")
def yearly_gapfill(spark: SparkSession, d: str) -> DataFrame:
    return V.gap_filled_years(_payloads(spark, d), "person_id")


_ALL_YEARS = """, pay AS (SELECT delivery_row_id, source, CASE WHEN json_valid(raw_json) THEN raw_json END AS j FROM snapshot_delivery),
cells AS (SELECT delivery_row_id, CAST(k AS BIGINT) AS y, CAST(json_extract(j, '$.cites_per_year."' || k || '"') AS BIGINT) AS n FROM (SELECT delivery_row_id, j, unnest(json_keys(j, '$.cites_per_year')) AS k FROM pay WHERE source = 'google_scholar' AND json_type(j, '$.cites_per_year') = 'OBJECT')
  UNION ALL SELECT delivery_row_id, CAST(e ->> '$.year' AS BIGINT), coalesce(CAST(e ->> '$.cited_by_count' AS BIGINT), 0) FROM (SELECT delivery_row_id, unnest(CAST(json_extract(j, '$.counts_by_year[*]') AS JSON[])) AS e FROM pay WHERE source = 'openalex' AND json_type(j, '$.counts_by_year') = 'ARRAY'
    AND NOT coalesce(json_type(j, '$.records') = 'ARRAY' AND json_array_length(j, '$.records') > 0 OR json_type(j, '$.records') = 'OBJECT', false)) WHERE e ->> '$.year' IS NOT NULL),
ends AS (SELECT delivery_row_id, min(y) FILTER (n > 0) AS a, max(y) AS b FROM cells GROUP BY delivery_row_id HAVING count(*) FILTER (n > 0) > 1)
SELECT delivery_row_id, e.y AS "year", coalesce(c.n, 0) AS n FROM (SELECT delivery_row_id, unnest(range(a, b + 1)) AS y FROM ends) e LEFT JOIN cells c USING (delivery_row_id, y)"""


@query(_ALL_YEARS)
def yearly_counts(spark: SparkSession, d: str) -> DataFrame:
    """Gap-filled years of every delivered payload: the profile's own map, or the list of a single record; summed records have none."""
    rows = table(spark, d, "snapshot_delivery").select("delivery_row_id", "source", "raw_json").where(F.get_json_object("raw_json", "$").isNotNull())
    part = lambda k: F.get_json_object("raw_json", k)
    own = F.transform(F.map_entries(F.from_json(part("$.cites_per_year"), "map<string,bigint>")), lambda e: F.struct(e["key"].try_cast("bigint").alias("year"), F.coalesce(e["value"], F.lit(0)).alias("n")))
    listed = F.transform(F.from_json(part("$.counts_by_year"), "array<struct<year: string, cited_by_count: string>>"), lambda e: F.struct(e["year"].try_cast("bigint").alias("year"), F.coalesce(e["cited_by_count"].try_cast("bigint"), F.lit(0)).alias("n")))
    summed = F.coalesce(part("$.records").rlike(r"^\s*(?:\[\s*[^\]\s]|\{)"), F.lit(False))
    years = F.when((F.col("source") == "google_scholar") & part("$.cites_per_year").startswith("{"), own).when((F.col("source") == "openalex") & part("$.counts_by_year").startswith("[") & ~summed, listed)
    counts = rows.select("delivery_row_id", F.filter(years, lambda y: y["year"].isNotNull()).alias("years")).where("years is not null")
    return V.gap_filled_years(counts, "delivery_row_id")


@query(f"{_YEARS}, tail AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY \"year\" DESC) AS i FROM series QUALIFY i <= 20) SELECT person_id, count(*) AS n_points, arg_max(\"year\", (n, -\"year\")) AS peak_year, max(n) AS peak FROM tail GROUP BY person_id")
def year_chart(spark: SparkSession, d: str) -> DataFrame:
    return V.chart_points(V.gap_filled_years(_payloads(spark, d), "person_id"), "person_id")


@query(f"""{_YEARS}, read AS (SELECT p.person_id, CAST(s.collected_at AS DATE) AS r FROM payload p JOIN (SELECT person_id, arg_max(collected_at, (delivered_on, delivery_row_id)) AS collected_at FROM snapshot_delivery
  WHERE source = 'google_scholar' AND json_valid(raw_json) AND json_type(raw_json, '$.cites_per_year') = 'OBJECT' GROUP BY person_id) s USING (person_id)),
gains AS (SELECT person_id, CAST(coalesce(sum(n) FILTER (y = year(r)), 0) + round_even(coalesce(sum(n) FILTER (y = year(r) - 1), 0) * (1 - (dayofyear(r) - 1) / 365e0), 0) AS BIGINT) AS gain FROM read JOIN cells USING (person_id) GROUP BY person_id, r),
ranked AS (SELECT m.person_id, m.rank_name, g.gain, row_number() OVER (PARTITION BY m.rank_name ORDER BY g.gain DESC, m.display_name, m.person_id) AS place FROM (SELECT DISTINCT person_id, rank_name, display_name, total_citations FROM members) m JOIN gains g USING (person_id)
  WHERE m.total_citations >= 100 AND g.gain > 0 AND m.rank_name IN ('assistant', 'associate', 'full'))
SELECT person_id, rank_name, gain, place FROM ranked WHERE place <= 5""")
def rising_top5(spark: SparkSession, d: str) -> DataFrame:
    people, dep = table(spark, d, "person"), table(spark, d, "department")
    ranked = M.ranked_people(_current(spark, d), dep, people, M.headline(readings(spark, d), people)).select("person_id", "rank_name", "display_name", "total_citations").distinct()
    read = F.to_date("collected_at")
    of = lambda y: F.get(F.filter("years", lambda e: e["year"] == y), 0)["n"]
    gains = _payloads(spark, d).withColumn("gain", V.yearly_gain(of(F.year(read)), of(F.year(read) - 1), read)).select("person_id", "gain")
    rows = ranked.where("total_citations >= 100 and rank_name in ('assistant', 'associate', 'full')").join(gains.where("gain > 0"), "person_id")
    place = F.row_number().over(Window.partitionBy("rank_name").orderBy(F.desc("gain"), "display_name", "person_id"))
    return rows.withColumn("place", place).where("place <= 5").select("person_id", "rank_name", "gain", F.col("place").cast("bigint").alias("place"))


@query("""SELECT person_id, CASE WHEN v <= s THEN s WHEN v <= 2 * s THEN 2 * s WHEN v <= 5 * s THEN 5 * s ELSE 10 * s END AS axis_top FROM (
  SELECT person_id, v, CAST(10 ** (length(CAST(v AS VARCHAR)) - 1) AS BIGINT) AS s FROM (SELECT person_id, greatest(coalesce(total_citations, 0), 1) AS v FROM heads))""")
def axis_top(spark: SparkSession, d: str) -> DataFrame:
    heads = M.headline(readings(spark, d), table(spark, d, "person"))
    return heads.select("person_id", V.axis_top(F.col("total_citations")).alias("axis_top"))


@query("""SELECT person_id, CASE WHEN count(*) OVER (PARTITION BY s) > 1 THEN s || '-' || person_id ELSE s END AS slug FROM (
  SELECT person_id, regexp_replace(regexp_replace(strip_accents(lower(display_name)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM person)""")
def uniq_slugs(spark: SparkSession, d: str) -> DataFrame:
    return V.unique_slugs(table(spark, d, "person"), "person_id", "display_name")


@query("""SELECT person_id, p || CASE WHEN p % 100 BETWEEN 10 AND 20 THEN 'th' WHEN p % 10 = 1 THEN 'st' WHEN p % 10 = 2 THEN 'nd' WHEN p % 10 = 3 THEN 'rd' ELSE 'th' END AS standing FROM (
  SELECT person_id, CAST(round_even(100 * percent_rank() OVER (ORDER BY total_citations NULLS FIRST), 0) AS BIGINT) AS p FROM heads)""")
def percentile_ordinals(spark: SparkSession, d: str) -> DataFrame:
    heads = M.headline(readings(spark, d), table(spark, d, "person")).select("person_id", "total_citations")
    return with_ranks(heads, "total_citations", {"percent_rank": "share"}).select("person_id", V.ordinal(F.col("share")).alias("standing"))


_INDEX = """, idx AS (SELECT 'p' || m.person_id AS "key", m.display_name AS name, m.department AS place_name, m.total_citations AS weight FROM (SELECT DISTINCT person_id, display_name, department, total_citations FROM members) m
  UNION ALL SELECT 'd' || department_id, short_name, university, NULL FROM department)"""


def _index(spark, d):
    people, dep = table(spark, d, "person"), table(spark, d, "department")
    ranked = M.ranked_people(_current(spark, d), dep, people, M.headline(readings(spark, d), people)).select("person_id", "display_name", "department", "total_citations").distinct()
    a = ranked.select(F.concat(F.lit("p"), F.col("person_id").cast("string")).alias("key"), F.col("display_name").alias("name"), F.col("department").alias("place_name"), F.col("total_citations").alias("weight"))
    b = dep.select(F.concat(F.lit("d"), F.col("department_id").cast("string")).alias("key"), F.col("short_name").alias("name"), F.col("university").alias("place_name"), F.lit(None).cast("bigint").alias("weight"))
    return a.unionByName(b)


@query(f"{_INDEX} SELECT * FROM idx")
def search_index(spark: SparkSession, d: str) -> DataFrame:
    return _index(spark, d)


_SW = "trim(regexp_replace(strip_accents(lower({c})), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""{_INDEX}, w AS (SELECT *, {_SW.format(c='name')} AS n, {_SW.format(c="coalesce(place_name, '')")} AS p FROM idx)
SELECT "key", name, place_name, weight, CAST(score AS BIGINT) AS score FROM (SELECT *, CASE WHEN n = 'penbrook univ' THEN 0 WHEN starts_with(n, 'penbrook univ') THEN 1
  WHEN (SELECT bool_and(len(list_filter(string_split(n, ' '), lambda x: starts_with(x, t))) > 0) FROM unnest(['penbrook', 'univ']) u(t)) THEN 2 WHEN contains(n, 'penbrook univ') THEN 3
  WHEN (SELECT bool_and(len(list_filter(string_split(n || ' ' || p, ' '), lambda x: starts_with(x, t))) > 0) FROM unnest(['penbrook', 'univ']) u(t)) THEN 4 WHEN contains(p, 'penbrook univ') THEN 5 END AS score FROM w)
WHERE score IS NOT NULL ORDER BY score, coalesce(weight, 0) DESC, "key" LIMIT 12""")
def token_prefix_search(spark: SparkSession, d: str) -> DataFrame:
    return V.search(_index(spark, d), "penbrook univ")


@query("SELECT affiliation_id, CASE WHEN y >= 14 THEN 'A' WHEN y >= 10 THEN 'B' ELSE 'C' END AS band FROM (SELECT affiliation_id, (DATE '2026-11-20' - start_day) // 365 AS y FROM cur WHERE start_day IS NOT NULL) WHERE y >= 7")
def rank_bands(spark: SparkSession, d: str) -> DataFrame:
    years = F.floor(F.datediff(_today(), "start_day") / 365)
    rows = _current(spark, d).where("start_day is not null").withColumn("y", years).where("y >= 7")
    return rows.select("affiliation_id", F.when(F.col("y") >= 14, "A").when(F.col("y") >= 10, "B").otherwise("C").alias("band"))


@query("SELECT person_id, rank_name, total_citations, row_number() OVER (ORDER BY total_citations DESC NULLS LAST, person_id) AS place FROM (SELECT DISTINCT person_id, rank_name, total_citations FROM members WHERE rank_name = 'full') ORDER BY place LIMIT 100")
def filtered_table(spark: SparkSession, d: str) -> DataFrame:
    """The first page of a filtered, sorted and renumbered table, blanks last."""
    people, dep = table(spark, d, "person"), table(spark, d, "department")
    rows = M.ranked_people(_current(spark, d), dep, people, M.headline(readings(spark, d), people)).where("rank_name = 'full'").select("person_id", "rank_name", "total_citations").distinct()
    page = rows.orderBy(F.desc_nulls_last("total_citations"), "person_id").limit(100)
    return page.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last("total_citations"), "person_id")).cast("bigint"))


@query("SELECT person_id, candidate_id FROM identity_candidates WHERE status = 'accepted' AND reviewed_at >= '2026-06-01'")
def discovery_finds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "identity_candidates").where("status = 'accepted' and reviewed_at >= '2026-06-01'").select("person_id", "candidate_id")

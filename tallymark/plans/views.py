"""Queries of the view graph and of the embedded selections over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.operators import metrics as M
from tallymark.operators.ranking import value_ranks
from tallymark.plans.base_sql import BASE
from tallymark.session import table
from tallymark.sources.standard import appointments, moment_text, readings

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = BASE + sql
        return f

    return add


def _current(spark, d):
    return M.current_appointments(appointments(spark, d), table(spark, d, "department"))


def _latest(spark, d, payload: bool = False):
    return M.latest_readings(readings(spark, d, payload))


def _heads(spark, d):
    return M.headline(readings(spark, d), table(spark, d, "person"))


def _ranked(spark, d):
    return M.ranked_people(_current(spark, d), table(spark, d, "department"), table(spark, d, "person"), _heads(spark, d))


_APPT = ["affiliation_id", "person_id", "department_id", "rank_name", "start_day", "source"]
_READ = ["snapshot_id", "run_id", "person_id", "source", "day", "total_citations", "h_index", "i10_index", "citations_5yr", "h_index_5yr", "works_count"]


@query(f"SELECT {', '.join(_APPT)}, kind FROM cur")
def current_appointments(spark: SparkSession, d: str) -> DataFrame:
    return _current(spark, d).select(*_APPT, "kind")


@query(f"SELECT {', '.join(_APPT)} FROM cur WHERE kind = 'planning'")
def current_affiliations(spark: SparkSession, d: str) -> DataFrame:
    return _current(spark, d).where("kind = 'planning'").select(*_APPT)


@query(f"SELECT {', '.join(_READ)} FROM latest")
def latest_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d).select(*_READ)


@query(f"SELECT {', '.join(_READ)}, is_fallback FROM heads")
def headline_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _heads(spark, d).select(*_READ, "is_fallback")


@query(f"SELECT {', '.join('l.' + c for c in _READ)} FROM latest l WHERE source = 'google_scholar' AND EXISTS (SELECT 1 FROM person p WHERE p.person_id = l.person_id AND p.google_scholar_id <> '')")
def scholar_metrics(spark: SparkSession, d: str) -> DataFrame:
    return M.held_readings(_latest(spark, d), table(spark, d, "person"), "google_scholar", "google_scholar_id").select(*_READ)


@query(f"SELECT {', '.join('l.' + c for c in _READ)} FROM latest l WHERE source = 'openalex' AND EXISTS (SELECT 1 FROM person p WHERE p.person_id = l.person_id AND p.openalex_author_id <> '')")
def openalex_metrics(spark: SparkSession, d: str) -> DataFrame:
    return M.held_readings(_latest(spark, d), table(spark, d, "person"), "openalex", "openalex_author_id").select(*_READ)


_PCT = """pct AS (SELECT *,
  percent_rank() OVER (ORDER BY total_citations NULLS FIRST) AS pct_citations_all, percent_rank() OVER (PARTITION BY rank_name ORDER BY total_citations NULLS FIRST) AS pct_citations_rank,
  percent_rank() OVER (ORDER BY h_index NULLS FIRST) AS pct_h_all, percent_rank() OVER (PARTITION BY rank_name ORDER BY h_index NULLS FIRST) AS pct_h_rank,
  rank() OVER (ORDER BY total_citations DESC NULLS LAST) AS rank_by_citations, rank() OVER (ORDER BY h_index DESC NULLS LAST) AS rank_by_h_index FROM members)
"""


@query(f", {_PCT} SELECT * EXCLUDE (rank_by_citations, rank_by_h_index) FROM pct")
def person_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return M.percentiles(_ranked(spark, d)).drop("rank_by_citations", "rank_by_h_index")


@query(f", {_PCT} SELECT rank_by_citations, rank_by_h_index, person_id, display_name, department, rank_name, source, is_fallback, day, total_citations, h_index, pct_citations_all, pct_citations_rank, pct_h_all, pct_h_rank FROM pct")
def top_faculty(spark: SparkSession, d: str) -> DataFrame:
    return M.percentiles(_ranked(spark, d)).drop("department_id", "years_since_phd", "citations_per_year")


@query("""SELECT p.person_id, p.display_name, c.department_id, d.name AS unit, d.university, c.rank_name, h.source, h.is_fallback, h.day, h.total_citations, h.h_index,
  try_cast(left(h.day, 4) AS BIGINT) - p.phd_year AS years_since_phd,
  CASE WHEN try_cast(left(h.day, 4) AS BIGINT) > p.phd_year THEN h.total_citations / (try_cast(left(h.day, 4) AS BIGINT) - p.phd_year) END AS citations_per_year
FROM cur c, person p, department d, heads h WHERE c.kind = 'other' AND p.person_id = c.person_id AND d.department_id = c.department_id AND h.person_id = c.person_id""")
def other_units(spark: SparkSession, d: str) -> DataFrame:
    return M.other_units(_current(spark, d), table(spark, d, "department"), table(spark, d, "person"), _heads(spark, d))


_SUMMARY = """ord AS (
  SELECT department_id, total_citations AS c, h_index AS h, source, row_number() OVER (PARTITION BY department_id ORDER BY total_citations NULLS FIRST) AS i,
    row_number() OVER (PARTITION BY department_id ORDER BY h_index NULLS FIRST) AS j, count(*) OVER (PARTITION BY department_id) AS n FROM members),
dep AS (
  SELECT department_id, count(*) AS n_faculty, CAST(sum(c) AS BIGINT) AS total_citations, avg(c) AS mean_citations, avg(h) AS mean_h_index, avg(CASE WHEN source = 'google_scholar' THEN 1.0 ELSE 0.0 END) AS share_with_scholar_profile,
    avg(c) FILTER (i = (n + 1) // 2 OR i = (n + 2) // 2) AS median_citations, avg(h) FILTER (j = (n + 1) // 2 OR j = (n + 2) // 2) AS median_h_index FROM ord GROUP BY department_id)
"""


@query(f""", {_SUMMARY} SELECT department_id, short_name, university, country, acsp_member, n_faculty, total_citations, mean_citations, mean_h_index, share_with_scholar_profile, median_citations, median_h_index,
  total_citations / n_faculty AS citations_per_faculty, CASE WHEN n_faculty > 2 THEN rank() OVER (PARTITION BY n_faculty > 2 ORDER BY median_citations DESC NULLS LAST) END AS rank_by_median_citations
FROM dep JOIN department USING (department_id)""")
def department_summary(spark: SparkSession, d: str) -> DataFrame:
    return M.department_summary(_ranked(spark, d), table(spark, d, "department"))


@query("SELECT r.person_id, p.display_name, r.source, r.moment, r.total_citations, r.h_index, r.i10_index, r.citations_5yr FROM rd r JOIN person p USING (person_id)")
def person_timeseries(spark: SparkSession, d: str) -> DataFrame:
    cols = ["person_id", "display_name", "source", "moment", "total_citations", "h_index", "i10_index", "citations_5yr"]
    joined = readings(spark, d).join(table(spark, d, "person").select("person_id", "display_name"), "person_id")
    return joined.orderBy("person_id", "source", "moment").withColumn("moment", moment_text(F.col("moment"))).select(*cols)


@query("""SELECT rank_name, count(*) AS n, quantile_disc(total_citations, 0.5) AS median_citations, quantile_disc(total_citations, 0.75) AS p75_citations, quantile_disc(h_index, 0.5) AS median_h_index
FROM members WHERE source = 'google_scholar' AND total_citations IS NOT NULL AND h_index IS NOT NULL GROUP BY rank_name""")
def rank_benchmarks(spark: SparkSession, d: str) -> DataFrame:
    return M.rank_benchmarks(_current(spark, d), _heads(spark, d))


# ------------------------------------------------------------ selections over the views
@query("SELECT DISTINCT c.person_id, c.department_id FROM cur c LEFT JOIN heads h USING (person_id) WHERE h.person_id IS NULL")
def people_without_figure(spark: SparkSession, d: str) -> DataFrame:
    return _current(spark, d).select("person_id", "department_id").distinct().join(_heads(spark, d).select("person_id"), "person_id", "left_anti")


@query("""SELECT o.person_id, max(o.total_citations) AS openalex_total, max(g.total_citations) AS own_total FROM latest o JOIN latest g ON g.person_id = o.person_id AND g.source = 'google_scholar'
WHERE o.source = 'openalex' AND o.total_citations > g.total_citations GROUP BY o.person_id""")
def summed_above_base(spark: SparkSession, d: str) -> DataFrame:
    latest = _latest(spark, d)
    o = latest.where("source = 'openalex'").select("person_id", F.col("total_citations").alias("o"))
    g = latest.where("source = 'google_scholar'").select("person_id", F.col("total_citations").alias("g"))
    return o.join(g, "person_id").where("o > g").groupBy("person_id").agg(F.max("o").alias("openalex_total"), F.max("g").alias("own_total"))


@query("SELECT person_id, day, total_citations FROM heads WHERE source = 'pop'")
def pop_figures(spark: SparkSession, d: str) -> DataFrame:
    return _heads(spark, d).where("source = 'pop'").select("person_id", "day", "total_citations")


@query("SELECT c.person_id, c.department_id, coalesce(h.source, 'none') AS headline_source FROM cur c LEFT JOIN heads h USING (person_id) WHERE coalesce(h.source, 'none') IN ('pop', 'none')")
def review_scope(spark: SparkSession, d: str) -> DataFrame:
    heads = _heads(spark, d).select("person_id", "source").withColumnRenamed("source", "head")
    joined = _current(spark, d).join(heads, "person_id", "left").select("person_id", "department_id", F.coalesce("head", F.lit("none")).alias("headline_source"))
    return joined.where("headline_source in ('pop', 'none')")


@query("""SELECT person_id, base.s AS source, base.t AS total_citations FROM (SELECT person_id, arg_min({'s': source, 't': total_citations}, (CASE source WHEN 'google_scholar' THEN 0 ELSE 1 END, -snapshot_id)) AS base
FROM latest WHERE source IN ('google_scholar', 'pop') AND total_citations IS NOT NULL GROUP BY person_id)""")
def preferred_base(spark: SparkSession, d: str) -> DataFrame:
    rows = _latest(spark, d).where("source in ('google_scholar', 'pop') and total_citations is not null")
    order = F.struct(F.col("source") != "google_scholar", -F.col("snapshot_id"))
    return rows.groupBy("person_id").agg(F.min_by(F.struct("source", "total_citations"), order).alias("b")).select("person_id", "b.*")


@query("SELECT k.person_id, k.candidate_id, k.external_id, l.total_citations FROM identity_candidates k JOIN latest l ON l.person_id = k.person_id AND l.source = 'openalex' WHERE k.status = 'accepted'")
def accepted_matches(spark: SparkSession, d: str) -> DataFrame:
    mine = table(spark, d, "identity_candidates").where("status = 'accepted'").select("person_id", "candidate_id", "external_id")
    return mine.join(_latest(spark, d).where("source = 'openalex'").select("person_id", "total_citations"), "person_id")


@query("SELECT source, day, count(*) AS n FROM rd GROUP BY source, day")
def as_of_counts(spark: SparkSession, d: str) -> DataFrame:
    return readings(spark, d).groupBy("source", "day").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT min(day) AS oldest FROM heads")
def oldest_reading(spark: SparkSession, d: str) -> DataFrame:
    return _heads(spark, d).agg(F.min("day").alias("oldest"))


@query("SELECT h.source, count(*) AS n FROM cur c JOIN heads h USING (person_id) WHERE kind = 'planning' GROUP BY h.source")
def source_mix(spark: SparkSession, d: str) -> DataFrame:
    return _current(spark, d).where("kind = 'planning'").select("person_id").join(_heads(spark, d).select("person_id", "source"), "person_id").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT max(r) AS typical_share FROM (SELECT r, row_number() OVER (ORDER BY r) AS i, count(*) OVER () AS n FROM (
  SELECT o.total_citations / g.total_citations AS r FROM latest o JOIN latest g USING (person_id) JOIN cur c USING (person_id)
  WHERE o.source = 'openalex' AND g.source = 'google_scholar' AND g.total_citations > 0 AND o.total_citations IS NOT NULL AND c.kind = 'planning')) WHERE i = n // 2 + 1""")
def typical_share_upper_median(spark: SparkSession, d: str) -> DataFrame:
    latest = _latest(spark, d)
    o = latest.where("source = 'openalex' and total_citations is not null").select("person_id", F.col("total_citations").alias("o"))
    g = latest.where("source = 'google_scholar' and total_citations > 0").select("person_id", F.col("total_citations").alias("g"))
    shares = o.join(g, "person_id").join(_current(spark, d).where("kind = 'planning'").select("person_id"), "person_id").select((F.col("o") / F.col("g")).alias("r"))
    ranks = value_ranks(shares, "r")
    return ranks.where("rank_asc <= n div 2 + 1 and n - rank_desc + 1 >= n div 2 + 1").agg(F.max("r").alias("typical_share"))


@query("SELECT person_id, count(*) AS n FROM ap WHERE is_open AND is_primary = 1 GROUP BY person_id HAVING count(*) > 1")
def duplicate_gate(spark: SparkSession, d: str) -> DataFrame:
    return appointments(spark, d).where("is_open and is_primary = 1").groupBy("person_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT snapshot_id, CASE WHEN snapshot_id IN (SELECT snapshot_id FROM latest) THEN raw_json END AS raw_json FROM rd WHERE raw_json IS NOT NULL")
def payload_prune(spark: SparkSession, d: str) -> DataFrame:
    rows = readings(spark, d, payload=True)
    keep = _latest(spark, d).select("snapshot_id", F.lit(True).alias("is_latest"))
    return rows.where("raw_json is not null").select("snapshot_id", "raw_json").join(keep, "snapshot_id", "left").select("snapshot_id", F.when(F.col("is_latest"), F.col("raw_json")).alias("raw_json"))


@query("SELECT h.person_id, h.snapshot_id, r.raw_json FROM heads h JOIN rd r USING (snapshot_id) WHERE r.raw_json IS NOT NULL")
def headline_payload(spark: SparkSession, d: str) -> DataFrame:
    payload = table(spark, d, "metric_snapshot").where("raw_json is not null").select("snapshot_id", "raw_json")
    return _heads(spark, d).select("person_id", "snapshot_id").join(payload, "snapshot_id").select("person_id", "snapshot_id", "raw_json")


@query("""SELECT p.person_id, coalesce(p.orcid, f.orcid) AS orcid, p.orcid IS NULL AND f.orcid IS NOT NULL AS is_filled FROM person p
LEFT JOIN (SELECT person_id, min(orcid) AS orcid FROM identity_candidates WHERE status = 'accepted' GROUP BY person_id) f USING (person_id)""")
def fill_private_attribute(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "identity_candidates").where("status = 'accepted'").groupBy("person_id").agg(F.min("orcid").alias("f"))
    joined = table(spark, d, "person").select("person_id", "orcid").join(found, "person_id", "left")
    return joined.select("person_id", F.coalesce("orcid", "f").alias("orcid"), (F.col("orcid").isNull() & F.col("f").isNotNull()).alias("is_filled"))


@query("SELECT person_id, display_name, department, rank_name, total_citations FROM members ORDER BY coalesce(total_citations, 0) DESC, person_id LIMIT 10")
def leaderboard_top10(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d).select("person_id", "display_name", "department", "rank_name", "total_citations").orderBy(F.coalesce("total_citations", F.lit(0)).desc(), "person_id").limit(10)


@query("SELECT o.person_id, max(o.total_citations / g.total_citations) AS oa_share FROM latest o JOIN latest g USING (person_id) WHERE o.source = 'openalex' AND g.source = 'google_scholar' AND g.total_citations > 0 GROUP BY o.person_id")
def oa_share(spark: SparkSession, d: str) -> DataFrame:
    latest = _latest(spark, d)
    o = latest.where("source = 'openalex'").select("person_id", F.col("total_citations").alias("o"))
    g = latest.where("source = 'google_scholar' and total_citations > 0").select("person_id", F.col("total_citations").alias("g"))
    return o.join(g, "person_id").groupBy("person_id").agg(F.max(F.try_divide("o", "g")).alias("oa_share"))


@query("""SELECT source, max(day) AS as_of FROM (SELECT source, day, count(*) AS n, max(count(*)) OVER (PARTITION BY source) AS most FROM rd WHERE source IS NOT NULL GROUP BY source, day)
WHERE source = 'google_scholar' OR 2 * n >= most GROUP BY source""")
def as_of_dates(spark: SparkSession, d: str) -> DataFrame:
    counts = readings(spark, d).where("source is not null").groupBy("source", "day").agg(F.count(F.lit(1)).alias("n"))
    most = F.max("n").over(Window.partitionBy("source"))
    return counts.withColumn("most", most).where("source = 'google_scholar' or 2 * n >= most").groupBy("source").agg(F.max("day").alias("as_of"))

"""Queries over candidate records, run records and flags that combine several operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import changes as C
from tallymark.operators import landing as L
from tallymark.operators import resolve as R
from tallymark.plans.base_sql import BASE
from tallymark.plans.monitoring import _CASE, _FIELDS, _TWO
from tallymark.plans.views import people_without_figure
from tallymark.session import table
from tallymark.sources.standard import appointments, readings

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = BASE + sql
        return f

    return add


@query(f"""{_TWO}, flags AS (
  SELECT person_id, 'drop' AS flag FROM two WHERE previous > 0 AND latest_total <> 0 AND (previous - latest_total) / previous > 0.2e0
  UNION ALL SELECT person_id, 'field ' || CASE {_CASE} END FROM person WHERE CASE {_CASE} END IS NOT NULL
  UNION ALL SELECT DISTINCT c.person_id, 'no figure' FROM cur c LEFT JOIN heads h USING (person_id) WHERE h.person_id IS NULL)
SELECT person_id, last_name, flag FROM flags JOIN person USING (person_id)""")
def change_flags(spark: SparkSession, d: str) -> DataFrame:
    """Flags of several rules per person, in the order of last names."""
    drops = C.dropped(C.latest_two(readings(spark, d).where("source = 'google_scholar'"), "total_citations")).select("person_id", F.lit("drop").alias("flag"))
    field = C.first_found(F.col("interests"), _FIELDS)
    fields = table(spark, d, "person").select("person_id", F.concat(F.lit("field "), field).alias("flag")).where("flag is not null")
    none = people_without_figure(spark, d).select("person_id").distinct().withColumn("flag", F.lit("no figure"))
    return L.flag_report([drops, fields, none], table(spark, d, "person"))


@query("""SELECT person_id, upper(nullif(regexp_extract(orcid, '(\\d{4}-\\d{4}-\\d{4}-\\d{3}[\\dXx])', 1), '')) AS orcid FROM person WHERE orcid IS NOT NULL""")
def parsed_orcids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "person").where("orcid is not null").select("person_id", L.parse_orcid(F.col("orcid")).alias("orcid"))


@query("""SELECT p.person_id, coalesce(p.openalex_author_id, k.e) AS openalex_author_id FROM person p LEFT JOIN (
  SELECT person_id, min(external_id) AS e FROM identity_candidates WHERE status = 'accepted' AND external_id IS NOT NULL GROUP BY person_id HAVING count(*) = 1) k USING (person_id)""")
def sole_accepted_ids(spark: SparkSession, d: str) -> DataFrame:
    return L.sole_accepted(table(spark, d, "person"), table(spark, d, "identity_candidates"), "openalex_author_id")


@query("""SELECT k.person_id, k.external_id, CASE WHEN p.person_id IS NOT NULL AND k.status <> 'accepted' AND NOT (k.status = 'rejected' AND coalesce(k.reviewed_by, '') LIKE 'reviewer%') THEN 'accepted' ELSE k.status END AS status
FROM identity_candidates k LEFT JOIN person p ON p.person_id = k.person_id AND p.openalex_author_id = k.external_id WHERE k.person_id IS NOT NULL AND k.external_id IS NOT NULL
UNION ALL SELECT p.person_id, p.openalex_author_id, 'accepted' FROM person p WHERE p.openalex_author_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM identity_candidates k WHERE k.person_id = p.person_id AND k.external_id = p.openalex_author_id)""")
def upserted_matches(spark: SparkSession, d: str) -> DataFrame:
    """The queue after the records that people hold an identifier of are accepted or added."""
    queue = table(spark, d, "identity_candidates").where("person_id is not null and external_id is not null")
    found = table(spark, d, "person").where("openalex_author_id is not null").select("person_id", F.col("openalex_author_id").alias("external_id"))
    return L.upsert_matches(queue, found).select("person_id", "external_id", "status")


@query("""SELECT person_id, arg_min(candidate_id, candidate_id) AS candidate_id, arg_min(reviewed_by, candidate_id) AS reviewed_by FROM identity_candidates WHERE status = 'accepted' AND reviewed_by LIKE 'reviewer%' AND external_id IS NOT NULL GROUP BY person_id""")
def settled_matches(spark: SparkSession, d: str) -> DataFrame:
    """The first record of each person that someone accepted by name."""
    rows = table(spark, d, "identity_candidates").where("status = 'accepted' and reviewed_by like 'reviewer%' and external_id is not null")
    return rows.groupBy("person_id").agg(F.min("candidate_id").alias("candidate_id"), F.min_by("reviewed_by", "candidate_id").alias("reviewed_by"))


@query("""SELECT a.person_id, a.external_id FROM identity_candidates a JOIN (SELECT person_id, arg_max({'e': external_id, 'i': last_known_institution}, (coalesce(works_count, 0), coalesce(cited_by_count, 0), -candidate_id)) AS m
  FROM identity_candidates WHERE status IN ('accepted', 'rejected') AND external_id IS NOT NULL GROUP BY person_id) p USING (person_id)
WHERE a.status IN ('accepted', 'rejected') AND a.external_id <> p.m.e AND a.last_known_institution <> p.m.i AND coalesce(CASE WHEN isnan(a.topic_share) THEN NULL ELSE a.topic_share END, 0) < 0.5 AND coalesce(a.works_count, 0) > 3""")
def extra_records(spark: SparkSession, d: str) -> DataFrame:
    """Further records of a person that agree with the main one neither in institution nor in topics."""
    rows = table(spark, d, "identity_candidates").where("status in ('accepted', 'rejected') and external_id is not null and person_id is not null")
    flat = rows.select("person_id", "candidate_id", "external_id", "works_count", "cited_by_count", F.col("last_known_institution").alias("institution"), F.nanvl("topic_share", F.lit(None).cast("double")).alias("topic_share"))
    return L.extra_records_to_review(flat, R.primary_record(flat, "person_id", "external_id", "candidate_id"))


@query("SELECT person_id, department_id, short_name FROM ap JOIN department USING (department_id) WHERE is_open AND is_primary = 1")
def current_members(spark: SparkSession, d: str) -> DataFrame:
    return L.current_members(appointments(spark, d), table(spark, d, "department"))


@query("""SELECT source, day, notes, ids FROM (SELECT source, CAST(CAST(started_at AS DATE) AS VARCHAR) AS day, arg_max({'n': coalesce(notes, '')}, (coalesce(n_attempted, 0) > 0, run_id)).n AS notes, string_agg(DISTINCT CAST(run_id AS VARCHAR), ',' ORDER BY CAST(run_id AS VARCHAR)) AS ids FROM collection_run GROUP BY 1, 2)""")
def merged_run_records(spark: SparkSession, d: str) -> DataFrame:
    """One record per source and day of several runs, with the ids of all of them."""
    runs = table(spark, d, "collection_run").select("source", F.date_format("started_at", "yyyy-MM-dd").alias("day"), F.col("run_id").alias("seq"), F.col("n_attempted").alias("rolling"), F.coalesce("notes", F.lit("")).alias("notes"), F.array(F.col("run_id").cast("string")).alias("stale_ids"))
    return L.merge_run_records(runs).select("source", "day", "notes", F.array_join("stale_ids", ",").alias("ids"))

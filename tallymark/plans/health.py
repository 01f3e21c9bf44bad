"""Health findings, and readings with the appointment of their day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import changes as C
from tallymark.operators import health as H
from tallymark.operators import metrics as M
from tallymark.operators.asof import as_of_join
from tallymark.plans.base_sql import BASE
from tallymark.plans.monitoring import _CASE, _FIELDS, _RUNS, _TWO, _runs
from tallymark.session import materialize, table
from tallymark.sources.standard import appointments, readings
from tallymark.streaming.follow import fold_status

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
#: A Sunday, the eve of a weekly run.
DAY = "2026-11-22"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = BASE + sql
        return f

    return add


_COLL = "(SELECT source, max(CAST(started_at AS DATE)) AS day FROM runs WHERE n_ok + n_bad >= 30 GROUP BY source)"
_LAST = "(SELECT * FROM runs WHERE n_ok + n_bad >= 30 QUALIFY row_number() OVER (PARTITION BY source ORDER BY started_at DESC) = 1)"


@query(f"""{_RUNS.replace(', runs', ', runs', 1)}, {_TWO[2:]}
SELECT 'scholar-overdue' AS rule, CAST(day AS VARCHAR) AS episode, CAST(1 AS BIGINT) AS n, true AS is_alarm FROM {_COLL} WHERE source = 'google_scholar' AND day < DATE '2026-11-16'
UNION ALL SELECT 'openalex-overdue', CAST(day AS VARCHAR), 1, true FROM {_COLL} WHERE source = 'openalex' AND day < DATE '2026-11-15'
UNION ALL SELECT 'short-run', CAST(CAST(started_at AS DATE) AS VARCHAR), coalesce(n_attempted, n_ok + n_bad) - n_ok, true FROM (SELECT l.*, c.n_attempted FROM {_LAST} l JOIN collection_run c USING (run_id)) WHERE source = 'pop' AND (n_ok < 0.9e0 * coalesce(n_attempted, n_ok + n_bad) OR n_bad >= 3)
UNION ALL SELECT 'incomplete', CAST(CAST(started_at AS DATE) AS VARCHAR), n_bad, true FROM {_LAST} WHERE source = 'openalex' AND n_bad >= greatest(5e0, 0.005e0 * (n_ok + n_bad))
UNION ALL SELECT 'dead-ids', e, n, false FROM (SELECT max(day) AS e, count(*) AS n FROM (SELECT p.person_id, max(r.day) AS day FROM person p JOIN rd r ON r.person_id = p.person_id AND r.source = 'google_scholar' WHERE p.google_scholar_id IS NOT NULL GROUP BY p.person_id HAVING count(r.works_count) = 0)) WHERE n > 0
UNION ALL SELECT 'audit-withdrawals', CAST(e AS VARCHAR), n, true FROM (SELECT max(CAST(reviewed_at AS DATE)) AS e, count(DISTINCT person_id) AS n FROM identity_candidates WHERE status = 'rejected' AND CAST(reviewed_at AS DATE) BETWEEN DATE '{DAY}' - 14 AND DATE '{DAY}') WHERE n > 0
UNION ALL SELECT 'repeated-records', '{DAY}', n, true FROM (SELECT (SELECT count(*) FROM (SELECT 1 FROM (SELECT person_id, total_citations AS c, works_count AS w, h_index AS h FROM rd WHERE source = 'openalex') WHERE c >= 20 GROUP BY person_id, c, w, h HAVING count(*) > 1)) + (SELECT count(*) FROM (SELECT 1 FROM latest WHERE source = 'openalex' AND total_citations >= 50 GROUP BY total_citations, works_count, h_index HAVING count(DISTINCT person_id) > 1)) AS n) WHERE n > 0
UNION ALL SELECT 'profile-flags', 'list', n, false FROM (SELECT count(DISTINCT person_id) AS n FROM (SELECT person_id FROM two WHERE previous > 0 AND latest_total <> 0 AND (previous - latest_total) / previous > 0.2e0 UNION ALL SELECT person_id FROM person WHERE CASE {_CASE} END IS NOT NULL)) WHERE n > 0
UNION ALL SELECT 'silent', source || ' ' || CAST(max(CAST(started_at AS DATE)) AS VARCHAR), 7, true FROM collection_run WHERE source IS NOT NULL GROUP BY source HAVING max(CAST(started_at AS DATE)) < DATE '{DAY}' - 8
UNION ALL SELECT 'quota', '2026-11-23', 12, false
UNION ALL SELECT 'site-stale', CAST(max(d) AS VARCHAR), count(*), true FROM (SELECT source, max(delivered_on) AS d, max(delivered_on) FILTER (delivered_on < (SELECT max(delivered_on) FROM snapshot_delivery)) AS live FROM snapshot_delivery GROUP BY source) WHERE live IS NULL OR live < d HAVING count(*) > 0
UNION ALL SELECT 'empty-batch', CAST(max(CAST(started_at AS DATE)) AS VARCHAR), arg_max(n_ok, started_at), true FROM runs WHERE source = 'manual' AND n_ok >= 6 AND CAST(started_at AS DATE) >= DATE '{DAY}' - 30 HAVING count(*) > 0
UNION ALL SELECT 'site-unreachable', '{DAY[:7]}', 1, true UNION ALL SELECT 'self-test', '{DAY}', 1, true""")
def health_findings(spark: SparkSession, d: str) -> DataFrame:
    """All rules on one Sunday. What no table holds is stated here: an account with 12 searches of 50, a site that lacks the newest day and cannot be reached, 7 people waiting, and a test."""
    today = F.to_date(F.lit(DAY))
    runs = _runs(spark, d).join(table(spark, d, "collection_run").select("run_id", "n_attempted"), "run_id")
    none = lambda kind: F.lit(None).cast(kind)
    runs = materialize(runs.select("source", "started_at", F.to_date("started_at").alias("day"), "n_ok", "n_bad", none("bigint").alias("n_dead"), F.col("n_attempted").alias("n_tried"), F.lit(False).alias("is_targeted"), F.lit(False).alias("is_stopped")), "runs")
    people, recs = table(spark, d, "person"), table(spark, d, "identity_candidates")
    rd = readings(spark, d)
    scholar, openalex = rd.where("source = 'google_scholar'"), rd.where("source = 'openalex'")
    held = people.where("google_scholar_id is not null").select("person_id", F.col("google_scholar_id").alias("id"))
    seen = scholar.groupBy("person_id").agg(F.max("day").alias("day"), F.count("works_count").alias("full")).where("full = 0")
    dead = held.join(seen, "person_id").select("id", "day")
    figure = lambda df: df.select("person_id", F.col("total_citations").alias("cites"), F.col("works_count").alias("works"), F.col("h_index").alias("h"))
    drops = C.dropped(C.latest_two(scholar, "total_citations")).select("person_id", F.lit("drop").alias("kind"), F.col("day").alias("which"))
    fields = people.select("person_id", F.lit("field").alias("kind"), C.first_found(F.col("interests"), _FIELDS).alias("which")).where("which is not null")
    status = fold_status(runs.select(F.col("source").alias("stream"), F.col("started_at").alias("at"), F.col("n_ok").alias("searched"), F.lit(7).alias("waiting"), F.lit(0).alias("empty"), F.lit(0).alias("found"), F.lit(False).alias("is_blocked"), F.lit(False).alias("is_skipped")))
    days = table(spark, d, "snapshot_delivery").groupBy("source", F.col("delivered_on").alias("day")).count()
    days = materialize(days, "delivery-days")
    newest = days.agg(F.max("day").alias("_m"))  # one row
    latest = materialize(days.groupBy("source").agg(F.max("day").alias("day")), "held-days")
    live = days.join(F.broadcast(newest)).where("day < _m").groupBy("source").agg(F.max("day").alias("day"))
    batches = runs.where("source = 'manual'").select("day", F.col("n_ok").alias("searched"), F.col("n_ok").alias("empty"))
    account = spark.createDataFrame([(12,)], "n_left bigint")
    due = F.date_trunc("week", today).cast("date")
    parts = [
        H.overdue(runs, "scholar-overdue", "google_scholar", due, today),
        H.overdue(runs, "openalex-overdue", "openalex", F.to_date(F.lit("2026-11-15")), today),
        H.short_run(runs, "pop"),
        H.incomplete(runs, "openalex"),
        H.dead_ids(held, dead),
        H.withdrawals(recs.where("status = 'rejected'").select("person_id", F.to_date("reviewed_at").alias("day")), today),
        H.repeated_records(figure(openalex), figure(M.latest_readings(rd).where("source = 'openalex'")), F.lit(DAY)),
        H.profile_flags(drops.unionByName(fields)).withColumn("episode", F.lit("list")),
        H.silent_or_stalled(status, F.lit(7), today),
        H.quota(account, runs.where("source = 'google_scholar'"), today, 50),
        H.site_stale(live, latest, today),
        H.empty_batch(batches, today, 30),
    ]
    out = H.all_findings(parts)
    return H.all_findings([out, H.told(out, "site-unreachable", F.lit(DAY[:7]), True), H.told(out, "self-test", F.lit(DAY), True)])


@query("""SELECT r.snapshot_id, a.affiliation_id FROM (SELECT snapshot_id, person_id, try_cast(day AS DATE) AS d FROM rd WHERE source = 'openalex') r
ASOF LEFT JOIN (SELECT person_id, start_day, max(affiliation_id) AS affiliation_id FROM ap WHERE is_primary = 1 AND start_day IS NOT NULL GROUP BY person_id, start_day) a ON a.person_id = r.person_id AND r.d >= a.start_day""")
def appointment_at_reading(spark: SparkSession, d: str) -> DataFrame:
    """Each reading with the primary appointment that began last before it."""
    left = readings(spark, d).where("source = 'openalex'").select("snapshot_id", "person_id", F.col("day").try_cast("date").alias("at"))
    right = appointments(spark, d).where("is_primary = 1").select("person_id", F.col("start_day").alias("at"), "affiliation_id")
    return as_of_join(left, right, ["person_id"], "at", ["affiliation_id"]).select("snapshot_id", "affiliation_id")

"""Health rules over run records, figures and reports: one DataFrame each, all of one schema.

A finding is (rule, episode, n, is_alarm): which rule, which occurrence of it, how many things
it lists, and whether it is an alarm or only a notice. A rule without a finding gives no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run with this many attempts is a collection and not a repair; one that reads less than the share is short.
COLLECTION_FROM, SHORT_SHARE, MOST_ERRORS = 30, 0.9, 3
#: A full run may miss this many, or this share of its people.
MISSED_FROM, MISSED_SHARE = 5, 0.005
#: Identical figures above these are one record: of one person, of two people.
REPEAT_CITES, SHARED_CITES = 20, 50
SILENT_DAYS, AUDIT_DAYS = 8, 14
BATCH_FROM, BATCH_EMPTY = 6, 0.8
FINDING = "rule string, episode string, n bigint, is_alarm boolean"


def _rows(df: DataFrame, rule: str, episode: Column, n: Column, alarm: Column | bool = True) -> DataFrame:
    alarm = F.lit(alarm) if isinstance(alarm, bool) else alarm
    return df.select(F.lit(rule).alias("rule"), episode.cast("string").alias("episode"), n.cast("bigint").alias("n"), alarm.alias("is_alarm"))


def _one(df: DataFrame, rule: str, episode: Column, n: Column, alarm: Column | bool = True) -> DataFrame:
    """One finding of everything listed, none for an empty list."""
    return _rows(df.agg(n.alias("n"), episode.alias("e")).where("n > 0"), rule, F.col("e"), F.col("n"), alarm)


def collections(runs: DataFrame) -> DataFrame:
    """Runs (source, day, n_ok, n_bad, n_dead, n_tried, is_targeted, is_stopped) that collected and did not repair."""
    return runs.where((F.col("n_ok") + F.col("n_bad") >= COLLECTION_FROM) & ~F.coalesce("is_targeted", F.lit(False)))


def overdue(runs: DataFrame, rule: str, source: str, due: Column, today: Column) -> DataFrame:
    """The last collection of the source is older than the one that was due before today."""
    last = collections(runs).where(F.col("source") == source).agg(F.max("day").alias("day"))
    late = (F.col("day").isNull() | (F.col("day") < due)) & (today > due)
    return _rows(last.where(late), rule, F.coalesce(F.col("day").cast("string"), F.lit("never")), F.lit(1))


def _latest(runs: DataFrame, source: str) -> DataFrame:
    cols = [c for c in runs.columns if c != "source"]
    return collections(runs).where(F.col("source") == source).agg(F.max_by(F.struct(*cols), "day").alias("r")).where("r is not null").select("r.*")


def short_run(runs: DataFrame, source: str) -> DataFrame:
    """The latest collection read too few of those it set out to; a dead id is answered and not missed."""
    r = _latest(runs, source)
    tried = F.coalesce("n_tried", F.col("n_ok") + F.col("n_bad"))
    dead = F.coalesce("n_dead", F.lit(0))
    return _rows(r.where((tried > 0) & ((F.col("n_ok") + dead < SHORT_SHARE * tried) | (F.col("n_bad") - dead >= MOST_ERRORS))), "short-run", F.col("day"), tried - F.col("n_ok"))


def incomplete(runs: DataFrame, source: str) -> DataFrame:
    """The latest full collection was stopped or missed many."""
    r = _latest(runs, source)
    size = F.col("n_ok") + F.col("n_bad")
    return _rows(r.where(F.coalesce("is_stopped", F.lit(False)) | (F.col("n_bad") >= F.greatest(F.lit(float(MISSED_FROM)), MISSED_SHARE * size))), "incomplete", F.col("day"), F.col("n_bad"))


def dead_ids(held: DataFrame, dead: DataFrame) -> DataFrame:
    """Ids on file that were found dead: held (person_id, id), dead (id, day). A notice."""
    return _one(held.join(dead.groupBy("id").agg(F.max("day").alias("day")), "id"), "dead-ids", F.max("day"), F.count(F.lit(1)), False)


def repeated_inside(records: DataFrame) -> DataFrame:
    """Records (person_id, cites, works, h) of one person with identical figures: (person_id, k) per repeated figure."""
    return records.where(F.col("cites") >= REPEAT_CITES).groupBy("person_id", "cites", "works", "h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("person_id", "k")


def repeated_across(totals: DataFrame) -> DataFrame:
    """Totals (person_id, cites, works, h) that several people share: one row per figure with their number."""
    people = totals.where(F.col("cites") >= SHARED_CITES).select("person_id", "cites", "works", "h").distinct()
    return people.groupBy("cites", "works", "h").agg(F.count(F.lit(1)).alias("k")).where("k > 1")


def repeated_records(records: DataFrame, totals: DataFrame, episode: Column) -> DataFrame:
    both = repeated_inside(records).select("k").unionByName(repeated_across(totals).select("k"))
    return _one(both, "repeated-records", F.max(episode), F.count(F.lit(1)))


def withdrawals(rows: DataFrame, today: Column) -> DataFrame:
    """Matches (person_id, day) that an audit withdrew of late."""
    recent = rows.where((F.col("day") >= F.date_sub(today, AUDIT_DAYS)) & (F.col("day") <= today))
    return _one(recent, "audit-withdrawals", F.max("day"), F.count_distinct("person_id"))


def profile_flags(flags: DataFrame) -> DataFrame:
    """Signs (person_id, kind, which) that a held profile is somebody else's. The episode tells the list: another list is another occurrence. A notice."""
    listed = F.hex(F.sum(F.xxhash64("person_id", "kind", "which").cast("decimal(38,0)")).cast("string"))
    return _one(flags, "profile-flags", listed, F.count_distinct("person_id"), False)


def empty_batch(batches: DataFrame, today: Column, days: int = 7) -> DataFrame:
    """The last batch (day, searched, empty) of the week in which nearly every search showed nothing."""
    bad = batches.where((F.col("searched") >= BATCH_FROM) & (F.col("day") >= F.date_sub(today, days)) & (F.col("empty") >= BATCH_EMPTY * F.col("searched")))
    last = bad.agg(F.max_by(F.struct("day", "empty"), "day").alias("r")).where("r is not null").select("r.*")
    return _rows(last, "empty-batch", F.col("day"), F.col("empty"))


def silent_or_stalled(status: DataFrame, queued: Column, today: Column) -> DataFrame:
    """People wait and a stream (stream, reported, stalled_since) has not reported, or has served no one since a day."""
    rows = status.where(queued > 0)
    quiet = F.col("reported").isNull() | (F.to_date("reported") < F.date_sub(today, SILENT_DAYS))
    rule = F.when(quiet, "silent").when(F.col("stalled_since").isNotNull(), "stalled")
    episode = F.concat_ws(" ", "stream", F.when(quiet, F.coalesce(F.to_date("reported").cast("string"), F.lit("never"))).otherwise(F.col("stalled_since").cast("string")))
    return rows.select(rule.alias("rule"), episode.alias("episode"), queued.cast("bigint").alias("n"), F.lit(True).alias("is_alarm")).where("rule is not null")


def quota(account: DataFrame, last_run: DataFrame, today: Column, budget: int) -> DataFrame:
    """The account (n_left) does not hold the budget of the run of the coming Monday; asked on its eve, or on the day until it has run. An alarm only if nothing is left."""
    weekday = F.weekday(today)  # Monday is 0
    monday = F.date_add(today, F.pmod(F.lit(7) - weekday, F.lit(7)))
    rows = account.join(F.broadcast(last_run.agg(F.max("day").alias("day"))))  # one row each
    soon = (weekday == 6) | ((weekday == 0) & (F.col("day").isNull() | (F.col("day") < today)))
    return _rows(rows.where(soon & (F.col("n_left") < budget)), "quota", monday, F.col("n_left"), F.col("n_left") == 0)


def site_stale(live: DataFrame, held: DataFrame, today: Column) -> DataFrame:
    """Sources (source, day) whose newest snapshot of before today the live site lacks."""
    j = held.join(live.select("source", F.col("day").alias("_live")), "source", "left")
    return _one(j.where((F.col("day") < today) & (F.col("_live").isNull() | (F.col("_live") < F.col("day")))), "site-stale", F.max("day"), F.count(F.lit(1)))


def told(findings: DataFrame, rule: str, episode: Column, raised: bool) -> DataFrame:
    """A finding that is reported to the check itself: a job that ended badly, a site out of reach, a test."""
    spark = findings.sparkSession
    return _rows(spark.range(1 if raised else 0), rule, episode, F.lit(1))


def job_ended(findings: DataFrame, result: str, explained_by: list[str], today: Column) -> DataFrame:
    """The collection's job did not succeed and none of the more specific rules explains it."""
    spark = findings.sparkSession
    bad = spark.range(1 if result not in ("", "success") else 0).withColumn("_k", F.lit(1))
    other = findings.where(F.col("rule").isin(*explained_by)).select(F.lit(1).alias("_k")).distinct()
    return _rows(bad.join(other, "_k", "left_anti"), "job", today, F.lit(1))


def all_findings(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)

"""The domain tables with evened-out spellings and typed dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.text import flexible_date, rank_name, source_name
from tallymark.session import table


def moment(c: Column) -> Column:
    """Sortable number of a written moment: the day's eight digits, then nine of the time of day; else null.

    Takes ISO 8601 in extended or basic form; what is not written of the time counts as 0.
    """
    t = F.trim(c)
    digits = F.rpad(F.regexp_replace(t, r"\D", ""), 17, "0")
    return F.when(t.rlike(r"^(?:\d{4}-\d{2}-\d{2}|\d{8}(?:\D|$))"), digits.cast("bigint"))


def day_of(moment: Column) -> Column:
    """Day of a moment as 'YYYY-MM-DD'."""
    t = F.lpad(F.call_function("div", moment, F.lit(1_000_000_000)).cast("string"), 8, "0")
    return F.concat(F.substring(t, 1, 4), F.lit("-"), F.substring(t, 5, 2), F.lit("-"), F.substring(t, 7, 2))


def moment_text(moment: Column) -> Column:
    """A moment as text: its day, 'T' and nine digits of the time of day."""
    return F.concat(day_of(moment), F.lit("T"), F.lpad((moment % 1_000_000_000).cast("string"), 9, "0"))


def readings(spark: SparkSession, sf_dir: str, payload: bool = False) -> DataFrame:
    """metric_snapshot with evened-out source, ``moment`` and ``day``; the payload only on request."""
    df = table(spark, sf_dir, "metric_snapshot")
    keep = ["total_citations", "h_index", "i10_index", "citations_5yr", "h_index_5yr", "works_count", *(["raw_json"] if payload else [])]
    df = df.select("snapshot_id", "run_id", "person_id", source_name(F.col("source")).alias("source"), moment(F.col("collected_at")).alias("moment"), *keep)
    return df.select("snapshot_id", "run_id", "person_id", "source", "moment", day_of(F.col("moment")).alias("day"), *keep)


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """affiliation with evened-out rank and dates; ``is_open`` where no end was written."""
    return table(spark, sf_dir, "affiliation").select(
        "affiliation_id",
        "person_id",
        "department_id",
        rank_name(F.col("rank")).alias("rank_name"),
        "appointment_type",
        "is_primary",
        flexible_date(F.col("start_date")).alias("start_day"),
        flexible_date(F.col("end_date")).alias("end_day"),
        F.col("end_date").isNull().alias("is_open"),
        "source",
    )

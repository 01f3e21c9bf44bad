"""Numeric contradiction of accepted records, and acceptance with a running total."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ratios beyond which a figure contradicts the base, and the least base that judges.
MAX_RATIO, MIN_RATIO, MIN_BASE = 3.0, 0.05, 25
SETTLE_NAME, SETTLE_RATIO, SIBLING_SUM_RATIO, FRAGMENT_WORKS, SIBLING_TOPIC = 0.95, 1.5, 1.2, 3, 0.5


def implausible(figure: Column, base: Column, high_only: bool = False) -> Column:
    """The ratio to the base where it rules the figure out, else null."""
    ratio = figure / F.when(base >= MIN_BASE, base)
    out = ratio > MAX_RATIO
    return F.when(out if high_only else out | (ratio < MIN_RATIO), ratio)


def settle(pending: DataFrame, person: str, ordinal: str) -> DataFrame:
    """Pending records accepted one after another per person, each raising the total that later ones see.

    Needs name_sim, inst_match, cited_by_count, works_count, base, held (the total accepted
    before), has_record, last_inst_ok and topic_share; person and ordinal are bigints. Each
    decision depends on the one before, so a person's records pass one task in order, one by
    one: only the person's running total is kept, never a list of its records. Records that
    fail on name or institution leave before they move.
    """
    rows = pending.where((F.coalesce("name_sim", F.lit(0.0)) >= SETTLE_NAME) & (F.coalesce("inst_match", F.lit(0.0)) >= 1.0))
    rows = rows.select(
        F.col(person).cast("long").alias("p"), F.col(ordinal).cast("long").alias("o"), F.col("cited_by_count").cast("double").alias("c"), F.coalesce("works_count", F.lit(0)).cast("long").alias("w"), F.col("base").cast("double").alias("base"),
        F.coalesce("held", F.lit(0)).cast("double").alias("held"), F.coalesce("has_record", F.lit(False)).alias("has"), (F.coalesce("last_inst_ok", F.lit(True)) | (F.coalesce("topic_share", F.lit(0.0)) >= SIBLING_TOPIC)).alias("agrees"),
    ).where("p is not null")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, total, has = None, 0.0, False
        for batch in batches:
            taken: list[tuple[int, int]] = []
            for p, o, c, w, base, held, had, agrees in zip(*(x.to_pylist() for x in batch.columns)):
                if p != who:
                    who, total, has = p, held, had
                fits = base is not None and base >= MIN_BASE and c is not None and (agrees and (total + c) / base <= SIBLING_SUM_RATIO if has else c / base <= SETTLE_RATIO)
                if w <= FRAGMENT_WORKS or fits:
                    taken.append((p, o))
                    total += c or 0.0
                    has = has or c is not None
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in taken], pa.int64()) for k in (0, 1)], names=[person, ordinal])

    # The sum held before and whether there is a record are the same on all rows of a person.
    return rows.repartition("p").sortWithinPartitions("p", "o").mapInArrow(walk, f"{person} bigint, {ordinal} bigint")


def all_flagged(rows: DataFrame, person: str, flag: str) -> DataFrame:
    """People all of whose rows are flagged."""
    return rows.groupBy(person).agg(F.bool_and(flag).alias("all_flagged"), F.count(F.lit(1)).alias("n")).where("all_flagged").select(person, "n")

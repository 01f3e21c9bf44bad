"""Validity history of entity attributes from periodic extracts.

Each attribute has its own change log of events; the logs are combined by splitting at
the union of their boundary dates and joining equal neighbours. The first aggregation
leaves one row per entity and extract, so a later task holds at most as many rows of one
entity as there are extracts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def attribute_history(
    df: DataFrame,
    entity: str,
    as_of: str,
    attributes: dict[str, str],
    latest_by: list[str],
    stated_start: str | None = None,
    end_of_time: str = "9999-12-31",
) -> DataFrame:
    """One row per version of an entity's attributes and the period it was valid.

    Of the rows of one entity and ``as_of`` date, the one with the greatest ``latest_by``
    counts (a null is smallest). ``attributes`` maps columns to their Spark types. In a
    counted row a null attribute means that the value before still holds; before any value
    it is null. A version starts at ``as_of`` of its first counted row, or at the earliest
    ``stated_start`` date in its counted rows if that is earlier; it ends where the next one
    starts. Rows with a null entity or ``as_of`` are left out. Result: entity, attributes,
    valid_from and valid_to as dates. Repeated rows change nothing.
    """
    own = list(attributes)
    picked = [F.col(c).alias(f"_l{i}") for i, c in enumerate(latest_by)]
    start = F.col(stated_start) if stated_start else F.lit(None).cast("date")
    counted = (
        df.where(F.col(entity).isNotNull() & F.col(as_of).isNotNull())
        .groupBy(F.col(entity).alias("_e"), F.col(as_of).alias("_d"))
        .agg(F.max(F.struct(*picked, *[F.col(c).alias(f"_a{i}") for i, c in enumerate(own)], start.alias("_s"))).alias("_r"))
        .select("_e", "_d", *[F.col(f"_r._a{i}") for i in range(len(own))], F.col("_r._s"))
    )
    # Change log: an event where an attribute's stated value differs from the stated value before.
    pairs = F.array(*[F.struct(F.lit(i).alias("attr"), F.col(f"_a{i}").cast("string").alias("value")) for i in range(len(own))])
    by_attr = Window.partitionBy("_e", "_attr").orderBy("_d")
    events = (
        counted.select("_e", "_d", F.explode(pairs).alias("p"))
        .select("_e", "_d", F.col("p.attr").alias("_attr"), F.col("p.value").alias("_value"))
        .where(F.col("_value").isNotNull())
        .withColumn("_before", F.lag("_value").over(by_attr))
        .where(~F.col("_value").eqNullSafe(F.col("_before")))
    )
    at_boundary = [F.max(F.when(F.col("_attr") == i, F.col("_value"))).alias(f"_v{i}") for i in range(len(own))]
    boundaries = events.groupBy("_e", "_d").agg(*at_boundary)
    # The union of boundary dates splits the counted rows; what holds at a date is the latest event of each attribute.
    upto = Window.partitionBy("_e").orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    step = Window.partitionBy("_e").orderBy("_d")
    state = (
        counted.select("_e", "_d", "_s")
        .join(boundaries, ["_e", "_d"], "left")
        .select("_e", "_d", "_s", *[F.last(f"_v{i}", ignorenulls=True).over(upto).alias(f"_v{i}") for i in range(len(own))])
    )
    same = reduce(lambda a, b: a & b, [F.col(f"_v{i}").eqNullSafe(F.lag(f"_v{i}").over(step)) for i in range(len(own))])
    versions = (
        state.withColumn("_new", F.when(F.lag("_d").over(step).isNull() | ~same, 1).otherwise(0))
        .withColumn("_n", F.sum("_new").over(upto))
        .groupBy("_e", "_n")
        .agg(*[F.first(f"_v{i}").alias(f"_v{i}") for i in range(len(own))], F.least(F.min("_d"), F.min("_s")).alias("valid_from"))
    )
    nxt = F.lead("valid_from").over(Window.partitionBy("_e").orderBy("_n"))
    return versions.select(
        F.col("_e").alias(entity),
        *[F.col(f"_v{i}").cast(kind).alias(c) for i, (c, kind) in enumerate(attributes.items())],
        "valid_from",
        F.coalesce(nxt, F.to_date(F.lit(end_of_time))).alias("valid_to"),
    )

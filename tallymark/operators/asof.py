"""Backward as-of join: each row with the latest row of another table at or before its moment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, carry: list[str]) -> DataFrame:
    """``left`` with the ``carry`` columns of right's latest row with the same ``keys`` and ``at`` no later.

    Both sides are put together in time order and the last right row is carried on, so no pair
    is formed. Of right rows with equal ``at`` the greatest ``carry`` counts. A null key or
    ``at`` finds nothing, as does a moment before the first right row; carried columns are null
    then. ``carry`` columns must not be columns of ``left``. The rows of a key
    are one window partition, which spills.
    """
    own = left.columns
    values = F.struct(*[F.col(c) for c in carry])
    marked = left.select(*own, F.lit(None).cast(right.select(values.alias("v")).schema[0].dataType).alias("_v"), F.lit(1).alias("_side"))
    there = right.where(" and ".join(f"`{c}` is not null" for c in [*keys, at])).groupBy(*keys, at).agg(F.max(values).alias("_v"))
    fill = [F.col(c) if c in [*keys, at] else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in own]
    both = marked.unionByName(there.select(*fill, "_v", F.lit(0).alias("_side")))
    upto = Window.partitionBy(*keys).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_v", F.last("_v", ignorenulls=True).over(upto)).where("_side = 1")
    sure = F.lit(True)
    for c in [*keys, at]:
        sure = sure & F.col(c).isNotNull()
    return found.select(*own, *[F.when(sure, F.col(f"_v.{c}")).alias(c) for c in carry])

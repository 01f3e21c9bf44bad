"""Ranks and percentiles over whole tables without a single-partition window.

Rows fold into one cell per value with a count. The cells are range-partitioned, each
partition gets the count that lies before it from the partition totals, and ranks follow
from running counts inside a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import materialize, small_side


def ranked_cells(cells: DataFrame) -> DataFrame:
    """Cells (_g, _v, _c: group, value, count) with _upto, the rows of the group up to and with the value, and _n, all of the group.

    Null values come first. The cells are range-partitioned by group and value; a task holds one range.
    """
    cells = materialize(cells.repartitionByRange(F.col("_g").asc_nulls_first(), F.col("_v").asc_nulls_first()).withColumn("_p", F.spark_partition_id()), "rank-cells")
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    heads = cells.groupBy("_g", "_p").agg(F.sum("_c").alias("_t"))
    heads = heads.select(F.col("_g").alias("_hg"), F.col("_p").alias("_hp"), F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_head"), F.sum("_t").over(Window.partitionBy("_g")).alias("_n"))
    inside = Window.partitionBy("_g", "_p").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = cells.withColumn("_in", F.sum("_c").over(inside)).join(small_side(heads), F.col("_g").eqNullSafe(F.col("_hg")) & (F.col("_p") == F.col("_hp")))
    return ranked.select("_g", "_v", "_c", (F.col("_head") + F.col("_in")).alias("_upto"), "_n")


def value_ranks(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """(group, value, n, rank_asc, rank_desc, percent_rank) for each distinct value.

    Ascending ranks put null first, descending ranks put it last, as SQL's RANK does with
    those null orders; percent_rank is (rank_asc - 1) / (n - 1), 0 for a single row.
    """
    g = F.col(group) if group else F.lit(None).cast("string")
    ranked = ranked_cells(df.groupBy(g.alias("_g"), F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    low = F.col("_upto") - F.col("_c") + 1
    return ranked.select(
        *([F.col("_g").alias(group)] if group else []),
        F.col("_v").alias(value),
        F.col("_n").alias("n"),
        low.alias("rank_asc"),
        (F.col("_n") - F.col("_upto") + 1).alias("rank_desc"),
        F.when(F.col("_n") > 1, (low - 1) / (F.col("_n") - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
    )


def with_ranks(df: DataFrame, value: str, names: dict[str, str], group: str | None = None) -> DataFrame:
    """``df`` with columns of value_ranks joined on, ``names`` mapping them to new names."""
    ranks = value_ranks(df, value, group).select(*([F.col(group).alias("_jg")] if group else []), F.col(value).alias("_jv"), *[F.col(a).alias(b) for a, b in names.items()])
    on = F.col(value).eqNullSafe(F.col("_jv"))
    if group:
        on = on & F.col(group).eqNullSafe(F.col("_jg"))
    return df.join(ranks, on).drop("_jv", "_jg")


def measure_ranks(df: DataFrame, group: str, measures: list[str]) -> DataFrame:
    """Ranks of several bigint measures at once, over the whole table and within ``group``.

    Rows (_m, _g, _v, pct_all, desc_all, pct_group): measure, group, value, its percent rank and
    descending rank over all rows, and its percent rank within the group. All measures fold into
    cells of one table, which is range-partitioned once by measure and value.
    """
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).cast("bigint").alias("v")) for m in measures]))
    cells = df.select(F.col(group).alias("_g"), each.alias("e")).groupBy(F.col("e.m").alias("_m"), "_g", F.col("e.v").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    cells = materialize(cells.repartitionByRange(F.col("_m"), F.col("_v").asc_nulls_first()).withColumn("_p", F.spark_partition_id()), "measure-cells")
    before = lambda *by: Window.partitionBy(*by).orderBy("_p")
    heads = cells.groupBy("_m", "_g", "_p").agg(F.sum("_c").alias("_t"))
    # A range frame up to the partition before: all groups of the earlier partitions.
    heads = heads.select(
        F.col("_m").alias("_hm"),
        F.col("_g").alias("_hg"),
        F.col("_p").alias("_hp"),
        F.coalesce(F.sum("_t").over(before("_m").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_head_all"),
        F.coalesce(F.sum("_t").over(before("_m", "_g").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_head_group"),
        F.sum("_t").over(Window.partitionBy("_m")).alias("_n_all"),
        F.sum("_t").over(Window.partitionBy("_m", "_g")).alias("_n_group"),
    )
    rising = F.col("_v").asc_nulls_first()
    here = cells.withColumn("_low_all", F.sum("_c").over(Window.partitionBy("_p", "_m").orderBy(rising)))
    here = here.withColumn("_same", F.sum("_c").over(Window.partitionBy("_p", "_m", "_v")))
    here = here.withColumn("_low_group", F.sum("_c").over(Window.partitionBy("_p", "_m", "_g").orderBy(rising).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c"))
    j = here.join(small_side(heads), (F.col("_m") == F.col("_hm")) & F.col("_g").eqNullSafe(F.col("_hg")) & (F.col("_p") == F.col("_hp")))
    low_all, low_group = F.col("_head_all") + F.col("_low_all") - F.col("_same"), F.col("_head_group") + F.col("_low_group")
    share = lambda low, n: F.when(F.col(n) > 1, low / (F.col(n) - 1)).otherwise(F.lit(0.0))
    return j.select(
        "_m", "_g", "_v", share(low_all, "_n_all").alias("pct_all"), (F.col("_n_all") - low_all - F.col("_same") + 1).alias("desc_all"), share(low_group, "_n_group").alias("pct_group")
    )


def kth_values(df: DataFrame, group: str, places: dict[str, dict[str, str]]) -> DataFrame:
    """Values of bigint measures at given places of each group in ascending order, null first: (group, n, names).

    ``places`` maps a measure to result names with a SQL expression of ``n``, 1-based. Rows fold
    into counted values of all measures first; ranges of these are ranked, so a task holds
    neither a group's rows nor all of its distinct values.
    """
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).cast("bigint").alias("v")) for m in places]))
    cells = df.select(F.col(group).alias("g"), each.alias("e")).groupBy(F.struct(F.col("g"), F.col("e.m").alias("m")).alias("_g"), F.col("e.v").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranked = ranked_cells(cells).withColumnRenamed("_n", "n")
    pick = []
    for measure, wanted in places.items():
        for name, at in wanted.items():
            holds = (F.col("_g.m") == measure) & (F.col("_upto") >= F.expr(at)) & (F.col("_upto") - F.col("_c") < F.expr(at))
            pick.append(F.max(F.when(holds, F.col("_v"))).alias(name))
    return ranked.groupBy(F.col("_g.g").alias(group), "n").agg(*pick)

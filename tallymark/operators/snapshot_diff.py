"""What changed between consecutive full snapshots, by signed cells.

Each snapshot's rows become cells (key, field, value) with weight +1 in the comparison
that ends in it and -1 in the one that starts from it, and each key a presence marker of
the same weights. Equal cells cancel in the map-side sums; what does not cancel says which
keys were added or removed and which fields changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import small_side

#: Field name of the marker that says that a key is present.
PRESENT = "\u0001key"


def snapshot_changes(
    df: DataFrame,
    stream: str,
    delivered: str,
    key: str,
    fields: dict[str, Column],
    latest_by: list[str],
) -> DataFrame:
    """Keys added, removed or changed in each delivery against the one before.

    Deliveries of one ``stream`` are ordered by ``delivered``. If a key occurs more than
    once in a delivery, the row with the greatest ``latest_by`` counts (null smallest).
    ``fields`` gives the compared expressions by name; null equals null and differs from
    any value. Rows with a null stream, delivery or key are left out. Result: stream,
    delivered, key, delta_kind ('added', 'removed', 'changed') and changed_fields (sorted
    names, empty but for 'changed').
    """
    cells = F.array(
        F.struct(F.lit(PRESENT).alias("f"), F.lit(None).cast("string").alias("v")),
        *[F.struct(F.lit(n).alias("f"), F.col(f"_f{i}").alias("v")) for i, n in enumerate(fields)],
    )
    rows = (
        df.where(F.col(stream).isNotNull() & F.col(delivered).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(stream).alias("_s"), F.col(delivered).alias("_d"), F.col(key).alias("_k"))
        .agg(F.max(F.struct(*[F.col(c).alias(f"_l{i}") for i, c in enumerate(latest_by)], *[e.cast("string").alias(f"_f{i}") for i, e in enumerate(fields.values())])).alias("_r"))
        .select("_s", "_d", "_k", "_r.*")
    )
    # One row per delivery; counted before it is broadcast.
    calendar = df.where(F.col(stream).isNotNull() & F.col(delivered).isNotNull()).select(F.col(stream).alias("_s"), F.col(delivered).alias("_d")).distinct()
    by = Window.partitionBy("_s").orderBy("_d")
    calendar = calendar.select("_s", "_d", F.lag("_d").over(by).alias("_prev"), F.lead("_d").over(by).alias("_next"))
    sides = F.filter(
        F.array(
            F.struct(F.when(F.col("_prev").isNotNull(), F.col("_d")).alias("at"), F.lit(1).alias("w")),
            F.struct(F.col("_next").alias("at"), F.lit(-1).alias("w")),
        ),
        lambda x: x["at"].isNotNull(),
    )
    signed = (
        rows.join(small_side(calendar), ["_s", "_d"])
        .select("_s", "_k", F.explode(sides).alias("side"), cells.alias("cells"))
        .select("_s", "_k", F.col("side.at").alias("_at"), F.col("side.w").alias("_w"), F.explode("cells").alias("cell"))
        .groupBy("_s", "_at", "_k", F.col("cell.f").alias("_f"), F.col("cell.v").alias("_v"))
        .agg(F.sum("_w").alias("_w"))
        .where(F.col("_w") != 0)
    )
    marker = F.max(F.when(F.col("_f") == PRESENT, F.col("_w")))
    changed = F.sort_array(F.collect_set(F.when(F.col("_f") != PRESENT, F.col("_f"))))
    verdict = F.when(F.col("_m") > 0, "added").when(F.col("_m") < 0, "removed").otherwise("changed")
    return (
        signed.groupBy("_s", "_at", "_k")
        .agg(marker.alias("_m"), changed.alias("_c"))
        .select(
            F.col("_s").alias(stream),
            F.col("_at").alias(delivered),
            F.col("_k").alias(key),
            verdict.alias("delta_kind"),
            F.when(F.col("_m").isNull(), F.col("_c")).otherwise(F.array().cast("array<string>")).alias("changed_fields"),
        )
    )

"""Percentiles of very large columns by merging centroid digests.

A digest is a short list of centroids (mean, weight) over sorted values, whose sizes follow a
quantile-dependent function: small at both ends, larger in the middle. Partitions, days and
slices each give digests; these merge by sorting their centroids together and clustering
again. A second pass counts the values against the estimates and so certifies the rank error
of each one, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.ranking import ranked_cells
from tallymark.session import materialize, small_side

#: Default compression: a digest has at most about this many centroids.
COMPRESSION = 200
#: Bound of the rank error, as a share of n, that the counting pass has to confirm for every estimate at the default compression.
RANK_ERROR = 0.02
#: Digests that one task merges, about; more go through another level of the merge tree.
FAN_IN = 256
#: Groups whose buffers a task keeps before it hands on what it has.
GROUPS_HELD = 5_000
#: Distinct values of a bracket that one task ranks; more are ranked by ranges of values.
CELLS_HELD = 1_000_000
DIGEST_TYPE = "struct<means: array<double>, weights: array<double>, lows: array<double>, highs: array<double>>"


def scale(q: np.ndarray, compression: float) -> np.ndarray:
    """The size function k(q): a centroid may span one unit of it; arcsine makes the ends fine."""
    return compression / np.pi * np.arcsin(2 * np.clip(q, 0, 1) - 1)


#: A digest in memory: means, weights, and the least and greatest value of each centroid.
Digest = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
PARTS = ("means", "weights", "lows", "highs")


def cluster(d: Digest, compression: float) -> Digest:
    """Cluster centroids sorted by mean so that each cluster spans at most one unit of k(q)."""
    means, weights, lows, highs = d
    if not len(means):
        return d
    right = np.cumsum(weights)
    # Cells of the size function: a centroid belongs to the cell in which its middle lies, so a cluster spans one cell.
    cell = np.floor(scale((right - weights / 2) / right[-1], compression))
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    w = np.add.reduceat(weights, first)
    return np.add.reduceat(means * weights, first) / w, w, np.minimum.reduceat(lows, first), np.maximum.reduceat(highs, first)


def build(values: np.ndarray, compression: float) -> Digest:
    v, n = np.unique(values, return_counts=True)
    v = v.astype(float)
    return cluster((v, n.astype(float), v, v), compression)


def quantile(d: Digest, q: float) -> float:
    """Estimate at quantile q: inside the centroid that holds the rank, from its least value over its mean to its greatest.

    A centroid of merged parts may span a gap that other parts fill; it does not reach beyond the means beside it.
    """
    means, weights, lows, highs = d
    if not len(means):
        return float("nan")
    right = np.cumsum(weights)
    at = q * right[-1]
    j = min(int(np.searchsorted(right, at)), len(means) - 1)
    share = (at - (right[j] - weights[j])) / weights[j]
    low = max(lows[j], means[j - 1]) if j else lows[j]
    high = min(highs[j], means[j + 1]) if j + 1 < len(means) else highs[j]
    return float(np.interp(share, [0, 0.5, 1], [low, min(max(means[j], low), high), high]))


def _digest_batch(keys: list[tuple], made: list[Digest], names: list[str]) -> pa.RecordBatch:
    parts = [pa.array([d[i].tolist() for d in made], pa.list_(pa.float64())) for i in range(4)]
    columns = [pa.array([k[i] for k in keys], pa.string()) for i in range(len(names))]
    return pa.RecordBatch.from_arrays([*columns, pa.StructArray.from_arrays(parts, names=list(PARTS))], names=[*names, "digest"])


def _read(d: dict) -> Digest:
    return tuple(np.array(d[p], float) for p in PARTS)


def combine(parts: list[Digest], compression: float) -> Digest:
    """Merge digests: their centroids sorted together and clustered again."""
    m, w, lo, hi = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(m, kind="stable")
    return cluster((m[order], w[order], lo[order], hi[order]), compression)


def digests(df: DataFrame, groups: list[str], value: Column, compression: float = COMPRESSION) -> DataFrame:
    """One digest (or, with very many groups, a few) per partition and group: (groups as text, digest). Nulls and NaNs are left out.

    A task keeps a bounded buffer per group and clusters it whenever it is full, so neither a
    large group nor a long partition needs memory that grows with its rows.
    """
    own = [f"_g{i}" for i in range(len(groups))]
    rows = df.select(*[F.col(g).cast("string").alias(n) for g, n in zip(groups, own)], value.cast("double").alias("_v")).where("_v is not null and not isnan(_v)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[Digest]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            v = t["_v"].to_numpy()
            if own:
                codes = [t[c].combine_chunks().dictionary_encode() for c in own]
                ids = np.zeros(len(v), np.int64)
                for c in codes:
                    ids = ids * (len(c.dictionary) + 1) + c.indices.fill_null(len(c.dictionary)).to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                cuts = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0])
            else:
                codes, order, cuts = [], np.arange(len(v)), np.array([0])
            for a, b in zip(cuts, [*cuts[1:], len(v)]):
                at = order[a:b]
                key = tuple(c[int(at[0])].as_py() for c in codes)
                parts = held.setdefault(key, [])
                parts.append(build(v[at], compression))
                if sum(len(p[0]) for p in parts) > 20 * compression:
                    held[key] = [combine(parts, compression)]
            if len(held) > GROUPS_HELD:
                yield _digest_batch(list(held), [combine(parts, compression) for parts in held.values()], own)
                held.clear()
        if held:
            yield _digest_batch(list(held), [combine(parts, compression) for parts in held.values()], own)

    out = rows.mapInArrow(run, ", ".join(f"{n} string" for n in own) + (", " if own else "") + f"digest {DIGEST_TYPE}")
    return out.select(*[F.col(n).alias(g) for n, g in zip(own, groups)], "digest")


def merge(parts: DataFrame, groups: list[str], compression: float = COMPRESSION) -> DataFrame:
    """One digest per group out of digests of partitions, days or slices.

    Works as a tree over the counted digests: while a group has more than FAN_IN, its digests
    are spread over buckets of about FAN_IN, each bucket is merged, and the next level starts.
    """
    own = [f"_g{i}" for i in range(len(groups))]

    def run(key, parts):
        made = combine([_read(d) for d in parts.column("digest").to_pylist()], compression)
        return pa.Table.from_batches([_digest_batch([tuple(k.as_py() for k in key[: len(own)])], [made], own)])

    schema = ", ".join(f"{n} string" for n in own) + (", " if own else "") + f"digest {DIGEST_TYPE}"
    level = materialize(parts.select(*[F.col(g).cast("string").alias(n) for g, n in zip(groups, own)], "digest"), "digests")
    most = level.groupBy(*own).count().agg(F.max("count")).first()[0] or 0
    while most > FAN_IN:
        buckets = -(-most // FAN_IN)
        level = level.withColumn("_b", F.pmod(F.xxhash64("digest.means", "digest.weights", F.monotonically_increasing_id()), F.lit(buckets)).cast("string"))
        level = materialize(level.groupBy(*own, "_b").applyInArrow(run, schema), "digests")
        most = buckets
    level = level.groupBy(*own, *([] if own else [F.lit("").alias("_all")])).applyInArrow(run, schema)
    return level.select(*[F.col(n).alias(g) for n, g in zip(own, groups)], "digest")


def estimates(merged: DataFrame, groups: list[str], quantiles: list[float]) -> DataFrame:
    """(groups, quantile, estimate, n) of merged digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in [*own, "quantile", "estimate", "n"]}
            for row in batch.to_pylist():
                d = _read(row["digest"])
                for q in quantiles:
                    for n in own:
                        out[n].append(row[n])
                    out["quantile"].append(q), out["estimate"].append(quantile(d, q)), out["n"].append(int(d[1].sum()))
            types = [pa.string()] * len(own) + [pa.float64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    own = [f"_g{i}" for i in range(len(groups))]
    flat = merged.select(*[F.col(g).alias(n) for g, n in zip(groups, own)], "digest")
    schema = ", ".join(f"{n} string" for n in own) + (", " if own else "") + "quantile double, estimate double, n bigint"
    return flat.mapInArrow(run, schema).select(*[F.col(n).alias(g) for n, g in zip(own, groups)], "quantile", "estimate", "n")


def certified(df: DataFrame, groups: list[str], value: Column, estimated: DataFrame) -> DataFrame:
    """Second counting pass: how many values lie below and at each estimate.

    Adds n_below, n_at and rank_error, the distance of the quantile's rank from the ranks that
    the estimate holds, as a share of n: a proven bound, not an assumed one.
    """
    side = [F.col(g).alias(f"_e{i}") for i, g in enumerate(groups)]
    est = estimated.select(*side, "quantile", "estimate", "n")
    rows = df.select(*[F.col(g).cast("string").alias(g) for g in groups], value.cast("double").alias("_v")).where("_v is not null and not isnan(_v)")
    on = F.lit(True)
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"_e{i}"))
    counts = (
        rows.join(small_side(est.groupBy(*[f"_e{i}" for i in range(len(groups))]).agg(F.collect_list(F.struct("quantile", "estimate", "n")).alias("_q"))), on)
        .select(*groups, "_v", F.explode("_q").alias("q"))
        .groupBy(*groups, F.col("q.quantile").alias("quantile"), F.col("q.estimate").alias("estimate"), F.col("q.n").alias("n"))
        .agg(F.sum((F.col("_v") < F.col("q.estimate")).cast("long")).alias("n_below"), F.sum((F.col("_v") == F.col("q.estimate")).cast("long")).alias("n_at"))
    )
    rank = F.col("quantile") * F.col("n")
    error = F.greatest(F.lit(0.0), F.col("n_below") - rank, rank - (F.col("n_below") + F.col("n_at"))) / F.col("n")
    return counts.withColumn("rank_error", error)


def exact_ranks(df: DataFrame, groups: list[str], value: Column, ranks: dict[float, list[str]], compression: float = COMPRESSION) -> DataFrame:
    """(groups, quantile, n, values): exact values at ranks near quantiles, counted from 1 in ascending order.

    ``ranks`` maps a quantile to SQL expressions of ``n``. The digest gives a bracket of values
    around each quantile. The counting pass counts what lies below the bracket and keeps the
    distinct values inside with their counts, in their own type; it certifies that the ranks
    fall inside. A group whose bracket misses them is counted over its whole range. So the
    digest decides where to look and the counts decide the value. Nulls and NaNs are left out.
    """
    made = merge(digests(df, groups, value, compression), groups, compression)
    # Half a bracket of two percent of the ranks: several times what one centroid may span at this compression.
    half = 4.0 / compression
    wanted = sorted(ranks)
    est = materialize(estimates(made, groups, sorted({e for q in wanted for e in (max(0.0, q - half), min(1.0, q + half))})), "brackets")
    side = [f"_e{i}" for i in range(len(groups))]
    at = lambda e: F.max(F.when(F.col("quantile") == e, F.col("estimate")))
    bounds = F.array(*[F.struct(F.lit(q).alias("q"), at(max(0.0, q - half)).alias("lo"), at(min(1.0, q + half)).alias("hi")) for q in wanted])
    bracket = small_side(est.groupBy(*[F.col(g).alias(e) for g, e in zip(groups, side)]).agg(bounds.alias("_qs"), F.max("n").alias("n")))
    rows = df.select(*[F.col(g).cast("string").alias(g) for g in groups], value.alias("_v")).where("_v is not null and not isnan(cast(_v as double))")
    on = F.lit(True)
    for g, e in zip(groups, side):
        on = on & F.col(g).eqNullSafe(F.col(e))

    def found(bounds: DataFrame, whole: bool) -> DataFrame:
        v = F.col("_v").cast("double")
        # 0 inside, -1 and 1 beside the bracket: values outside fold into one cell per side.
        where = F.lit(0) if whole else F.when(v < F.col("_q.lo"), -1).when(v > F.col("_q.hi"), 1).otherwise(0)
        cells = (
            rows.join(bounds, on)
            .select(*groups, "n", "_v", F.explode("_qs").alias("_q"))
            .select(*groups, "n", F.col("_q.q").alias("quantile"), where.alias("_s"), "_v")
            .groupBy(*groups, "n", "quantile", "_s", F.when(F.col("_s") == 0, F.col("_v")).alias("_x"))
            .agg(F.count(F.lit(1)).alias("_c"))
        )
        cells = materialize(cells, "rank-cells")
        most = cells.groupBy(*groups, "quantile").count().agg(F.max("count")).first()[0]
        if (most or 0) <= CELLS_HELD:
            upto = Window.partitionBy(*groups, "quantile").orderBy("_s", "_x").rowsBetween(Window.unboundedPreceding, 0)
            ranked = cells.withColumn("_r", F.sum("_c").over(upto))
        else:
            # Very many distinct values in one bracket: counted by ranges of values, so no task holds them all.
            key = F.to_json(F.struct(*[F.coalesce(F.col(g), F.lit("\u0000")).alias(g) for g in groups], "quantile"))
            place = F.struct("_s", "_x")
            counted = ranked_cells(cells.select(key.alias("_g"), place.alias("_v"), "_c")).select(F.col("_g").alias("_cg"), "_v", "_upto")
            ranked = cells.join(counted, (place == F.col("_v")) & (key == F.col("_cg"))).select(*groups, "n", "quantile", "_s", "_x", "_c", F.col("_upto").alias("_r"))
        picks = []
        for q, expressions in ranks.items():
            picks.append((q, [F.max(F.when((F.col("_s") == 0) & (F.col("_r") >= F.expr(e)) & (F.col("_r") - F.col("_c") < F.expr(e)), F.col("_x"))) for e in expressions]))
        chosen = None
        for q, columns in picks:
            one = F.array(*columns)
            chosen = F.when(F.col("quantile") == q, one) if chosen is None else chosen.when(F.col("quantile") == q, one)
        return ranked.groupBy(*groups, "quantile", "n").agg(chosen.alias("values"))

    got = materialize(found(bracket, False), "ranks")
    bad = F.exists("values", lambda x: x.isNull())
    missed = got.where(bad).select(*[F.col(g).alias(f"_m{i}") for i, g in enumerate(groups)]).distinct()
    if missed.isEmpty():
        return got.select(*groups, "quantile", "n", "values")
    missed = small_side(missed)
    again = found(small_side(bracket.join(missed, [F.col(e).eqNullSafe(F.col(f"_m{i}")) for i, e in enumerate(side)], "left_semi")), True)
    sure = got.join(missed, [F.col(g).eqNullSafe(F.col(f"_m{i}")) for i, g in enumerate(groups)], "left_anti")
    return sure.unionByName(again).select(*groups, "quantile", "n", "values")


def exact_medians(df: DataFrame, groups: list[str], value: Column, compression: float = COMPRESSION) -> DataFrame:
    """(groups, median, n): the exact median of each group, the mean of the middle two for an even count."""
    middle = exact_ranks(df, groups, value, {0.5: ["(n + 1) div 2", "n div 2 + 1"]}, compression)
    return middle.select(*groups, ((F.col("values")[0].cast("double") + F.col("values")[1].cast("double")) / 2).alias("median"), "n")


def exact_percentiles(df: DataFrame, groups: list[str], value: Column, quantiles: list[float], compression: float = COMPRESSION) -> DataFrame:
    """(groups, quantile, n, percentile): the exact value at rank ceil(quantile * n), at least 1."""
    out = exact_ranks(df, groups, value, {q: [f"greatest(1, ceil({q!r}D * n))"] for q in quantiles}, compression)
    return out.select(*groups, "quantile", "n", F.col("values")[0].alias("percentile"))

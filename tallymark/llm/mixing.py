"""Mixing sources to target shares by min-cost flow over membership patterns.

Texts are aggregated by the set of sources that hold them. A flow network of patterns and
sources, whose size does not depend on the number of texts, routes token capacity to the
quotas of the sources; using a text once more costs more than using it before. The flows
then select texts in a seeded order: a pattern's uses form a line of tokens, level by level,
and every source takes one stretch of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import materialize, small_side


class Network:
    """Integer min-cost flow by successive shortest paths."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.arcs: list[list[int]] = []  # head, residual capacity, cost

    def arc(self, a: int, b: int, capacity: int, cost: int) -> int:
        self.out[a].append(len(self.arcs))
        self.arcs.append([b, capacity, cost])
        self.out[b].append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def run(self, start: int, end: int) -> int:
        """Send as much as possible at least cost; the flow of an arc is the capacity of its twin."""
        sent = 0
        while True:
            cost = {start: 0}
            came: dict[int, int] = {}
            queue = [start]
            while queue:
                fresh = []
                for a in queue:
                    for e in self.out[a]:
                        b, room, c = self.arcs[e]
                        if room > 0 and cost[a] + c < cost.get(b, 1 << 60):
                            cost[b], came[b] = cost[a] + c, e
                            fresh.append(b)
                queue = fresh
            if end not in cost:
                return sent
            path, b = [], end
            while b != start:
                path.append(came[b])
                b = self.arcs[came[b] ^ 1][0]
            amount = min(self.arcs[e][1] for e in path)
            for e in path:
                self.arcs[e][1] -= amount
                self.arcs[e ^ 1][1] += amount
            sent += amount


@dataclass(frozen=True)
class Target:
    source: str
    share: float
    max_repeats: int


def _parts(p: tuple) -> tuple[tuple[str, ...], int]:
    """Sources of a pattern, and how often its texts count as used before: a number at its end."""
    return (p[:-1], p[-1]) if isinstance(p[-1], int) else (p, 0)


def _written(p: tuple) -> str:
    names, before = _parts(p)
    return "|".join([str(before), *names])


def route(patterns: dict[tuple[str, ...], int], targets: list[Target], total: int) -> dict[tuple[tuple[str, ...], str], int]:
    """Tokens that each pattern gives to each source for a mixture of ``total`` tokens, at least repetition cost."""
    names = list(patterns)
    start, end = 0, 1
    node_p = {p: 2 + i for i, p in enumerate(names)}
    node_s = {t.source: 2 + len(names) + i for i, t in enumerate(targets)}
    net = Network(2 + len(names) + len(targets))
    by = {t.source: t for t in targets}
    ways = {}
    for p, tokens in patterns.items():
        held_by, before = _parts(p)
        for k in range(before, before + sum(by[s].max_repeats for s in held_by)):
            net.arc(start, node_p[p], tokens, k * k)
        for s in held_by:
            ways[p, s] = net.arc(node_p[p], node_s[s], tokens * by[s].max_repeats, 0)
    for t in targets:
        net.arc(node_s[t.source], end, int(t.share * total), 0)
    net.run(start, end)
    return {way: net.arcs[e ^ 1][1] for way, e in ways.items() if net.arcs[e ^ 1][1]}


def largest_total(patterns: dict[tuple[str, ...], int], targets: list[Target], most: int) -> int:
    """Largest mixture of at most ``most`` tokens whose quotas can all be met."""
    quotas = lambda total: sum(int(t.share * total) for t in targets)
    meets = lambda total: sum(route(patterns, targets, total).values()) >= quotas(total)
    low, high = 0, most
    if meets(high):
        return high
    while high - low > max(1, most // 1_000_000):
        mid = (low + high) // 2
        low, high = (mid, high) if meets(mid) else (low, mid)
    return low


def mix(df: DataFrame, doc_id: str, text_key: str, source: str, tokens: str, targets: list[Target], total: int | None = None, seed: int = 7) -> DataFrame:
    """Chosen documents with their number of uses: doc_id, source, n_tokens, repeats, pattern.

    ``df`` has one row per document; documents with the same ``text_key`` hold the same text,
    and a source uses each of its documents at most ``max_repeats`` times. The smallest doc_id
    of a text in a source stands for the text; further copies are units of their own whose
    first use costs as much as a second one of the text. Rows
    with a null key, no tokens, or a source without a positive target play no part. ``total``
    is the size of the mixture in tokens; without it, as many as there are in these units or, if
    the quotas cannot be met then, the largest mixture for which they can. The same seed gives
    the same choice. Without any usable document or target the result is empty.
    """
    spark = df.sparkSession
    targets = [t for t in targets if t.share > 0 and t.max_repeats > 0]
    held = df.where(F.col(text_key).isNotNull() & (F.col(tokens) > 0) & F.col(source).isin([t.source for t in targets]))
    held = materialize(held.select(F.col(text_key).alias("_u"), F.col(source).alias("_s"), F.col(doc_id).alias("_id"), F.col(tokens).alias("_n")), "mix-held")
    first = held.groupBy("_u", "_s").agg(F.min("_id").alias("_id"), F.max("_n").alias("_n"))
    units = first.groupBy("_u").agg(F.max("_n").alias("_n"), F.sort_array(F.collect_list(F.struct("_s", "_id"))).alias("_in"))
    # Joined by document, so a text with very many copies is no hot key; its copies have hashes of their own.
    more = held.join(first.select("_id", "_s"), ["_id", "_s"], "left_anti").dropDuplicates(["_id", "_s"])
    units = units.select("_u", "_n", "_in", F.lit(0).alias("_before"), F.xxhash64("_u", F.lit(seed)).alias("_h")).unionByName(
        more.select("_u", "_n", F.array(F.struct("_s", "_id")).alias("_in"), F.lit(1).alias("_before"), F.xxhash64("_u", "_id", F.lit(seed)).alias("_h"))
    )
    units = units.withColumn("_q", F.concat_ws("|", F.transform("_in", lambda x: x["_s"])))
    units = materialize(units.withColumn("_p", F.concat_ws("|", F.col("_before").cast("string"), "_q")).drop("_before"), "mix-units")
    # One row per pattern: at most 2 to the number of targets, and one more per target.
    key = lambda written: (*written.split("|")[1:], *([1] if written.startswith("1|") else []))
    sizes = {key(r["_p"]): (r["t"], r["n"]) for r in units.groupBy("_p").agg(F.sum("_n").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    patterns = {p: t for p, (t, _) in sizes.items()}
    out_schema = f"{doc_id} bigint, {source} string, n_tokens bigint, repeats bigint, pattern string"
    if not patterns:
        return spark.createDataFrame([], out_schema)
    # Sources that no text can serve are left out of the search for a feasible total; their share stays open.
    served = [t for t in targets if any(t.source in p for p in patterns)]
    aim = total if total is not None else largest_total(patterns, served, sum(patterns.values()))
    stretches, start = [], {}
    for (p, s), flow in sorted(route(patterns, served, aim).items(), key=lambda way: (_written(way[0][0]), way[0][1])):
        a = start.get(p, 0)
        stretches.append((_written(p), s, a, a + flow, patterns[p]))
        start[p] = a + flow
    if not stretches:
        return spark.createDataFrame([], out_schema)
    # One row per pattern and source of it: bounded like the patterns, whatever the number of documents.
    plan = F.broadcast(spark.createDataFrame(stretches, "_p string, _s string, _a bigint, _b bigint, _t bigint"))
    # Where a text begins on its pattern's line: prefix sums of hash buckets, then within a bucket.
    buckets = max(16, -(-sum(n for _, n in sizes.values()) // 50_000))
    placed = units.withColumn("_k", F.pmod(F.xxhash64("_h"), F.lit(buckets)))
    upto = Window.partitionBy("_p").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    heads = placed.groupBy("_p", "_k").agg(F.sum("_n").alias("_w")).select("_p", "_k", F.coalesce(F.sum("_w").over(upto), F.lit(0)).alias("_head"))
    inside = Window.partitionBy("_p", "_k").orderBy("_h", "_u").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_x", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(small_side(heads), ["_p", "_k"]).withColumn("_x", F.col("_x") + F.col("_head"))
    # Uses of a text by a source: levels k with a <= x + k * t < b.
    first_at = lambda bound: F.ceil((F.col(bound) - F.col("_x")).cast("decimal(38,0)") / F.col("_t"))
    uses = F.greatest(first_at("_b"), F.lit(0)) - F.greatest(first_at("_a"), F.lit(0))
    return (
        placed.join(plan, "_p")
        .withColumn("_uses", uses.cast("long"))
        .where("_uses > 0")
        .select(F.filter("_in", lambda x: x["_s"] == F.col("_s"))[0]["_id"].cast("long").alias(doc_id), F.col("_s").alias(source), F.col("_n").alias("n_tokens"), F.col("_uses").alias("repeats"), F.col("_q").alias("pattern"))
    )


def shares(chosen: DataFrame, source: str, targets: list[Target]) -> DataFrame:
    """Actual share of each target source: source, target_share, n_documents, n_tokens, actual_share."""
    spark = chosen.sparkSession
    got = chosen.groupBy(source).agg(F.count(F.lit(1)).alias("n_documents"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("n_tokens"))
    want = spark.createDataFrame([(t.source, float(t.share)) for t in targets], f"{source} string, target_share double")
    # Both sides have one row per target.
    joined = want.join(F.broadcast(got), source, "left").fillna(0, ["n_documents", "n_tokens"])
    return joined.withColumn("actual_share", F.try_divide(F.col("n_tokens").cast("double"), F.sum("n_tokens").over(Window.partitionBy(F.lit(1)))))

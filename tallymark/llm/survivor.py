"""Best representative of each duplicate group, chosen in consistent bundles.

Fields that depend on each other form a bundle, and a bundle survives as a whole from one
record. Trust is a tuple of integers compared in order; the trust of a choice is the sum
over its bundles, those of a lower ``tier`` first. Functional dependencies must hold among the
records chosen for one group.

The search is a branch and bound. Its root relaxes the dependencies: the bound is the best
bundle each on its own, which one grouped maximum finds with map-side combining, so a group of
any size costs a task only its combined rows. The root is tested against every dependency; where
it holds them all, the bound is reached and the choice is optimal. The other groups branch: best
first over the ranked candidates of each bundle that a dependency touches, of which a round
takes the first ``width``; a group whose answer is not proven within them goes on to a wider
round. The last round takes all candidates.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.session import materialize, small_side


@dataclass(frozen=True)
class Bundle:
    """Fields that survive together. ``complete`` tells whether a record can supply them; a lower ``tier`` never yields to a higher one."""

    name: str
    fields: tuple[str, ...]
    complete: Column
    tier: int = 0


@dataclass(frozen=True)
class Dependency:
    """Chosen records that agree on every ``given`` field (none null) must agree on ``fixed`` where both have it.

    With ``among`` only the records chosen for these bundles are held against each other.
    """

    given: tuple[str, ...]
    fixed: tuple[str, ...]
    among: tuple[str, ...] | None = None


#: A rule as the search sees it: names of given and fixed fields, and the pairs of bundles that it binds.
Rule = tuple[list[str], list[str], frozenset[tuple[int, int]]]

#: Candidates per bundle that the first branching round looks at, and the factor from round to round.
FIRST_WIDTH, WIDEN = 16, 16


def _clash(i: int, a: dict, j: int, b: dict, rules: list[Rule]) -> bool:
    for given, fixed, pairs in rules:
        if (i, j) in pairs and all(a[g] is not None and a[g] == b[g] for g in given) and any(a[f] is not None and b[f] is not None and a[f] != b[f] for f in fixed):
            return True
    return False


def best_choice(ranked: list[list[tuple[tuple[int, ...], dict]]], rules: list[Rule], whole: bool, tiers: list[int] | None = None) -> list[int] | None:
    """Places of the best consistent choice in ``ranked`` (per bundle, best first; the place after the last one is an empty bundle).

    Best-first branch and bound: a node is one place per bundle, its bound the trust there.
    The first node popped without a clash is optimal. A clash between two bundles branches on
    moving either one down. Leaving a bundle empty is tried last, so an answer always exists
    when ``whole``. Returns None if a list that may go on was exhausted before the proof.
    """
    size = len(next((t for r in ranked for t, _ in r), (0,)))
    tiers = tiers or [0] * len(ranked)
    order = sorted(set(tiers))

    def trust(at: tuple[int, ...]) -> tuple[int, ...]:
        out: list[int] = []
        for tier in order:
            gone, totals = 0, [0] * size
            for r, i, own in zip(ranked, at, tiers):
                if own != tier:
                    continue
                if i >= len(r):
                    gone += 1
                else:
                    totals = [x - y for x, y in zip(totals, r[i][0])]
            out += [gone, *totals]
        return tuple(out)

    start = tuple(0 for _ in ranked)
    heap, seen = [(trust(start), start)], {start}
    while heap:
        _, at = heapq.heappop(heap)
        if not whole and any(r and i >= len(r) for r, i in zip(ranked, at)):
            return None
        clash = next(
            ((i, j) for i in range(len(at)) for j in range(i + 1, len(at)) if at[i] < len(ranked[i]) and at[j] < len(ranked[j]) and _clash(i, ranked[i][at[i]][1], j, ranked[j][at[j]][1], rules)),
            None,
        )
        if clash is None:
            return list(at)
        for k in clash:
            nxt = (*at[:k], at[k] + 1, *at[k + 1 :])
            if nxt not in seen:
                seen.add(nxt)
                heapq.heappush(heap, (trust(nxt), nxt))
    return None


def survivors(
    df: DataFrame,
    keys: list[str],
    record_id: str,
    trust: list[Column],
    bundles: list[Bundle],
    dependencies: list[Dependency] | None = None,
    least_rows: int = 2,
) -> DataFrame:
    """One row per group: its keys, per bundle a struct of record_id and the bundle's fields, and ``branched``.

    A group is the rows with the same non-null ``keys``, if there are at least ``least_rows``.
    ``trust`` columns are integers, more trusted is greater, a null counts as 0 and
    ``record_id`` (a bigint) breaks ties. A bundle that no record can supply is null, as is one
    that would break a dependency whatever record it came from; bundles are left empty only if
    there is no other way, as few as can be. ``branched`` tells whether the root of the search
    broke a dependency. Rows repeated under one record id are records of their own that tie.
    """
    rules: list[Rule] = []
    for d in dependencies or []:
        bound = [i for i, b in enumerate(bundles) if d.among is None or b.name in d.among]
        rules.append((list(d.given), list(d.fixed), frozenset((i, j) for i in bound for j in bound if i < j)))
    watched = list(dict.fromkeys(x for g, f, _ in rules for x in g + f))
    touched = sorted({i for _, _, pairs in rules for pair in pairs for i in pair})
    key_names = [f"_k{i}" for i in range(len(keys))]
    fields = list(dict.fromkeys(f for b in bundles for f in b.fields))
    src = df.where(" and ".join(f"`{k}` is not null" for k in keys)).select(
        *[F.col(k).alias(n) for k, n in zip(keys, key_names)],
        F.col(record_id).cast("long").alias("_id"),
        *[F.coalesce(t.cast("long"), F.lit(0)).alias(f"_t{i}") for i, t in enumerate(trust)],
        *[F.col(f).alias(f"_f{i}") for i, f in enumerate(fields)],
        *[F.col(w).cast("string").alias(f"_w{i}") for i, w in enumerate(watched)],
        *[b.complete.alias(f"_c{i}") for i, b in enumerate(bundles)],
    )
    trusts = [f"_t{i}" for i in range(len(trust))]
    # Only a bundle that a dependency touches carries the watched fields.
    carried = lambda i: [f"_f{fields.index(f)}" for f in bundles[i].fields] + ([f"_w{k}" for k in range(len(watched))] if i in touched else [])
    packed = [F.when(F.col(f"_c{i}"), F.struct(*trusts, "_id", *carried(i))) for i in range(len(bundles))]
    root = src.groupBy(*key_names).agg(F.count(F.lit(1)).alias("_n"), *[F.max(p).alias(f"_b{i}") for i, p in enumerate(packed)]).where(F.col("_n") >= least_rows)
    if rules:
        w = lambda b, x: F.col(f"_b{b}._w{watched.index(x)}")
        clash = F.lit(False)
        for given, fixed, pairs in rules:
            for i, j in sorted(pairs):
                agree = reduce(lambda x, y: x & y, [F.coalesce(w(i, g) == w(j, g), F.lit(False)) for g in given])
                differ = reduce(lambda x, y: x | y, [F.coalesce(w(i, f) != w(j, f), F.lit(False)) for f in fixed])
                clash = clash | (agree & differ)
        root = materialize(root.withColumn("_clash", clash), "survivor-root")
        done = [root.where("not _clash").withColumn("branched", F.lit(False)).drop("_clash")]
        open_groups = root.where("_clash").drop("_clash")
        if not open_groups.isEmpty():
            # The rows of the groups that branch are read once for all rounds.
            rows = materialize(src.join(small_side(open_groups.select(*key_names)), key_names, "left_semi"), "survivor-open")
            width = FIRST_WIDTH
            while not open_groups.isEmpty():
                solved, open_groups = _branch(rows, open_groups, key_names, trusts, bundles, carried, touched, watched, rules, width)
                done.append(solved.withColumn("branched", F.lit(True)))
                width *= WIDEN
        root = reduce(DataFrame.unionByName, done)
    else:
        root = root.withColumn("branched", F.lit(False))
    out = [F.when(F.col(f"_b{i}").isNotNull(), F.struct(F.col(f"_b{i}._id").alias(record_id), *[F.col(f"_b{i}._f{fields.index(f)}").alias(f) for f in b.fields])).alias(b.name) for i, b in enumerate(bundles)]
    return root.select(*[F.col(n).alias(k) for n, k in zip(key_names, keys)], *out, "branched")


def _branch(rows: DataFrame, groups: DataFrame, key_names, trusts, bundles, carried, touched, watched, rules, width: int) -> tuple[DataFrame, DataFrame]:
    """Solve the open groups with the first ``width`` candidates of each touched bundle; return solved and still open ones.

    Candidates of a bundle that agree on the watched fields are interchangeable for the
    dependencies, so only the most trusted of them is kept before ranking. Bundles that no
    dependency touches keep the root's choice. All bundles rank within one partitioning.
    """
    wkeys = [f"_w{i}" for i in range(len(watched))]
    slim = lambda i: [c for c in carried(i) if c not in wkeys]
    best = rows.groupBy(*key_names, *wkeys).agg(*[F.max(F.when(F.col(f"_c{i}"), F.struct(*trusts, "_id", *slim(i)))).alias(f"_r{i}") for i in touched])
    for i in touched:
        whole = F.struct(*[F.col(f"_r{i}.{c}").alias(c) for c in [*trusts, "_id"]], *[F.col(f"_r{i}.{c}").alias(c) if c not in wkeys else F.col(c) for c in carried(i)])
        best = best.withColumn(f"_x{i}", F.when(F.col(f"_r{i}").isNotNull(), whole))
        best = best.withColumn(f"_p{i}", F.row_number().over(Window.partitionBy(*key_names).orderBy(F.col(f"_x{i}").desc_nulls_last())))
    top = lambda i: F.sort_array(F.collect_list(F.when(F.col(f"_p{i}") <= width + 1, F.col(f"_x{i}"))), asc=False).alias(f"_l{i}")
    lists = groups.join(best.groupBy(*key_names).agg(*[top(i) for i in touched]), key_names)
    n_t = len(trusts)
    tiers = [bundles[i].tier for i in touched]
    own = [(g, f, frozenset((touched.index(i), touched.index(j)) for i, j in pairs)) for g, f, pairs in rules]

    def solve(*columns: pd.Series) -> pd.Series:
        out = []
        for lists_of in zip(*columns):
            ranked, whole = [], True
            for one in lists_of:
                found = [] if one is None else list(one)
                whole &= len(found) <= width
                ranked.append([((*(int(r[f"_t{t}"]) for t in range(n_t)), int(r["_id"])), {w: r[f"_w{i}"] for i, w in enumerate(watched)}) for r in found[:width]])
            out.append(best_choice(ranked, own, whole, tiers))
        return pd.Series(out)

    pick = F.pandas_udf(solve, T.ArrayType(T.IntegerType()))
    answered = materialize(lists.withColumn("_at", pick(*[F.col(f"_l{i}") for i in touched])), "survivor-branch")
    chosen = [F.get(F.col(f"_l{i}"), F.col("_at")[touched.index(i)]).alias(f"_b{i}") if i in touched else F.col(f"_b{i}") for i in range(len(bundles))]
    solved = answered.where(F.col("_at").isNotNull()).select(*key_names, "_n", *chosen)
    return solved, answered.where(F.col("_at").isNull()).select(*key_names, "_n", *[f"_b{i}" for i in range(len(bundles))])

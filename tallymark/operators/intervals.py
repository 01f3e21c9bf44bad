"""Continuous periods and gaps of overlapping intervals by dyadic blocks.

Every interval of whole days is cut into canonical dyadic blocks, at most two per
level. Equal intervals, then equal blocks, fold into one set per entity and task before the
shuffle, so what one entity can send is bounded by the calendar and not by its rows. Blocks inside a larger
block go, sibling pairs become their parent level by level, and what touches is
joined into periods.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels of the block tree: 2**22 days from 0001-01-01 reach beyond the year 9999.
LEVELS = 22
#: Day number of 1970-01-01 in the block tree.
EPOCH_SHIFT = 719_162


def dyadic_nodes(first: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Canonical blocks of many intervals [first, until) as (number of the interval, tree node).

    Level by level the ends move inwards: an odd left end and an odd right end each give a
    block, and both ends then halve. Block i of level k is node 2^(LEVELS - k) + i, so the
    root is 1 and the parent of a node is its half.
    """
    left, right = first.astype(np.int64), until.astype(np.int64)
    row = np.arange(len(left))
    rows, nodes = [], []
    for k in range(LEVELS + 1):
        some = left < right
        row, left, right = row[some], left[some], right[some]
        if not len(row):
            break
        base = np.int64(1) << (LEVELS - k)
        odd = (left & 1) == 1
        rows.append(row[odd])
        nodes.append(base + left[odd])
        # An odd left end is gone by now, so a block of one is not given twice.
        left = left + odd
        odd = ((right & 1) == 1) & (left < right)
        rows.append(row[odd])
        nodes.append(base + right[odd] - 1)
        left, right = left >> 1, right >> 1
    none = np.empty(0, np.int64)
    return np.concatenate(rows or [none]), np.concatenate(nodes or [none])


#: Rows that a task keeps before it folds their blocks; equal intervals and blocks of a key leave it once.
FOLD_ROWS = 500_000


def _fold(key: np.ndarray, first: np.ndarray, until: np.ndarray) -> pa.RecordBatch:
    """Distinct (key, node) of the intervals."""
    # Equal intervals of a key fold first: both ends fit into 48 bits.
    order = np.lexsort(((first << 24) | until, key))
    key, first, until = key[order], first[order], until[order]
    if len(key):
        fresh = np.r_[True, (key[1:] != key[:-1]) | (first[1:] != first[:-1]) | (until[1:] != until[:-1])]
        key, first, until = key[fresh], first[fresh], until[fresh]
    row, node = dyadic_nodes(first, until)
    key = key[row]
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    if len(key):
        fresh = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]
        key, node = key[fresh], node[fresh]
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(node, pa.int32())], names=["k", "node"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the intervals (k, a, b) of a task."""
    held: list[np.ndarray] = []
    n = 0
    for batch in batches:
        held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]))
        n += batch.num_rows
        if n >= FOLD_ROWS:
            yield _fold(*np.concatenate(held, axis=1))
            held, n = [], 0
    if n:
        yield _fold(*np.concatenate(held, axis=1))


def merge_blocks(key: np.ndarray, level: np.ndarray, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Periods (key, first, until) of the dyadic blocks of many keys at once."""
    start = idx << level
    order = np.lexsort((-level, start, key))
    key, level, start = key[order], level[order].copy(), start[order]
    end = start + (np.int64(1) << level)
    # Blocks nest or are disjoint, so one is covered just when an earlier one of its key reaches its end.
    run = np.cumsum(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    reach = np.maximum.accumulate((run << 24) + end) if len(key) else run
    covered = np.r_[False, reach[:-1] >= (run[1:] << 24) + end[1:]] if len(key) else np.empty(0, bool)
    key, level, start = key[~covered], level[~covered], start[~covered]
    for k in range(LEVELS):
        if len(key) < 2:
            break
        pair = (level[:-1] == k) & (level[1:] == k) & (key[1:] == key[:-1]) & (start[1:] - start[:-1] == (1 << k)) & ((start[:-1] >> k) % 2 == 0)
        if pair.any():
            level[:-1][pair] = k + 1
            keep = np.r_[True, ~pair]
            key, level, start = key[keep], level[keep], start[keep]
    end = start + (np.int64(1) << level)
    if not len(key):
        return key, start, end
    fresh = np.r_[True, (key[1:] != key[:-1]) | (start[1:] != end[:-1])]
    last = np.r_[fresh[1:], True]
    return key[fresh], start[fresh], end[last]


def _spans(batches: Iterator[pa.RecordBatch], key_name: str) -> Iterator[pa.RecordBatch]:
    """Periods and gaps of keys whose nodes are gathered in one list each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column(1)
        sizes = nodes.value_lengths().to_numpy(zero_copy_only=False)
        node = nodes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        key = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
        depth = np.frexp(node.astype(float))[1].astype(np.int64) - 1
        k, first, until = merge_blocks(key, LEVELS - depth, node - (np.int64(1) << depth))
        inner = np.flatnonzero(k[1:] == k[:-1])
        kinds = ["period"] * len(k) + ["gap"] * len(inner)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[k, k[inner]], pa.int64()),
                pa.array(kinds, pa.string()),
                pa.array(np.r_[first, until[inner]] - EPOCH_SHIFT, pa.int64()),
                pa.array(np.r_[until, first[inner + 1]] - EPOCH_SHIFT, pa.int64()),
            ],
            names=[key_name, "span_kind", "first_n", "until_n"],
        )


def periods_and_gaps(df: DataFrame, key: str, first: Column, until: Column) -> DataFrame:
    """Longest covered stretches of each key and the gaps between them.

    ``key`` is a bigint column, ``first`` and ``until`` are date columns; an interval
    covers the days from ``first`` up to but not including ``until``. Rows with a null
    key, a null bound or ``until`` not after ``first`` give nothing. Result:
    (key, span_kind 'period' | 'gap', first_day, until_day) with dates. An empty table
    gives an empty result; other columns of ``df`` play no part.
    """
    days = lambda d: (F.unix_date(d) + EPOCH_SHIFT).cast("int")
    # The set of a key's nodes is built before the shuffle; the calendar bounds it, whatever the number of rows.
    rows = df.select(F.col(key).cast("long").alias("k"), days(first).alias("a"), days(until).alias("b")).where(F.col("k").isNotNull() & (F.col("a") >= 0) & (F.col("b") > F.col("a")))
    blocks = rows.mapInArrow(_blocks, "k bigint, node int").groupBy("k").agg(F.collect_set("node").alias("nodes"))
    spans = blocks.mapInArrow(lambda it: _spans(it, "k"), "k bigint, span_kind string, first_n bigint, until_n bigint")
    as_date = lambda n: F.date_add(F.to_date(F.lit("1970-01-01")), F.col(n).cast("int"))
    return spans.select(F.col("k").alias(key), "span_kind", as_date("first_n").alias("first_day"), as_date("until_n").alias("until_day"))

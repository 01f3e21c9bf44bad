"""Filling containers of fixed capacity by best-fit decreasing.

Items are spread over shards of bounded size by a hash of a row number. A shard is packed item by
item from the largest down; a segment tree over remaining capacities finds the tightest open
container that still takes the item in logarithmic time. Best fit leaves at most one
container of a shard less than half full, and those few are packed together in a last step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.session import materialize, small_side

#: Items of a shard. More shards cost under half a container each.
SHARD_ITEMS = 50_000


class OpenBins:
    """Segment tree whose leaf r counts the open containers with r left; a node sums its leaves."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def put(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, number) of the tightest container with room for ``need``."""
        i = need + self.size
        count = self.count
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i <<= 1
                if not count[i]:
                    i += 1
        room = i - self.size
        self._add(room, -1)
        return room, self.bins[room].pop()


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item; every size is at most ``capacity``. Ties go by position."""
    where = np.empty(len(sizes), np.int64)
    open_bins, made = OpenBins(capacity), 0
    for i in np.argsort(-sizes, kind="stable"):
        need = int(sizes[i])
        found = open_bins.take(need)
        if found is None:
            room, number, made = capacity, made, made + 1
        else:
            room, number = found
        where[i] = number
        open_bins.put(room - need, number)
    return where


def split(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, first token, length) of the pieces: one of an item that fits, else full pieces and the rest."""
    pieces = np.maximum(1, -(-sizes // capacity))
    item = np.repeat(np.arange(len(sizes)), pieces)
    place = np.arange(len(item)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = place * capacity
    return item, first, np.minimum(sizes[item] - first, capacity)


def pack(df: DataFrame, item_id: str, size: str, capacities: dict[int, int], shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Contents of the containers of each capacity, one row per item or piece.

    ``df`` has one row per item with a bigint id and a size in tokens; rows with a null id or
    size are left out, an item of size 0 takes no room. ``capacities`` maps a spec id to a
    capacity. Only an item larger than the capacity is split, into full pieces and a rest.
    Result: spec_id, container_id, item_id, piece, first_token, n_tokens, container_tokens,
    capacity_tokens. Repeated ids are items of their own. No item gives no container.
    """
    items = df.select(F.col(item_id).cast("long").alias("item"), F.col(size).cast("long").alias("size")).where("item is not null and size >= 0")
    # Rows spread by a number of their own, written with them, so an id that repeats very often is spread like any other rows.
    items = materialize(items.withColumn("row", F.monotonically_increasing_id()), "pack-items")
    shards = max(1, -(-items.count() // shard_items))
    specs = sorted(capacities.items())

    def run(key, rows):
        shard = key[0].as_py()
        ids, sizes = rows["item"].to_numpy(), rows["size"].to_numpy()
        order = np.lexsort((sizes, ids))
        ids, sizes = ids[order], sizes[order]
        parts = []
        for spec, capacity in specs:
            at, first, n = split(sizes, capacity)
            full = n == capacity
            number = np.empty(len(n), np.int64)
            rest = best_fit_decreasing(n[~full], capacity)
            number[~full] = rest
            made = int(rest.max()) + 1 if len(rest) else 0
            number[full] = made + np.arange(full.sum())
            used = np.bincount(number, weights=n).astype(np.int64) if len(n) else number
            parts.append(
                pa.table(
                    {
                        "spec_id": pa.array(np.full(len(n), spec), pa.int64()),
                        "shard": pa.array(np.full(len(n), shard), pa.int64()),
                        "bin": number,
                        "item": ids[at],
                        "piece": first // capacity,
                        "first_token": first,
                        "n_tokens": n,
                        "container_tokens": used[number],
                        "capacity_tokens": pa.array(np.full(len(n), capacity), pa.int64()),
                    }
                )
            )
        return pa.concat_tables(parts)

    schema = "spec_id bigint, shard bigint, bin bigint, item bigint, piece bigint, first_token bigint, n_tokens bigint, container_tokens bigint, capacity_tokens bigint"
    # A set number of partitions: shards are few bytes and much work, so they are not to be put together by their bytes.
    placed = items.select("item", "size", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")).repartition(2 * shards, "shard").groupBy("shard").applyInArrow(run, schema)
    placed = materialize(placed, "pack-placed")
    half = placed.where("container_tokens * 2 < capacity_tokens").groupBy("spec_id", "shard", "bin", "capacity_tokens").agg(F.first("container_tokens").alias("used"))

    def rejoin(key, rows):
        order = np.lexsort((rows["bin"].to_numpy(), rows["shard"].to_numpy()))
        rows = rows.take(pa.array(order))
        used = rows["used"].to_numpy()
        number = best_fit_decreasing(used, rows["capacity_tokens"][0].as_py())
        return pa.table({"spec_id": rows["spec_id"], "shard": rows["shard"], "bin": rows["bin"], "joint": number, "joint_tokens": np.bincount(number, weights=used).astype(np.int64)[number]})

    # At most one such container per shard and spec.
    joint = half.groupBy("spec_id").applyInArrow(rejoin, "spec_id bigint, shard bigint, bin bigint, joint bigint, joint_tokens bigint")
    return placed.join(small_side(joint), ["spec_id", "shard", "bin"], "left").select(
        "spec_id",
        F.when(F.col("joint").isNull(), F.concat_ws("-", "spec_id", "shard", "bin")).otherwise(F.concat_ws("-", "spec_id", F.lit("rest"), "joint")).alias("container_id"),
        F.col("item").alias(item_id),
        "piece",
        "first_token",
        "n_tokens",
        F.coalesce("joint_tokens", "container_tokens").alias("container_tokens"),
        "capacity_tokens",
    )

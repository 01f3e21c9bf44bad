"""Nested JSON records to flat child tables by columnar shredding.

A record is cut into one column per leaf path. A column holds its values with a
repetition level (at which repeated ancestor the value starts a new entry: 0 a new
record) and a definition level (how far down the path is present). Child tables are put
together again from these level sequences alone: the place of an entry under its parent
is the count of its repetition level since the parent began.

Both steps are narrow: a record never leaves its partition.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Node:
    """A field of the nested schema.

    ``repeated`` fields are lists; a single value in place of the list counts as a list of
    one. A ``keyed`` repeated field may also be an object, whose entries become children
    with 'key' and 'value' leaves under the path ``name{}``.
    """

    name: str
    repeated: bool = False
    keyed: bool = False
    children: tuple[Node, ...] = ()


@dataclass
class _Column:
    values: list = field(default_factory=list)
    reps: list = field(default_factory=list)
    defs: list = field(default_factory=list)

    def add(self, value: str | None, rep: int, level: int) -> None:
        self.values.append(value)
        self.reps.append(rep)
        self.defs.append(level)


@dataclass(frozen=True)
class Leaf:
    """A leaf path with its greatest repetition level and the definition level of each repeated ancestor's entry."""

    path: str
    max_rep: int
    max_def: int
    entry_defs: tuple[int, ...]


def leaves(nodes: tuple[Node, ...], prefix: str = "", rep: int = 0, level: int = 0, entries: tuple[int, ...] = ()) -> list[Leaf]:
    """Leaf paths of a schema: every field adds a definition level, every repeated one two more."""
    out: list[Leaf] = []
    for n in nodes:
        path = f"{prefix}{n.name}"
        # absent 0, present 1; for a list: empty 1, null entry 2, entry 3
        forms = [(path + "[]", rep + 1, level + 3)] if n.repeated else [(path, rep, level + 1)]
        for p, r, d in forms:
            e = entries + (d,) if n.repeated else entries
            out += leaves(n.children, p + "/", r, d, e) if n.children else [Leaf(p, r, d, e)]
        if n.repeated and n.keyed:
            e = entries + (level + 3,)
            out += [Leaf(f"{path}{{}}/{x}", rep + 1, level + 4, e) for x in ("key", "value")]
    return out


def scalar_text(v: object) -> str | None:
    """A leaf value as text: strings as they are, other values as JSON."""
    if v is None:
        return None
    if isinstance(v, str):
        return v.encode("utf-8", "replace").decode("utf-8")
    return json.dumps(v, ensure_ascii=True)


def _absent(nodes: tuple[Node, ...], prefix: str, cols: dict[str, _Column], rep: int, level: int) -> None:
    for n in nodes:
        path = f"{prefix}{n.name}"
        p = path + "[]" if n.repeated else path
        if n.children:
            _absent(n.children, p + "/", cols, rep, level)
        else:
            cols[p].add(None, rep, level)
        if n.repeated and n.keyed:
            cols[path + "{}/key"].add(None, rep, level)
            cols[path + "{}/value"].add(None, rep, level)


def dissect(obj: dict, nodes: tuple[Node, ...], cols: dict[str, _Column], prefix: str = "", rep: int = 0, depth: int = 0, level: int = 0) -> None:
    """Append one record's values and levels to the columns."""
    for n in nodes:
        path = f"{prefix}{n.name}"
        v = obj.get(n.name)
        if not n.repeated:
            if n.children:
                if isinstance(v, dict):
                    dissect(v, n.children, cols, path + "/", rep, depth, level + 1)
                else:
                    _absent(n.children, path + "/", cols, rep, level)
            else:
                cols[path].add(scalar_text(v), rep, level + (v is not None))
            continue
        as_map = n.keyed and isinstance(v, dict)
        if n.keyed:
            keys, values = cols[path + "{}/key"], cols[path + "{}/value"]
            if as_map and v:
                for i, (k, x) in enumerate(v.items()):
                    r = rep if i == 0 else depth + 1
                    keys.add(scalar_text(k), r, level + 4)
                    values.add(scalar_text(x), r, level + 3 + (x is not None))
            else:
                for c in (keys, values):
                    c.add(None, rep, level + as_map)
        entries = [] if v is None or as_map else v if isinstance(v, list) else [v]
        p = path + "[]"
        if not entries:
            if n.children:
                _absent(n.children, p + "/", cols, rep, level + isinstance(v, list))
            else:
                cols[p].add(None, rep, level + isinstance(v, list))
        for i, x in enumerate(entries):
            r = rep if i == 0 else depth + 1
            if not n.children:
                cols[p].add(scalar_text(x), r, level + 2 + (x is not None))
            elif isinstance(x, dict):
                dissect(x, n.children, cols, p + "/", r, depth + 1, level + 3)
            else:
                _absent(n.children, p + "/", cols, r, level + 2)


def payloads(v: object, known: frozenset[str]) -> Iterator[dict]:
    """Objects with a known field, also inside wrapping objects, lists and JSON texts."""
    stack = [v]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if x.lstrip()[:1] in ("{", "[", '"'):
                try:
                    stack.append(json.loads(x))
                except (ValueError, RecursionError):
                    pass
        elif isinstance(x, dict):
            if known.isdisjoint(x):
                stack.extend(reversed(list(x.values())))
            else:
                yield x
        elif isinstance(x, list):
            stack.extend(reversed(x))


def _lists(flat: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def shred(df: DataFrame, row_id: str, json_col: str, nodes: tuple[Node, ...]) -> DataFrame:
    """One row per payload: row_id, payload_no and, per leaf path, struct<v, r, d> of arrays.

    The row id is a bigint. A text that is null, empty or no valid JSON, and one without any
    known field, gives no row; a text with several payloads gives one row for each, numbered
    from 0 in the order of the text, so their children can be told apart.
    """
    paths = [x.path for x in leaves(nodes)]
    known = frozenset(n.name for n in nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: list[int] = []
            numbers: list[int] = []
            cols = {p: _Column() for p in paths}
            offsets: dict[str, list[int]] = {p: [0] for p in paths}
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                try:
                    value = json.loads(text)
                except (ValueError, RecursionError):
                    continue
                for number, record in enumerate(payloads(value, known)):
                    dissect(record, nodes, cols)
                    ids.append(rid)
                    numbers.append(number)
                    for p in paths:
                        offsets[p].append(len(cols[p].values))
            if not ids:
                continue
            arrays: list[pa.Array] = [pa.array(ids, pa.int64()), pa.array(numbers, pa.int32())]
            for p in paths:
                c, o = cols[p], np.array(offsets[p], np.int32)
                parts = [_lists(pa.array(c.values, pa.string()), o), _lists(pa.array(c.reps, pa.int8()), o), _lists(pa.array(c.defs, pa.int8()), o)]
                arrays.append(pa.StructArray.from_arrays(parts, names=["v", "r", "d"]))
            yield pa.RecordBatch.from_arrays(arrays, names=[row_id, "payload_no", *paths])

    fields = ", ".join(f"`{p}` struct<v: array<string>, r: array<tinyint>, d: array<tinyint>>" for p in paths)
    return df.where(f"`{json_col}` is not null").selectExpr(f"cast(`{row_id}` as bigint) as `{row_id}`", f"`{json_col}` as j").mapInArrow(run, f"`{row_id}` bigint, payload_no int, {fields}")


@dataclass(frozen=True)
class ChildTable:
    """A repeated ancestor's table: the leaf that names its entries, and one that gives a value beside it."""

    kind: str
    key: str
    value: str | None = None


def positions(reps: np.ndarray, starts: np.ndarray, level: int) -> np.ndarray:
    """0-based place, under its parent, of the entry of repeated ancestor ``level`` that holds each value.

    ``starts`` flags the first value of each record. A value with a repetition level of
    ``level`` starts the next entry under the same parent, a smaller one a new parent.
    """
    if not len(reps):
        return np.empty(0, np.int64)
    steps = np.cumsum(reps == level)
    fresh = (reps < level) | starts
    base = np.maximum.accumulate(np.where(fresh, steps, 0))
    return steps - base


def reconstruct(shredded: DataFrame, row_id: str, nodes: tuple[Node, ...], tables: tuple[ChildTable, ...]) -> DataFrame:
    """Flat child rows (row_id, payload_no, child_kind, outer_pos, inner_pos, child_key, child_value).

    A null list member keeps its place and gives no row. outer_pos is the place in the
    outer list, -1 for an entry of an object; inner_pos the place in the inner list, -1 if
    there is none. child_value is the value leaf of the same entry, if the table has one.
    """
    by_path = {x.path: x for x in leaves(nodes)}
    used = list(dict.fromkeys(p for t in tables for p in (t.key, t.value) if p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for t in tables:
                leaf = by_path[t.key]
                col = batch.column(2 + used.index(t.key))
                lists, r, d = (col.field(i) for i in range(3))
                sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
                reps, defs, values = r.flatten().to_numpy(zero_copy_only=False), d.flatten().to_numpy(zero_copy_only=False), lists.flatten()
                owner, number = np.repeat(ids, sizes), np.repeat(numbers, sizes)
                first = np.cumsum(sizes) - sizes
                starts = np.zeros(len(reps), bool)
                starts[first[sizes > 0]] = True
                present = np.flatnonzero(defs >= leaf.entry_defs[-1])
                if not len(present):
                    continue
                none = np.full(len(present), -1, np.int64)
                outer = none if "{}" in t.key else positions(reps, starts, 1)[present]
                inner = positions(reps, starts, 2)[present] if leaf.max_rep > 1 else none
                taken = pa.array(present)
                other = batch.column(2 + used.index(t.value)).field(0).flatten().take(taken) if t.value else pa.nulls(len(present), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner[present], pa.int64()), pa.array(number[present], pa.int32()), pa.array([t.kind] * len(present)), pa.array(outer), pa.array(inner), values.take(taken), other],
                    names=[row_id, "payload_no", "child_kind", "outer_pos", "inner_pos", "child_key", "child_value"],
                )

    return shredded.select(row_id, "payload_no", *[f"`{p}`" for p in used]).mapInArrow(run, f"`{row_id}` bigint, payload_no int, child_kind string, outer_pos bigint, inner_pos bigint, child_key string, child_value string")


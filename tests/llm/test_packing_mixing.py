import collections
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.llm import mixing as M
from tallymark.llm import packing as P
from tallymark.llm.tokens import VOCABULARY, encoder, with_token_counts


def naive_bfd(sizes, capacity):
    rooms, where = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in rooms if r >= sizes[i]]
        k = rooms.index(min(fits)) if fits else len(rooms)
        if not fits:
            rooms.append(capacity)
        rooms[k] -= sizes[i]
        where[i] = k
    return len(rooms), sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(0, c), max_size=60))))
def test_segment_tree_gives_best_fit(case):
    capacity, sizes = case
    where = P.best_fit_decreasing(np.array(sizes, np.int64), capacity)
    used = collections.Counter()
    for k, s in zip(where.tolist(), sizes):
        used[k] += s
    n, rooms = naive_bfd(sizes, capacity)
    assert len(used) == n and sorted(capacity - u for u in used.values()) == rooms


def test_pack(spark):
    r = random.Random(1)
    rows = [(i, r.choice([0, 1, 50, 99, 100, 101, 250, 1000])) for i in range(500)] + [(None, 5), (600, None), (7, 30), (7, 30)]
    df = spark.createDataFrame(rows, "doc bigint, n bigint").selectExpr("*", "1 as shard", "2 as item")
    out = P.pack(df, "doc", "n", {1: 100, 2: 512}, shard_items=60).collect()
    for spec, cap in ((1, 100), (2, 512)):
        mine = [x for x in out if x.spec_id == spec]
        by_doc = collections.defaultdict(list)
        for x in mine:
            by_doc[x.doc].append((x.first_token, x.n_tokens))
        want = collections.defaultdict(int)
        for d, n in rows:
            if d is not None and n is not None:
                want[d] += n
        assert {d: sum(n for _, n in p) for d, p in by_doc.items()} == dict(want)
        for d, n in rows:
            if d is not None and d != 7 and n is not None:
                assert (len(by_doc[d]) == 1) == (n <= cap)
        fill = collections.Counter()
        for x in mine:
            fill[x.container_id] += x.n_tokens
        assert max(fill.values()) <= cap and all(fill[x.container_id] == x.container_tokens for x in mine)
        assert sum(2 * v < cap for v in fill.values()) <= 1
    assert P.pack(df.limit(0), "doc", "n", {1: 100}).count() == 0


def test_tokens(spark):
    texts = [(1, "Hello world"), (2, ""), (3, None), (4, "naïve café " * 5000)]
    df = spark.createDataFrame(texts, "doc bigint, text string").selectExpr("*", "'x' as n", "1 as _text2")
    got = {x.doc: x.n_tokens for x in with_token_counts(df, "text", keep=["doc"]).collect()}
    enc = encoder(open(VOCABULARY, "rb").read())
    assert got == {i: None if t is None else len(enc.encode_ordinary(t)) for i, t in texts} and enc.decode(enc.encode_ordinary(texts[3][1])) == texts[3][1]


def test_flow_meets_quotas_at_least_cost():
    targets = [M.Target("a", 0.5, 1), M.Target("b", 0.5, 3)]
    patterns = {("a",): 100, ("b",): 60, ("a", "b"): 40}
    flow = M.route(patterns, targets, 240)
    assert sum(v for (p, s), v in flow.items() if s == "a") == 120 and sum(v for (p, s), v in flow.items() if s == "b") == 120
    assert all(v <= patterns[p] * {"a": 1, "b": 3}[s] for (p, s), v in flow.items())
    assert M.largest_total(patterns, targets, 10_000) in (280, 281)
    # With room for it, nothing is used twice.
    once = M.route({("a",): 100, ("b",): 100}, targets, 200)
    assert once == {(("a",), "a"): 100, (("b",), "b"): 100}


def test_mix(spark):
    r = random.Random(3)
    rows = [(i, f"t{i}", r.choice(["a", "a", "a", "b", "c", "x", None]), r.choice([10, 20, 30, None, 0])) for i in range(3000)]
    rows += [(5000 + i, f"t{i}", "b", rows[i][3]) for i in range(200)] + [(9000, None, "a", 5)]
    df = spark.createDataFrame(rows, "doc bigint, key string, source string, n bigint").selectExpr("*", "1 as _u", "2 as pattern")
    targets = [M.Target("a", 0.4, 1), M.Target("b", 0.4, 2), M.Target("c", 0.2, 4), M.Target("none", 0.0, 1)]
    out = M.mix(df, "doc", "key", "source", "n", targets).collect()
    cap = {t.source: t.max_repeats for t in targets}
    assert len({(x.doc, x.source) for x in out}) == len(out)
    assert all(1 <= x.repeats <= cap[x.source] for x in out)
    source_of = {(d, s): n for d, _, s, n in rows}
    assert all(source_of[x.doc, x.source] == x.n_tokens for x in out)
    total = collections.Counter()
    for x in out:
        total[x.source] += x.n_tokens * x.repeats
    whole = sum(total.values())
    assert all(abs(total[t.source] / whole - t.share) < 0.01 for t in targets)
    assert sorted(map(tuple, M.mix(df, "doc", "key", "source", "n", targets).collect())) == sorted(map(tuple, out))
    assert sorted(map(tuple, M.mix(df, "doc", "key", "source", "n", targets, seed=8).collect())) != sorted(map(tuple, out))
    said = {x.source: x for x in M.shares(spark.createDataFrame(out), "source", targets).collect()}
    assert said["none"].n_tokens == 0 and abs(said["a"].actual_share - total["a"] / whole) < 1e-9
    assert M.mix(df.limit(0), "doc", "key", "source", "n", targets).count() == 0


def test_copies_in_one_source_are_documents(spark):
    # 90 of the 100 documents of a are copies of one text; each may be used once.
    rows = [(i, "copy" if i < 90 else f"a{i}", "a", 10) for i in range(100)] + [(1000 + i, f"b{i}", "b", 10) for i in range(100)]
    df = spark.createDataFrame(rows, "doc bigint, key string, source string, n bigint")
    targets = [M.Target("a", 0.5, 1), M.Target("b", 0.5, 1)]
    out = M.mix(df, "doc", "key", "source", "n", targets).collect()
    assert {(x.doc, x.source, x.repeats, x.pattern) for x in out} == {(d, s, 1, s) for d, _, s, _ in rows}
    # A smaller mixture takes every text once before it takes a second copy.
    few = {x.doc for x in M.mix(df, "doc", "key", "source", "n", targets, total=240).collect() if x.source == "a"}
    assert {0, *range(90, 100)} <= few and len(few) == 12
    # And no document is used more than allowed.
    out = M.mix(df, "doc", "key", "source", "n", [M.Target("a", 0.75, 3), M.Target("b", 0.25, 1)]).collect()
    uses = collections.Counter({x.doc: x.repeats for x in out if x.source == "a"})
    assert len(uses) == 100 and max(uses.values()) <= 3

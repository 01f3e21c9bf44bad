import itertools
import random

from pyspark.sql import functions as F

from tallymark.llm import survivor as S

SCHEMA = "g bigint, id bigint, src int, sec int, a int, b int, c int"


def brute(rows, rules, least=2):
    """Best consistent choice per group by trying all: bundles a, b, c from any record or empty."""
    out = {}
    groups = {}
    for r in rows:
        if r[0] is not None:
            groups.setdefault(r[0], []).append(r)
    for g, rs in groups.items():
        if len(rs) < least:
            continue
        options = [[r for r in rs if r[4 + k] is not None] + [None] for k in range(3)]
        best = None
        for pick in itertools.product(*options):
            if any(p is None and len(o) > 1 and not rules for p, o in zip(pick, options)):
                continue
            ok = True
            for x, y in itertools.combinations([p for p in pick if p], 2):
                for given, fixed in rules:
                    if all(x[i] is not None and x[i] == y[i] for i in given) and any(x[i] is not None and y[i] is not None and x[i] != y[i] for i in fixed):
                        ok = False
            if not ok:
                continue
            gone = sum(p is None and len(o) > 1 for p, o in zip(pick, options))
            trust = tuple(sum((p[i] or 0) for p in pick if p) for i in (2, 3, 1))
            if best is None or (-gone, trust) > best[0]:
                best = ((-gone, trust), tuple(p and p[1] for p in pick))
        out[g] = best
    return out


def run(spark, rows, deps, shuffle=True):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as _k0", "2 as _n", "3 as _t0", "'x' as _b0")
    bundles = [S.Bundle(f"best_{c}", (c,), F.col(c).isNotNull()) for c in "abc"]
    got = S.survivors(df, ["g"], "id", [F.col("src"), F.col("sec")], bundles, deps).collect()
    return {r.g: tuple(x and x.id for x in (r.best_a, r.best_b, r.best_c)) for r in got}


def make(r, n, groups, values):
    maybe = lambda: r.choice([None, *range(values)])
    return [(r.randrange(groups), i, r.choice([None, 0, 1, 2]), r.choice([0, 0, 5]), maybe(), maybe(), maybe()) for i in range(n)]


def test_without_dependencies_each_bundle_is_independent(spark):
    rows = make(random.Random(1), 300, 60, 4) + [(None, 900, 1, 1, 1, 1, 1), (77, 901, 1, 1, 1, 1, 1), (78, 902, 1, 1, None, None, None), (78, 903, 1, 1, None, None, None)]
    want = {g: b[1] for g, b in brute(rows, []).items()}
    assert run(spark, rows, []) == want and 77 not in want and want[78] == (None, None, None)


def test_branch_and_bound_reaches_the_optimum(spark):
    rows = make(random.Random(4), 240, 50, 3)
    # Index of columns in a row: src 2, a 4, b 5.
    want = brute(rows, [((2,), (4, 5))])
    got = run(spark, rows, [S.Dependency(("src",), ("a", "b"))])
    by_id = {r[1]: r for r in rows}
    assert set(got) == set(want)
    for g, pick in got.items():
        trust = tuple(sum((by_id[i][k] or 0) for i in pick if i is not None) for k in (2, 3, 1))
        gone = sum(p is None and any(r[0] == g and r[4 + k] is not None for r in rows) for k, p in enumerate(pick))
        assert (-gone, trust) == want[g][0]


def test_wider_rounds_go_on_until_proven(spark, monkeypatch):
    monkeypatch.setattr(S, "FIRST_WIDTH", 1)
    monkeypatch.setattr(S, "WIDEN", 2)
    test_branch_and_bound_reaches_the_optimum(spark)


def test_empty_table(spark):
    assert run(spark, [(None, 1, 1, 1, 1, 1, 1)], []) == {}


def test_a_higher_tier_yields_and_only_named_bundles_bind(spark):
    # src 2 gives a at second 5 and b at second 9; c is of a lower claim and must not come from another moment of a's source.
    rows = [(1, 1, 2, 5, 10, None, None), (1, 2, 2, 9, None, 20, 30), (1, 3, 1, 1, 11, 21, 31), (2, 4, 2, 5, 1, 1, None), (2, 5, 2, 7, None, None, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    bundles = [S.Bundle(f"best_{c}", (c,), F.col(c).isNotNull(), tier=int(c == "c")) for c in "abc"]
    out = S.survivors(df, ["g"], "id", [F.col("src"), F.col("sec")], bundles, [S.Dependency(("src",), ("sec",), among=("best_a", "best_c"))]).collect()
    got = {r.g: (tuple(x and x.id for x in (r.best_a, r.best_b, r.best_c)), r.branched) for r in out}
    # Group 1: b keeps its record beside a's, c moves down to the other source; group 2: nothing else is left, so c stays empty.
    assert got == {1: ((1, 2, 3), True), 2: ((4, 4, None), True)}


def test_repeated_record_ids_branch(spark):
    # One id stands for two records of different moments: a dependency on the id can break.
    rows = [(1, 7, 2, 5, 10, None, None), (1, 7, 2, 9, None, 20, 30), (1, 8, 1, 1, 11, 21, 31)]
    df = spark.createDataFrame(rows, SCHEMA)
    bundles = [S.Bundle(f"best_{c}", (c, "sec"), F.col(c).isNotNull()) for c in "ab"]
    r = S.survivors(df, ["g"], "id", [F.col("src"), F.col("sec")], bundles, [S.Dependency(("id",), ("sec",))]).first()
    assert r.branched and {r.best_a.sec, r.best_b.sec} != {5, 9}

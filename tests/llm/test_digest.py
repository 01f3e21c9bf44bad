import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import digest as D


def exact_rank_error(values, q, estimate):
    v = np.sort(values)
    lo, hi = np.searchsorted(v, estimate, "left"), np.searchsorted(v, estimate, "right")
    rank = q * len(v)
    return max(0, lo - rank, rank - hi) / len(v)


@pytest.mark.parametrize("kind", ["normal", "lognormal", "few", "sorted"])
def test_rank_error_is_bounded_after_merging(kind):
    r = np.random.default_rng(1)
    v = {"normal": r.normal(size=40_000), "lognormal": np.round(r.lognormal(6, 2, 40_000)), "few": r.integers(0, 6, 40_000).astype(float), "sorted": np.arange(40_000.0)}[kind]
    made = D.combine([D.build(x, 200) for x in np.array_split(v, 37)], 200)
    assert len(made[0]) <= 220 and made[1].sum() == len(v)
    for q in (0, 0.001, 0.1, 0.5, 0.75, 0.99, 1):
        assert exact_rank_error(v, q, D.quantile(made, q)) <= 0.01


def test_groups_days_and_certificates(spark):
    r = np.random.default_rng(2)
    rows = [("a" if i % 3 else None, int(x), f"d{i % 4}") for i, x in enumerate(r.integers(0, 5000, 6000))] + [("b", 7, "d0"), ("c", None, "d0")]
    df = spark.createDataFrame(rows, "g string, v int, day string").repartition(7).withColumn("n", F.lit(1)).withColumn("digest", F.lit("x"))
    monthly = D.merge(D.digests(df, ["g", "day"], F.col("v")), ["g", "day"])
    est = D.estimates(D.merge(monthly, ["g"]), ["g"], [0.25, 0.5, 0.9])
    got = {(x.g, x.quantile): x for x in D.certified(df, ["g"], F.col("v"), est).collect()}
    assert set(g for g, _ in got) == {"a", None, "b"}
    for (g, q), x in got.items():
        v = np.array([b for a, b, _ in rows if a == g and b is not None], float)
        assert x.n == len(v) and abs(x.rank_error - exact_rank_error(v, q, x.estimate)) < 1e-12 and x.rank_error <= 0.02


def test_exact_medians(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(g, int(x)) for g, n in (("even", 4000), ("odd", 3001), ("two", 2), ("one", 1)) for x in np.round(r.lognormal(5, 2, n))] + [("null", None)] * 3 + [("ties", 4)] * 500 + [("ties", 9)] * 500
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(5)
    want = {g: float(np.median([b for a, b in rows if a == g])) for g in ("even", "odd", "two", "one", "ties")}
    assert {x.g: x.median for x in D.exact_medians(df, ["g"], F.col("v")).collect()} == want
    with monkeypatch.context() as m:
        m.setattr(D, "CELLS_HELD", 3)
        assert {x.g: x.median for x in D.exact_medians(df, ["g"], F.col("v")).collect()} == want
    # A bracket that misses the middle is noticed and counted over the whole range.
    monkeypatch.setattr(D, "quantile", lambda d, q: float(d[3][-1]))
    assert {x.g: x.median for x in D.exact_medians(df, ["g"], F.col("v")).collect()} == want
    assert D.exact_medians(df.limit(0), ["g"], F.col("v")).count() == 0


def test_many_partitions_merge_as_a_tree(spark, monkeypatch):
    monkeypatch.setattr(D, "FAN_IN", 4)
    df = spark.range(0, 20_000, 1, 30).withColumn("g", F.lit("x"))
    made = D.merge(D.digests(df, ["g"], F.col("id")), ["g"])
    est = D.estimates(made, ["g"], [0.5]).first()
    assert est.n == 20_000 and abs(est.estimate - 10_000) < 200

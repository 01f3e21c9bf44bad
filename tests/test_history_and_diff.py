import datetime as dt

from pyspark.sql import functions as F

from tallymark.operators.history import attribute_history
from tallymark.operators.snapshot_diff import snapshot_changes

D = lambda s: dt.date.fromisoformat(s)


def test_history(spark):
    rows = [
        (1, D("2024-01-01"), 10, "a", 1, None), (1, D("2024-01-01"), 11, "a", 2, None),  # the later load replaces
        (1, D("2024-02-01"), None, "a", 1, D("2023-06-01")), (1, D("2024-03-01"), 11, "b", 1, D("2024-02-20")), (1, D("2024-03-01"), 11, "b", 1, D("2024-02-20")),
        (1, D("2024-05-01"), 12, None, 1, None), (1, D("2024-06-01"), 11, "b", 1, None),
        (2, D("2024-01-01"), None, None, 1, None), (2, D("2024-02-01"), 5, None, 1, None),
        (None, D("2024-02-01"), 5, None, 1, None), (3, None, 5, None, 1, None),
    ]
    df = spark.createDataFrame(rows, "p bigint, d date, dep bigint, rk string, loaded int, s date").selectExpr("*", "1 as _e", "2 as _n", "'x' as valid_from")
    got = sorted((tuple(x) for x in attribute_history(df, "p", "d", {"dep": "bigint", "rk": "string"}, ["loaded"], "s").collect()), key=repr)
    end = D("9999-12-31")
    want = [
        (1, 11, "a", D("2023-06-01"), D("2024-02-20")), (1, 11, "b", D("2024-02-20"), D("2024-05-01")), (1, 12, "b", D("2024-05-01"), D("2024-06-01")), (1, 11, "b", D("2024-06-01"), end),
        (2, None, None, D("2024-01-01"), D("2024-02-01")), (2, 5, None, D("2024-02-01"), end),
    ]
    assert got == sorted(want, key=repr)
    assert attribute_history(df.limit(0), "p", "d", {"dep": "bigint"}, ["loaded"]).count() == 0


def test_snapshot_changes(spark):
    rows = [
        ("s", 1, 1, 10, 1), ("s", 1, 2, None, 1), ("s", 1, 3, 7, 1), ("s", 1, 4, 1, 1),
        ("s", 2, 1, 11, 1), ("s", 2, 1, 10, 2), ("s", 2, 2, None, 1), ("s", 2, 3, None, 1), ("s", 2, 5, None, 1),
        ("s", 3, 1, 10, 1), ("s", 3, 2, 4, 1), ("s", 3, 3, None, 1), ("s", 3, 5, 1, None), ("s", 3, 4, 1, 1),
        ("t", 9, 1, 1, 1), (None, 9, 1, 1, 1), ("t", None, 1, 1, 1), ("t", 9, None, 1, 1),
    ]
    df = spark.createDataFrame(rows, "src string, at int, who bigint, v int, seq int").selectExpr("*", "1 as _s", "1 as delta_kind", "1 as f")
    got = sorted((x.src, x.at, x.who, x.delta_kind, tuple(x.changed_fields)) for x in snapshot_changes(df, "src", "at", "who", {"v": F.col("v")}, ["seq"]).collect())
    assert got == [
        ("s", 2, 3, "changed", ("v",)), ("s", 2, 4, "removed", ()), ("s", 2, 5, "added", ()),
        ("s", 3, 2, "changed", ("v",)), ("s", 3, 4, "added", ()), ("s", 3, 5, "changed", ("v",)),
    ]
    assert snapshot_changes(df.limit(0), "src", "at", "who", {"v": F.col("v")}, ["seq"]).count() == 0

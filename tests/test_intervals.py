import datetime as dt
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.operators.intervals import merge_blocks, periods_and_gaps

DAY = dt.date(2000, 1, 1)


def blocks_of(a, b):
    out, k = [], 0
    while a < b:
        if a & 1:
            out.append((k, a))
            a += 1
        if b & 1:
            b -= 1
            out.append((k, b))
        a, b, k = a >> 1, b >> 1, k + 1
    return out


def cover(spans):
    days = sorted({x for a, b in spans for x in range(a, b)})
    out = []
    for x in days:
        if out and out[-1][1] == x:
            out[-1][1] = x + 1
        else:
            out.append([x, x + 1])
    return [tuple(x) for x in out]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 300), st.integers(1, 80)), max_size=25))
def test_merge_blocks_equals_day_sets(rows):
    found = {(k, *b) for k, a, n in rows for b in blocks_of(a, a + n)}
    arr = np.array(sorted(found), np.int64).reshape(-1, 3)
    k, first, until = merge_blocks(arr[:, 0], arr[:, 1], arr[:, 2])
    want = [(key, *s) for key in range(3) for s in cover([(a, a + n) for q, a, n in rows if q == key])]
    assert sorted(zip(k.tolist(), first.tolist(), until.tolist())) == want


def test_periods_and_gaps(spark):
    r = random.Random(5)
    rows = [(r.randint(1, 6) if i % 3 else 1, s := DAY + dt.timedelta(r.randint(0, 2000)), s + dt.timedelta(r.randint(-3, 200))) for i in range(500)]
    rows += [(7, None, DAY), (7, DAY, None), (None, DAY, DAY + dt.timedelta(3)), (8, DAY, dt.date(9999, 12, 31)), (8, DAY, dt.date(9999, 12, 31))]
    df = spark.createDataFrame(rows, "who bigint, a date, b date").selectExpr("*", "'x' as k", "1 as level", "2 as idx", "3 as span_kind")
    got = sorted(tuple(x) for x in periods_and_gaps(df, "who", F.col("a"), F.col("b")).collect())
    want = []
    for who in range(1, 7):
        spans = cover([((a - DAY).days, (b - DAY).days) for w, a, b in rows if w == who and a and b and b > a])
        want += [(who, "period", DAY + dt.timedelta(a), DAY + dt.timedelta(b)) for a, b in spans]
        want += [(who, "gap", DAY + dt.timedelta(x[1]), DAY + dt.timedelta(y[0])) for x, y in zip(spans, spans[1:])]
    want.append((8, "period", DAY, dt.date(9999, 12, 31)))
    assert got == sorted(want)
    assert periods_and_gaps(df.limit(0), "who", F.col("a"), F.col("b")).count() == 0

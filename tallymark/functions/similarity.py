"""String similarity that Spark has no built-in for, as Arrow-batched UDFs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jaro_winkler_value(a: str, b: str) -> float:
    """Jaro-Winkler with real-valued half transpositions and a prefix bonus at every score.

    Equal strings give 1, an empty one 0. Characters pair greedily from the left within half
    the longer length less one; the bonus counts at most four leading characters.
    """
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    pool, paired = list(b), {}
    for i, c in enumerate(a):
        try:
            j = pool.index(c, max(0, i - reach), max(0, i + reach + 1))
        except ValueError:
            continue
        pool[j], paired[i] = None, j
    if not paired:
        return 0.0
    n = len(paired)
    crossed = sum(a[i] != b[j] for i, j in zip(sorted(paired), sorted(paired.values()))) / 2
    jaro = (n / len(a) + n / len(b) + (n - crossed) / n) / 3
    lead = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return jaro + lead * 0.1 * (1 - jaro)


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Null if either side is null."""
    return pd.Series([None if x is None or y is None else jaro_winkler_value(x, y) for x, y in zip(a, b)], dtype="float64")


def within_one_edit(a: Column, b: Column) -> Column:
    """At most one insertion, deletion or change apart."""
    return F.levenshtein(a, b, 1) >= 0


def one_edit_keys(word: Column) -> Column:
    """Blocking keys such that words within one edit share at least one: the word and it with one letter less."""
    return F.array_distinct(F.concat(F.array(word), F.transform(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))), lambda i: F.concat(F.substring(word, 1, i - 1), F.substring(word, i + 1, F.length(word))))))

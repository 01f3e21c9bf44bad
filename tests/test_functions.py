from pyspark.sql import functions as F

from tallymark.functions import text as X
from tallymark.functions.names import norm_name
from tallymark.functions.similarity import jaro_winkler, jaro_winkler_value, one_edit_keys, within_one_edit
from tallymark.operators.ranking import kth_values, value_ranks


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


def test_written_moments(spark):
    for t, day, ms in [("2024-02-09", "2024-02-09", 0), ("20240209T001348Z", "2024-02-09", 828000), ("2024-02-09T00:25:49.250Z", "2024-02-09", 1549250), (" 2024-02-09 00:51:00 UTC", "2024-02-09", 3060000), ("2024-02-09T01:02", "2024-02-09", 3720000), ("soon", None, 0), (None, None, 0)]:
        assert one(spark, t, X.written_day) == day and one(spark, t, X.written_millis) == ms


def test_spellings(spark):
    assert [one(spark, s, X.source_name) for s in ("Open Alex", " p.o.p.", "GOOGLE_SCHOLAR", "", None)] == ["openalex", "pop", "google_scholar", None, None]
    assert [one(spark, s, X.rank_name) for s in ("Associate  Professor", "FULL", "Professor", "Lecturer", " ", None)] == ["associate", "full", "full", "other", None, None]
    assert [str(one(spark, s, X.figure)) for s in (" 1,003 ", "000008", "1.0", "n/a", "", None)] == ["1003.000000", "8.000000", "1.000000", "None", "None", "None"]
    assert [str(one(spark, s, X.flexible_date)) for s in ("1976", "1976-09", "1976-09-05T00:00:00", "x", "1976-13-01", None)] == ["1976-01-01", "1976-09-01", "1976-09-05", "None", "None", "None"]
    assert one(spark, "Ána López-Ríos", norm_name) == "ana lopez rios"


def test_jaro_winkler_reference_values(spark):
    assert round(jaro_winkler_value("martha", "marhta"), 3) == 0.961
    assert round(jaro_winkler_value("egdc", "dcggef"), 6) == 0.583333
    assert jaro_winkler_value("", "") == 1.0 and jaro_winkler_value("", "a") == 0.0 and jaro_winkler_value("a", "b") == 0.0
    rows = spark.createDataFrame([("a", None), ("ab", "ab"), (None, None)], "a string, b string").select(jaro_winkler("a", "b").alias("s")).collect()
    assert [r.s for r in rows] == [None, 1.0, None]


def test_edit_distance(spark):
    rows = [("mew", "new", True), ("abc", "xyz", False), ("abc", "abcd", True), ("abc", "acbd", False), ("", "a", True), ("a", "a", True)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    got = df.select("want", within_one_edit(F.col("a"), F.col("b")).alias("got"), F.arrays_overlap(one_edit_keys(F.col("a")), one_edit_keys(F.col("b"))).alias("blocked")).collect()
    assert all(r.got == r.want and (r.blocked or not r.want) for r in got)


def test_ranks_with_nulls_and_ties(spark):
    rows = [(g, v) for g in ("a", "b", None) for v in (None, 1, 1, 2, 5, 5, 5)] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, v int")
    df.createOrReplaceTempView("t")
    want = {tuple(r) for r in spark.sql("SELECT g, v, percent_rank() OVER (PARTITION BY g ORDER BY v NULLS FIRST), rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) FROM t").collect()}
    assert {(r.g, r.v, r.percent_rank, r.rank_desc) for r in value_ranks(df, "v", "g").collect()} == want
    whole = {tuple(r) for r in spark.sql("SELECT v, percent_rank() OVER (ORDER BY v NULLS FIRST) FROM t").collect()}
    assert {(r.v, r.percent_rank) for r in value_ranks(df, "v").collect()} == whole
    mid = {r.g: r.m for r in kth_values(df, "g", {"v": {"m": "(n + 1) div 2"}}).collect()}
    assert mid["a"] == 2 and mid["c"] is None
    assert value_ranks(df.limit(0), "v").count() == 0

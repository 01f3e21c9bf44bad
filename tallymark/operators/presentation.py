"""Datasets behind pages: yearly series, recent gains, slugs, ordinals, ranked search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.names import plain


def gap_filled_years(counts: DataFrame, key: str) -> DataFrame:
    """(key, year, n) from the first cited year to the last year, years without a count as 0.

    ``counts`` has an array<struct<year, n>> column ``years``; fewer than two cited years give nothing.
    """
    cited = F.filter("years", lambda y: y["n"] > 0)
    span = F.sequence(F.array_min(F.transform(cited, lambda y: y["year"])), F.array_max(F.transform("years", lambda y: y["year"])))
    n = F.coalesce(F.get(F.filter("years", lambda y: y["year"] == F.col("year")), 0)["n"], F.lit(0))
    return counts.where(F.size(cited) >= 2).select(key, "years", F.explode(span).alias("year")).select(key, "year", n.alias("n"))


def axis_top(v: Column) -> Column:
    """The smallest of 1, 2, 5 or 10 times a power of ten that is at least ``v``."""
    v = F.greatest(F.coalesce(v, F.lit(0)), F.lit(1)).cast("bigint")
    size = F.pow(F.lit(10), F.length(v.cast("string")) - 1).cast("bigint")
    return F.when(v <= size, size).when(v <= 2 * size, 2 * size).when(v <= 5 * size, 5 * size).otherwise(10 * size)


def yearly_gain(this_year: Column, last_year: Column, read: Column) -> Column:
    """Citations of the twelve months before ``read``: this year's, and last year's share that lies in the window."""
    share = 1 - (F.dayofyear(read) - 1) / F.lit(365)
    return (F.coalesce(this_year, F.lit(0)) + F.bround(F.coalesce(last_year, F.lit(0)) * share)).cast("bigint")


def slug(c: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(plain(c, stroked=False), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit("x")).otherwise(s)


def unique_slugs(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, slug): a slug that several rows share is followed by the key."""
    made = rows.select(F.col(key), slug(F.col(text)).alias("_s"))
    counts = made.groupBy("_s").agg(F.count(F.lit(1)).alias("_n"))
    return made.join(counts, "_s").select(key, F.when(F.col("_n") > 1, F.concat_ws("-", "_s", F.col(key).cast("string"))).otherwise(F.col("_s")).alias("slug"))


def ordinal(share: Column) -> Column:
    """A share as a percentile: '93rd'. Rounds half to even; null stays null."""
    n = F.bround(share * 100).cast("bigint")
    end = F.when((n % 100).between(10, 20), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), end)


def search_words(c: Column) -> Column:
    """Lower-case words and digits without accents."""
    return F.trim(F.regexp_replace(plain(c, stroked=False), "[^a-z0-9]+", " "))


def search(index: DataFrame, text: str, keep: int = 12) -> DataFrame:
    """Ranked hits of a query over an index (key, name, place_name, weight), best ``keep``.

    Score 0 the whole name, 1 its beginning, 2 every word of the query begins a word of the
    name, 3 inside the name, 4 every word begins a word of name or place, 5 inside the place.
    Without a hit the search is repeated without one-letter words.
    """

    def run(tokens: list[str]) -> DataFrame:
        q = " ".join(tokens)
        n, p = search_words(F.col("name")), search_words(F.coalesce("place_name", F.lit("")))
        begins = lambda ws: F.forall(F.array(*[F.lit(t) for t in tokens]), lambda t: F.exists(ws, lambda w: w.startswith(t)))
        score = (
            F.when(n == q, 0).when(n.startswith(q), 1).when(begins(F.split(n, " ")), 2).when(n.contains(q), 3)
            .when(begins(F.split(F.concat_ws(" ", n, p), " ")), 4).when(p.contains(q), 5)
        )
        return index.withColumn("score", score.cast("bigint")).where("score is not null")

    tokens = text.lower().split()
    longer = [t for t in tokens if len(t) > 1]
    if not tokens:
        return index.withColumn("score", F.lit(None).cast("bigint")).limit(0)
    hits = run(tokens)
    if longer and longer != tokens and hits.isEmpty():
        hits = run(longer)
    return hits.orderBy("score", F.coalesce("weight", F.lit(0)).desc(), "key").limit(keep)


def chart_points(series: DataFrame, key: str, keep: int = 20) -> DataFrame:
    """The last ``keep`` years of each series with its peak year (the first on ties)."""
    order = Window.partitionBy(key).orderBy(F.desc("year"))
    last = series.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= keep)
    return last.groupBy(key).agg(F.count(F.lit(1)).alias("n_points"), F.max_by("year", F.struct("n", -F.col("year"))).alias("peak_year"), F.max("n").alias("peak"))

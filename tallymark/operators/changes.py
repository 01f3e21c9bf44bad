"""Change detection between readings and the application of changes to appointment intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.ranking import value_ranks

#: A fall of more than this share between two readings of one profile is a flag.
DROP = 0.20
#: Years after which a rank is checked again, and weeks after which a reading is stale.
REVIEW_YEARS, STALE_WEEKS = 7, 26
RANK_ORDER = {"assistant": 0, "associate": 1, "full": 2}


def registrable(url: Column) -> Column:
    """Registrable domain of a URL, host or '@host': two labels, three under a country's second level."""
    host = F.regexp_replace(F.regexp_replace(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?", ""), r"[/:?#].*$", "")
    parts = F.split(host, r"\.")
    n = F.size(parts)
    second = F.element_at(parts, F.when(n >= 2, -2).otherwise(-1)).isin("ac", "edu", "co", "com", "org", "gov", "net")
    three = (n >= 3) & (F.length(F.element_at(parts, -1)) == 2) & second
    keep = F.when(three, 3).otherwise(2)
    return F.when(host != "", F.array_join(F.slice(parts, F.greatest(n - keep + 1, F.lit(1)), keep), "."))


def latest_two(readings: DataFrame, value: str) -> DataFrame:
    """Latest reading of each person with a figure, beside the one before: (person_id, day, latest, previous).

    Row numbers stop at two before the shuffle, so a person with very many readings is cheap.
    """
    order = Window.partitionBy("person_id").orderBy(F.desc("moment"), F.desc("snapshot_id"))
    two = readings.where(F.col(value).isNotNull() & F.col("moment").isNotNull()).withColumn("n", F.row_number().over(order)).where("n <= 2")
    pick = lambda n, c: F.max(F.when(F.col("n") == n, F.col(c)))
    return two.groupBy("person_id").agg(pick(1, "day").alias("day"), pick(1, value).alias("latest"), pick(2, value).alias("previous"))


def dropped(two: DataFrame, share: float = DROP) -> DataFrame:
    """Pairs of readings whose figure fell by more than ``share``."""
    fall = (F.col("previous") - F.col("latest")) / F.when(F.col("previous") > 0, F.col("previous"))
    return two.where((F.col("latest") != 0) & (fall > share))


def majority(votes: DataFrame, group: str, value: str, least: int = 2) -> DataFrame:
    """The value with the most votes per group, if it has at least ``least``; the smallest value on ties."""
    counts = votes.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    order = F.struct((-F.col("n")).alias("m"), F.col(value))
    best = counts.groupBy(group).agg(F.min(order).alias("b"))
    return best.select(group, F.col(f"b.{value}").alias(value), (-F.col("b.m")).alias("n")).where(F.col("n") >= least)


def first_found(text: Column, words: list[str]) -> Column:
    """The first of ``words``, in their order, that the text holds; else null."""
    return F.get(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.lower(text).contains(w)), 0)


def verified_on(note: Column) -> Column:
    """Latest 'verified YYYY-MM-DD' of a note as a date."""
    return F.array_max(F.regexp_extract_all(note, F.lit(r"verified (\d{4}-\d{2}-\d{2})"), 1)).try_cast("date")


def rank_review(rank: Column, start: Column, phd_year: Column, verified: Column, today: Column) -> Column:
    """Years since the rank began where it is due for a check, else null.

    An assistant without a start counts from the doctorate; a rank verified within the window is not due.
    """
    years = F.floor(F.datediff(today, start) / 365)
    proxy = F.year(today) - phd_year
    due = F.when(start.isNotNull(), years).when(rank == "assistant", proxy)
    fresh = F.coalesce(F.datediff(today, verified) < REVIEW_YEARS * 365, F.lit(False))
    return F.when(rank.isin("assistant", "associate") & ~fresh & (due >= REVIEW_YEARS), due).cast("bigint")


def close_and_open(intervals: DataFrame, moves: DataFrame, on: Column) -> DataFrame:
    """Apply moves to an interval table: the open row of each mover closes and a new one opens the same day.

    ``moves`` has one row per person: person_id, to_department, to_rank. The result has all rows
    of ``intervals`` with ``is_new``; new ids follow the greatest id in the order of person_id.
    People without an open primary row only gain the new one.
    """
    open_row = F.col("is_open") & (F.col("is_primary") == 1)
    marked = intervals.join(moves.select("person_id", F.lit(True).alias("_moves")), "person_id", "left")
    closes = open_row & F.coalesce("_moves", F.lit(False))
    kept = marked.withColumn("end_day", F.when(closes, on).otherwise(F.col("end_day"))).withColumn("is_open", F.col("is_open") & ~closes).drop("_moves").withColumn("is_new", F.lit(False))
    # The greatest id is one row; places of the new rows come from the distributed ranks of their unique person ids.
    top = intervals.agg(F.coalesce(F.max("affiliation_id"), F.lit(0)).alias("_top"))
    places = value_ranks(moves.select("person_id"), "person_id").select(F.col("person_id").alias("_p"), "rank_asc")
    new = moves.join(places, F.col("person_id") == F.col("_p")).join(F.broadcast(top))
    opened = new.select(
        (F.col("_top") + F.col("rank_asc")).alias("affiliation_id"), "person_id", F.col("to_department").alias("department_id"), F.col("to_rank").alias("rank_name"), F.lit("regular").alias("appointment_type"),
        F.lit(1).alias("is_primary"), on.alias("start_day"), F.lit(None).cast("date").alias("end_day"), F.lit(True).alias("is_open"), F.lit("close and open").alias("source"), F.lit(True).alias("is_new"),
    )
    return kept.unionByName(opened)


def recent_changes(intervals: DataFrame, since: Column) -> DataFrame:
    """Moves, promotions and departures of primary rows closed on or after ``since``.

    (person_id, change 'move' | 'promotion' | 'departed', closed_day, from_department,
    to_department). A row closed on the day an open row of the person begins is a move to
    another department, unless that department is the one of the row that ended when the closed
    one began, which undoes a correction, or a promotion to a higher rank. Without any open row
    the person departed.
    """
    primary = intervals.where("is_primary = 1")
    closed = primary.where(F.col("end_day") >= since).select("person_id", F.col("department_id").alias("from_department"), F.col("rank_name").alias("r0"), F.col("start_day").alias("s0"), F.col("end_day").alias("closed_day"))
    now = primary.where("is_open").groupBy("person_id").agg(F.max(F.struct("start_day", "affiliation_id", "department_id", "rank_name")).alias("o"))
    before = primary.where("end_day is not null").select("person_id", F.col("end_day").alias("s0"), F.col("department_id").alias("to_department")).distinct().withColumn("undoes", F.lit(True))
    order = lambda c: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in RANK_ORDER.items() for x in kv]), c), F.lit(-1))
    rows = closed.join(now, "person_id", "left").withColumn("to_department", F.col("o.department_id")).join(before, ["person_id", "s0", "to_department"], "left")
    moved = F.col("to_department") != F.col("from_department")
    same_day = F.col("o.start_day") == F.col("closed_day")
    up = order(F.coalesce(F.col("o.rank_name"), F.lit(""))) > order(F.coalesce("r0", F.lit("")))
    change = F.when(F.col("o").isNull(), "departed").when(same_day & moved & F.col("undoes").isNull(), "move").when(same_day & ~moved & up, "promotion")
    return rows.withColumn("change", change).where("change is not null").select("person_id", "change", "closed_day", "from_department", "to_department")


def dead_ids(observations: DataFrame, key: str, value: str, least: int = 2) -> DataFrame:
    """Keys observed empty at least ``least`` times and never otherwise."""
    return observations.groupBy(key).agg(F.count_if(F.col(value).isNull()).alias("empty"), F.count(value).alias("full")).where(f"empty >= {least} and full = 0").select(key, "empty")


def redirect(held: DataFrame, claims: DataFrame) -> DataFrame:
    """(person_id, new_id) of claims on ids that nobody holds; the smallest person_id has a contested one."""
    free = claims.join(held.where("held_id is not null").select(F.col("held_id").alias("new_id")), "new_id", "left_anti")
    return free.groupBy("new_id").agg(F.min("person_id").alias("person_id")).select("person_id", "new_id")

"""Collection planning, record aggregation, run monitoring and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def run_counts(ok: Column, failed: Column, notes: Column) -> DataFrame:
    """(ok, failed) of a run: the recorded figures, else those in a note like '1,050 ok, 3 failed'."""
    number = lambda p: F.regexp_replace(F.regexp_extract(notes, p, 1), ",", "").try_cast("bigint")
    return F.coalesce(ok, number(r"([\d,]+) ok")), F.coalesce(failed, number(r"([\d,]+) failed"))


def h_indexes(works: DataFrame, author: str, cites: str) -> DataFrame:
    """(author, n_works, total, h_index, i10) from works folded into counts per citation value.

    An author with very many works costs a task their distinct citation counts.
    """
    cells = works.where(F.col(cites).isNotNull()).groupBy(F.col(author).alias("_a"), F.col(cites).cast("bigint").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    down = Window.partitionBy("_a").orderBy(F.desc("_v")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = cells.withColumn("_n", F.sum("_c").over(down))
    return ranked.groupBy(F.col("_a").alias(author)).agg(
        F.sum("_c").alias("n_works"),
        F.sum(F.col("_c") * F.col("_v")).alias("total"),
        F.max(F.least(F.col("_v"), F.col("_n"))).alias("h_index"),
        F.sum(F.when(F.col("_v") >= 10, F.col("_c")).otherwise(0)).alias("i10"),
    )


def aggregate_records(records: DataFrame, person: str) -> DataFrame:
    """Several records of one person as one: sums of works and citations, greatest h-index, the record with most works."""
    order = F.struct(F.coalesce("works_count", F.lit(0)), -F.col("candidate_id"))
    return records.groupBy(person).agg(
        F.sum("cited_by_count").alias("total_citations"), F.sum("works_count").alias("works_count"), F.max("h_index").alias("h_index"), F.max_by("external_id", order).alias("primary_id"), F.count(F.lit(1)).alias("n_records")
    )


def ordered_ids(own: DataFrame, accepted: DataFrame) -> DataFrame:
    """(person_id, id, ordinal): the id on file at 0, then accepted ones at their ordinal, each once at its first place."""
    both = own.select("person_id", F.lit(0).cast("bigint").alias("o"), F.col("held_id").alias("id")).unionByName(accepted.select("person_id", F.col("ordinal").alias("o"), "id")).where("id is not null")
    return both.groupBy("person_id", "id").agg(F.min("o").alias("ordinal"))


def first_by_canonical(records: DataFrame, canonical: str, record: str) -> DataFrame:
    """(record, kept): the smallest record of each canonical id, for every record; without a canonical id its own.

    A grouped minimum and a join, so an id that very many records share is no window of one task.
    """
    kept = records.where(F.col(canonical).isNotNull()).groupBy(F.col(canonical).alias("_c")).agg(F.min(record).alias("kept"))
    return records.join(kept, F.col(canonical) == F.col("_c"), "left").select(record, F.coalesce("kept", record).alias("kept"))


def missing_readings(holders: DataFrame, seen: DataFrame) -> DataFrame:
    """Holders (person_id, held_id) without a reading of that id; a reading without an id counts for any."""
    return holders.join(seen, (holders["person_id"] == seen["seen_person"]) & (seen["seen_id"].isNull() | (seen["seen_id"] == holders["held_id"])), "left_anti")


def oldest_first(people: DataFrame, last_read: DataFrame, budget: int) -> DataFrame:
    """The ``budget`` people read longest ago, those never read first, by id on ties."""
    return people.join(last_read, "person_id", "left").orderBy(F.asc_nulls_first("last_day"), "person_id").limit(budget)


def reconcile(wanted: DataFrame, tracked: DataFrame) -> DataFrame:
    """(key, action) to bring tracked issues in line with wanted findings.

    wanted: key, members; tracked: key, state 'open' | 'closed', shown (members already told).
    A finding without an issue creates one, a closed issue of a finding with new members
    reopens, an open one is told of new members, an open one without a finding closes.
    """
    both = wanted.select("key", "members").join(tracked.select("key", "state", "shown"), "key", "full")
    fresh = F.size(F.array_except(F.coalesce("members", F.array().cast("array<string>")), F.coalesce("shown", F.array().cast("array<string>")))) > 0
    action = (
        F.when(F.col("state").isNull(), "create")
        .when(F.col("members").isNull(), F.when(F.col("state") == "open", "close").otherwise("none"))
        .when(~fresh, "none")
        .when(F.col("state") == "closed", "reopen")
        .otherwise("comment")
    )
    return both.select("key", action.alias("action"))


def fold_history(runs: DataFrame, stream: str, at: str, entry: Column, keep: int = 10) -> DataFrame:
    """Latest ``keep`` entries of each stream, oldest first, joined by ';' (entries are limited before they are gathered)."""
    order = Window.partitionBy(stream).orderBy(F.desc(at))
    last = runs.select(stream, at, entry.alias("_e")).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= keep)
    return last.groupBy(stream).agg(F.sort_array(F.collect_list(F.struct(at, "_e"))).alias("l"), F.max(at).alias("last_at")).select(stream, F.array_join(F.transform("l", lambda x: x["_e"]), ";").alias("history"), "last_at")


def marker(key: Column, members: Column) -> Column:
    """Key and members as text to keep in an issue's body."""
    return F.concat(F.lit("<!-- key:"), key, F.lit(" members:"), F.array_join(members, ","), F.lit(" -->"))


def marker_key(body: Column) -> Column:
    return F.regexp_extract(body, r"<!-- key:(\S+) members:", 1)


def marker_members(body: Column) -> Column:
    text = F.regexp_extract(body, r" members:(\S*) -->", 1)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))

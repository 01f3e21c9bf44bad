"""Entity resolution by rules: similarity, scores, ranked candidates and grouped decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.names import norm_name
from tallymark.functions.similarity import jaro_winkler, one_edit_keys, within_one_edit
from tallymark.session import small_side

# Words too common to tell one institution from another.
GENERIC = (
    "university of the state college at in and institute school department planning urban professor assistant associate universite universidad universidade universita universitat"
).split()

#: Thresholds of the automatic decision: score, name, margin over the best other record.
ACCEPT_SCORE, ACCEPT_NAME, ACCEPT_MARGIN = 0.75, 0.90, 0.15
#: A record this small is taken for a split of a larger one.
STUB_WORKS, STUB_CITES = 5, 50
KEEP_TOP = 5


def name_similarity(pairs: DataFrame, display: str, first: str, last: str, variants: str, out: str = "similarity") -> DataFrame:
    """Best similarity of a person's name to any of the variants (an array column), to three digits.

    A variant scores its Jaro-Winkler value, 1.0 with the same first name beside the last, 0.92
    with the same initial beside it. Without the last name in any variant the result is at most
    0.6. The variants explode so that the similarity runs once per Arrow batch.
    """
    # Rows are told apart by an id that is part of the exploded rows, so no column of the input is assumed unique.
    base = pairs.withColumn("_row", F.monotonically_increasing_id())
    ours, f, surname = norm_name(F.col(display)), norm_name(F.col(first)), norm_name(F.col(last))
    each = base.withColumn("_v", F.explode_outer(variants)).withColumn("_n", norm_name(F.col("_v")))
    lead = F.split("_n", " ")[0]
    holds = (surname != "") & F.col("_n").contains(surname)
    built = F.when(holds & (lead == f), 1.0).when(holds & (F.substring(lead, 1, 1) == F.substring(f, 1, 1)) & (f != ""), 0.92).otherwise(0.0)
    scored = each.withColumn("_s", F.when(F.col("_n") != "", F.greatest(jaro_winkler(ours, F.col("_n")), built))).withColumn("_ok", F.coalesce(holds, F.lit(False)))
    best = scored.groupBy("_row").agg(*[F.first(c).alias(c) for c in pairs.columns], F.max("_s").alias("_s"), F.bool_or("_ok").alias("_ok"))
    top = F.coalesce(F.col("_s"), F.lit(0.0))
    return best.withColumn(out, F.bround(F.when(F.col("_ok"), top).otherwise(F.least(top, F.lit(0.6))), 3)).select(*pairs.columns, out)


def plausibility(theirs: Column, ours: Column, good: tuple[float, float], fair: tuple[float, float]) -> Column:
    """1 for a ratio in the good band, 0.5 in the fair band or with nothing to compare, else 0."""
    ratio = F.coalesce(theirs, F.lit(0)) / F.when(F.coalesce(ours, F.lit(0)) != 0, ours)
    return F.when(ratio.isNull(), 0.5).when(ratio.between(*good), 1.0).when(ratio.between(*fair), 0.5).otherwise(0.0)


def is_stub(works: Column, cites: Column) -> Column:
    return (F.coalesce(works, F.lit(0)) <= STUB_WORKS) & (F.coalesce(cites, F.lit(0)) < STUB_CITES)


def top_candidates(candidates: DataFrame, person: str, score: str, ordinal: str, keep: int = KEEP_TOP, vetoed: DataFrame | None = None) -> DataFrame:
    """The ``keep`` best candidates per person by score, earlier ordinal first on ties, without vetoed pairs.

    Null scores come last. Row numbers are limited before the shuffle, so a person with very
    many candidates sends at most ``keep`` per partition.
    """
    if vetoed is not None:
        candidates = candidates.join(vetoed, vetoed.columns, "left_anti")
    order = Window.partitionBy(person).orderBy(F.col(score).desc_nulls_last(), F.col(ordinal))
    return candidates.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def decide(ranked: DataFrame, person: str) -> DataFrame:
    """Per person 'accepted' or 'pending' from its ranked candidates (place, score, name_sim, inst_match, works_count, cited_by_count).

    Accepted is a best candidate that is no stub, reaches the score, name and institution
    thresholds, and leads every other candidate that is no stub by the margin.
    """
    stub = is_stub(F.col("works_count"), F.col("cited_by_count"))
    at_top = lambda c: F.max(F.when(F.col("place") == 1, c))
    grouped = ranked.groupBy(person).agg(
        at_top(F.col("score")).alias("s"),
        at_top(F.col("name_sim")).alias("n"),
        at_top(F.col("inst_match")).alias("i"),
        at_top(stub.cast("int")).alias("stub"),
        F.max(F.when((F.col("place") > 1) & ~stub, F.col("score"))).alias("runner"),
    )
    clear = (F.col("stub") == 0) & (F.col("s") >= ACCEPT_SCORE) & (F.col("n") >= ACCEPT_NAME) & (F.col("i") >= 1.0) & (F.col("s") - F.coalesce("runner", F.lit(0.0)) >= ACCEPT_MARGIN)
    return grouped.select(person, F.when(F.coalesce(clear, F.lit(False)), "accepted").otherwise("pending").alias("decision"))


def primary_record(accepted: DataFrame, person: str, record: str, ordinal: str) -> DataFrame:
    """Per person the record with the most works, then the most citations, then the first."""
    order = F.struct(F.coalesce("works_count", F.lit(0)), F.coalesce("cited_by_count", F.lit(0)), -F.col(ordinal))
    return accepted.groupBy(person).agg(F.max_by(record, order).alias("primary_id"))


def carry_forward(queue: DataFrame, decided: DataFrame, key: str) -> DataFrame:
    """Rows of the queue whose key was not processed, with all decided rows."""
    return queue.join(decided.select(key).distinct(), key, "left_anti").unionByName(decided)


def label_hits(texts: DataFrame, text_id: str, text: str, labels: DataFrame, label_id: str, label: str) -> DataFrame:
    """(text_id, label_id) where a text names a label: whole, or by all of at least two distinctive words.

    Words block the join: a text meets a label only through a distinctive word of the label
    that it holds, so this is an equi-join and not every text with every label.
    """
    words = lambda c: F.array_distinct(F.split(norm_name(c), " "))
    telling = F.filter(words(F.col(label)), lambda w: ~w.isin(GENERIC) & (F.length(w) > 2))
    dim = labels.select(F.col(label_id).alias("_l"), norm_name(F.col(label)).alias("_name"), telling.alias("_need")).where("size(_need) > 0")
    dim = small_side(dim.select("_l", "_name", F.size("_need").alias("_k"), F.explode("_need").alias("_w")))
    found = texts.select(F.col(text_id).alias("_t"), norm_name(F.col(text)).alias("_text")).withColumn("_w", F.explode(F.array_distinct(F.split("_text", " "))))
    hits = found.join(dim, "_w").groupBy("_t", "_l", "_name", "_k", "_text").agg(F.count(F.lit(1)).alias("_n"))
    whole = F.concat(F.lit(" "), F.col("_text"), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("_name"), F.lit(" ")))
    return hits.where(whole | ((F.col("_n") == F.col("_k")) & (F.col("_k") >= 2))).select(F.col("_t").alias(text_id), F.col("_l").alias(label_id)).distinct()


def near_words(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct words of two one-column tables within one edit, by deletion keys."""
    a = left.toDF("a").where("a is not null").distinct().withColumn("k", F.explode(one_edit_keys(F.col("a"))))
    b = right.toDF("b").where("b is not null").distinct().withColumn("k", F.explode(one_edit_keys(F.col("b"))))
    return a.join(b, "k").where(within_one_edit(F.col("a"), F.col("b"))).select("a", "b").distinct()


def known_people(names: DataFrame, name_id: str, name: str, people: DataFrame, least: float = 0.85) -> DataFrame:
    """The person a written name belongs to: (name_id, person_id, agreement).

    Blocks on the surname as a word of the name. Given names agree 1.0 if equal, 0.9 if one is
    the other's initial or beginning. The best agreement wins, the smallest person_id on ties.
    """
    who = people.select("person_id", norm_name(F.col("first_name")).alias("_f"), F.split(norm_name(F.col("last_name")), " ").alias("_l"))
    who = who.withColumn("_w", F.element_at("_l", -1))
    text = names.select(F.col(name_id).alias("_id"), F.split(norm_name(F.col(name)), " ").alias("_ws")).withColumn("_w", F.explode(F.array_distinct("_ws")))
    lead = F.get(F.array_except("_ws", "_l"), 0)
    agrees = F.when(lead == F.col("_f"), 1.0).when(F.col("_f").startswith(lead) | lead.startswith(F.col("_f")), 0.9).otherwise(0.0)
    held = text.join(who, "_w").where(F.size(F.array_except("_l", "_ws")) == 0).withColumn("agreement", agrees).where(F.col("agreement") >= least)
    best = held.groupBy("_id").agg(F.max(F.struct("agreement", (-F.col("person_id")).alias("p"))).alias("b"))
    return best.select(F.col("_id").alias(name_id), (-F.col("b.p")).alias("person_id"), F.col("b.agreement").alias("agreement"))

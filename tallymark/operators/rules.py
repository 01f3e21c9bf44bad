"""Decisions of discovery and roster rules as conditions over joined label hits.

Each rule set is one chain of conditions over a row; what needs other rows (labels a text names,
other candidates, owners of a domain) is joined or folded before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import norm_name
from tallymark.operators.ranking import value_ranks
from tallymark.session import materialize, spread_join

# Parts of words by which an affiliation line tells what it is, for discovery and for the roster.
PLACEHOLDERS = ("unknown affiliation", "unknown", "none", "n a", "independent researcher", "independent scholar", "retired", "self employed")
FOUND_BEFORE_FACULTY = ("student", "estudiante", "etudiant", "doctoral candidate", "phd candidate", "doctorando", "doktorand", "postdoc", "post doc", "postdoctoral")
FOUND_FOREIGN = (
    "pediatric", "paediatric", "oncolog", "radiolog", "cardiolog", "neurolog", "psychiatr", "surgery", "surgeon", "dentist", "nursing", "pharmac", "immunolog", "microbiolog", "biochem", "molecular biolog", "genetic",
    "electrical engineering", "mechanical engineering", "chemical engineering", "computer science", "astronom", "astrophys", "particle physic", "veterinar", "arztin", "arzt", "medizin", "klinik",
)
FOUND_INSTITUTION = (
    "universit", "college", "institut", "school", "polytechnic", "academy", "hochschule", "universidad", "universidade", "universita", "uniwersytet", "laborator", "hospital", "clinic", "centre", "center", "museum", "faculty",
    "fakultesi", "faculte", "facultad", "department of",
)
HELD_BEFORE_FACULTY = ("student", "candidate", "postdoc", "post-doc", "postdoctoral", "fellow", "research assistant")
HELD_FOREIGN = ("electrical engineering", "computer science", "biochem", "chemistry", "physics", "medicine", "medical", "biology", "neuroscience", "mathematics", "dentistry", "nursing", "pharmac")
HELD_INSTITUTION = ("universit", "college", "institut", "school", "polytechni", "academy", "ecole", "école", "hochschule", "facult", "escuela", "scuola")
UNTRACKED_CAMPUS = ("tacoma", "bothell", "dearborn", "flint", "duluth", "omaha", "kearney")
TOPIC_WORDS = (
    "urban", "planning", "geography", "transport", "environmental", "sociolog", "political", "public administration", "architecture", "development", "economics", "demograph", "health", "social", "law", "history", "civil",
    "ecology", "energy", "policy", "housing",
)
RANK_ORDER = {"assistant": 0, "associate": 1, "full": 2}
TYPES = {"emeritus": "emeritus", "adjunct or lecturer": "adjunct"}
#: Ratios of citations beyond which a found profile is somebody else's, and what an automatic acceptance needs.
RATIO_LOW, RATIO_HIGH = 0.2, 4.0
FOUND_SCORE, FOUND_NAME, FOUND_MARGIN = 0.85, 0.9, 0.15
#: A profile this thin so long after the doctorate is reported and not trusted.
THIN_CITES, THIN_YEARS = 25, 5


def holds_any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def discovery_score(name: Column, affiliation: Column, cites: Column) -> Column:
    return F.round(0.5 * name + 0.35 * affiliation + 0.15 * cites, 6)


def topic_share(topics: Column) -> Column:
    """Share of the counts of topics (array<struct<label, n>>) whose label holds a word of the field; 0.5 without topics."""
    n = lambda t: F.coalesce(t["n"], F.lit(0))
    add = lambda only: F.aggregate(topics, F.lit(0).cast("bigint"), lambda acc, t: acc + F.when(only(t), n(t)).otherwise(0))
    total = add(lambda t: F.lit(True))
    hit = add(lambda t: holds_any(norm_name(F.coalesce(t["label"], F.lit(""))), TOPIC_WORDS))
    return F.when(F.coalesce(F.size(topics), F.lit(0)) <= 0, 0.5).otherwise(F.round(hit / F.when(total != 0, total).otherwise(1), 3))


def found_status(at_home: Column, text: Column, ratio: Column, names_tracked: Column) -> Column:
    """'accepted', 'pending' or 'rejected' for a found profile, from its affiliation line alone.

    ``at_home``: it names the person's own department; ``names_tracked``: some department on
    file. A line that tells nothing, or another tracked department, is left to a person.
    """
    t = F.coalesce(norm_name(text), F.lit(""))
    off = F.coalesce((ratio > RATIO_HIGH) | (ratio < RATIO_LOW), F.lit(False))
    return (
        F.when(at_home, "accepted").when((t == "") | t.isin(*PLACEHOLDERS), "pending").when(holds_any(t, FOUND_BEFORE_FACULTY) | holds_any(t, FOUND_FOREIGN) | off, "rejected")
        .when(names_tracked | ~holds_any(t, FOUND_INSTITUTION), "pending").otherwise("rejected")
    )


def decide_found(rows: DataFrame, person: str) -> DataFrame:
    """Rows (person, status, score, name_sim and others) with the person's ``outcome`` and the status after it.

    Accepted is a sole accepted profile with the needed score, name and lead over every other
    one that is not rejected; else accepted ones wait. All rejected means rejected.
    """
    rows = materialize(rows, "found")
    taken, score = F.col("status") == "accepted", F.col("score")
    folded = rows.groupBy(person).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(taken).alias("_taken"),
        F.max(F.when(taken, score)).alias("_s"),
        F.max(F.when(taken, F.col("name_sim"))).alias("_name"),
        F.max(F.when(F.col("status") == "pending", score)).alias("_next"),
        F.bool_and(F.col("status") == "rejected").alias("_none"),
    )
    clear = (F.col("_taken") == 1) & (F.col("_s") >= FOUND_SCORE) & (F.col("_name") >= FOUND_NAME) & (F.round(F.col("_s") - F.greatest(F.coalesce("_next", F.lit(0.0)), F.lit(0.0)), 6) >= FOUND_MARGIN)
    folded = folded.select(person, "_n", F.when(F.coalesce(clear, F.lit(False)), "accepted").when(F.col("_none"), "rejected").otherwise("pending").alias("outcome"))
    joined = spread_join(rows, materialize(folded, "outcomes"), person, "_n")
    return joined.withColumn("status", F.when(taken & (F.col("outcome") != "accepted"), "pending").otherwise(F.col("status")))


def apply_accepted(people: DataFrame, queue: DataFrame, id_column: str) -> DataFrame:
    """(person_id, id_column, outcome): 'written' from a sole accepted record, 'contested' with several, else 'kept'."""
    got = queue.where("status = 'accepted' and external_id is not null and external_id <> ''").groupBy("person_id").agg(F.count(F.lit(1)).alias("_k"), F.min("external_id").alias("_e"))
    j = people.select("person_id", id_column).join(got, "person_id", "left")
    outcome = F.when(F.col("_k") > 1, "contested").when((F.col("_k") == 1) & ~F.col(id_column).eqNullSafe(F.col("_e")), "written").otherwise("kept")
    return j.select("person_id", F.when(outcome == "written", F.col("_e")).otherwise(F.col(id_column)).alias(id_column), outcome.alias("outcome"))


def reclassify(queue: DataFrame, fresh: Column, automatic: str) -> DataFrame:
    """Queue rows with the status that the rules give now and whether it changed.

    A row that a person reviewed stays; a pending one without a record is rejected; ``fresh`` is
    the status of the others. The reviewer of a row that changes is ``automatic``, none if it waits again.
    """
    none = F.coalesce("external_id", F.lit("")) == ""
    by_person = F.coalesce("reviewed_by", F.lit(automatic)) != automatic
    status = F.when(none, F.when(F.col("status") == "pending", "rejected").otherwise(F.col("status"))).when(by_person, F.col("status")).otherwise(fresh)
    changed = ~status.eqNullSafe(F.col("status"))
    by = F.when(~changed, F.col("reviewed_by")).when(status.isin("accepted", "rejected"), F.lit(automatic))
    return queue.withColumns({"new_status": status, "is_changed": changed, "new_reviewed_by": by})


def rank_from_text(text: Column, default: Column) -> Column:
    """Rank that an affiliation line tells, abbreviations written out; else ``default``."""
    t = F.regexp_replace(F.regexp_replace(F.lower(text), r"\bassoc\b\.?", "associate"), r"\bass(?:is)?t\b\.?", "assistant")
    plain_title = t.rlike(r"\bprofessor\b") & ~t.contains("assistant") & ~t.contains("associate")
    return F.when(t.contains("assistant prof"), "assistant").when(t.contains("associate prof"), "associate").when(plain_title, "full").otherwise(default)


def roster_actions(profiles: DataFrame, hits: DataFrame, homes: DataFrame, owners: DataFrame) -> DataFrame:
    """(profile_id, action, to_department): what a profile says of an appointment; action null leaves it alone.

    profiles: profile_id, department_id and rank_name of the appointment, text, email (a
    domain), cites, years (since the doctorate). hits: profile_id, department_id that the text
    names; homes: department_id, domain; owners: domain, department_id. In order: a profile
    from before the appointment says nothing; a thin one or one of another field is 'wrong'; one at
    its department is a 'promote' if it tells a higher rank; a campus that is not tracked is a
    'depart'; the only other department named is a 'move', else the owner of the domain; an
    institution and a domain of neither is a 'depart'.
    """
    base = profiles.select("profile_id", "department_id", "rank_name", F.coalesce("text", F.lit("")).alias("text"), F.col("email"), "cites", "years")
    named = hits.select("profile_id", F.col("department_id").alias("_d")).distinct()
    owned = base.select("profile_id", "department_id", "email").join(owners.select(F.col("domain").alias("email"), F.col("department_id").alias("_owner")), "email", "left").select("profile_id", "department_id", "_owner")
    folded = owned.join(named, "profile_id", "left").groupBy("profile_id").agg(
        F.max("_owner").alias("_owner"),
        F.coalesce(F.bool_or(F.col("_d") == F.col("department_id")), F.lit(False)).alias("_here"),
        F.coalesce(F.bool_or(F.col("_d") == F.col("_owner")), F.lit(False)).alias("_at_owner"),
        F.count_if(F.col("_d") != F.col("department_id")).alias("_others"),
        F.min(F.when(F.col("_d") != F.col("department_id"), F.col("_d"))).alias("_other"),
    )
    at_home = homes.select("department_id", F.col("domain").alias("email"), F.lit(True).alias("_home")).distinct()
    j = base.join(folded, "profile_id").join(at_home, ["department_id", "email"], "left")
    low = F.lower("text")
    campus, institution = holds_any(low, UNTRACKED_CAMPUS), holds_any(low, HELD_INSTITUTION)
    here = F.col("_here") & ~campus
    away = F.coalesce(F.col("email") != "", F.lit(False)) & F.col("_home").isNull()
    thin = F.coalesce((F.col("cites") < THIN_CITES) & (F.col("years") >= THIN_YEARS), F.lit(False)) & ~F.col("_here")
    order = lambda c: F.coalesce(F.create_map(*[F.lit(x) for kv in RANK_ORDER.items() for x in kv])[c], F.lit(-1))
    up = order(rank_from_text(F.col("text"), F.col("rank_name"))) > order(F.col("rank_name"))
    by_owner = away & F.coalesce(F.col("_owner") != F.col("department_id"), F.lit(False)) & (~institution | F.col("_at_owner"))
    nothing = F.lit(None).cast("string")
    action = (
        F.when(holds_any(low, HELD_BEFORE_FACULTY), nothing).when(thin | (~here & holds_any(low, HELD_FOREIGN)), "wrong").when(here, F.when(up, "promote")).when(campus & away, "depart")
        .when((F.col("_others") == 1) | by_owner, "move").when(institution & away, "depart")
    )
    target = F.when(action == "promote", F.col("department_id")).when(action == "move", F.when(F.col("_others") == 1, F.col("_other")).otherwise(F.col("_owner")))
    return j.select("profile_id", action.alias("action"), target.alias("to_department"))


def apply_rank_review(intervals: DataFrame, decisions: DataFrame) -> DataFrame:
    """Appointment rows after a review of ranks, with ``outcome`` of each decided row.

    intervals: affiliation_id, person_id, department_id, rank_name, appointment_type,
    is_primary, start_day, end_day, source. decisions: affiliation_id, decision ('assistant',
    'associate', 'full', 'emeritus', 'adjunct or lecturer', 'left the program'), since (a
    date), decided_on (a date), reviewer; the latest decision of a row counts. A decision that
    agrees is noted as 'verified'; another closes the row at ``since``, or at decided_on, and
    opens a new one unless the person left; closed rows are 'skipped', unknown decisions close
    only. New ids follow the greatest id, in the order of the rows they follow.
    """
    told = decisions.where("decision is not null and decision <> ''").groupBy("affiliation_id").agg(F.max(F.struct("decided_on", "decision", "since", "reviewer")).alias("_r")).select("affiliation_id", "_r.*")
    told = told.withColumn("_start", F.coalesce("since", "decided_on")).withColumn("_note", F.concat(F.lit("rank verified "), F.date_format("decided_on", "yyyy-MM-dd"), F.lit(" by "), F.coalesce("reviewer", F.lit("reviewer"))))
    j = intervals.join(told, "affiliation_id", "left")
    same = F.col("decision") == F.col("rank_name")
    opens = F.col("decision").isin(*RANK_ORDER, *TYPES)
    outcome = (
        F.when(F.col("decision").isNull(), None).when(F.col("end_day").isNotNull(), "skipped").when(same, "verified")
        .when(F.col("decision").isin(*RANK_ORDER), "rank").when(opens, "type").when(F.col("decision") == "left the program", "left").otherwise("unknown")
    )
    j = materialize(j.withColumn("outcome", outcome), "reviewed")
    closes = F.coalesce(F.col("outcome").isin("rank", "type", "left", "unknown"), F.lit(False))
    source = F.when(F.col("outcome") == "verified", F.concat_ws(" | ", "source", "_note")).when(closes, F.concat_ws(" | ", "source", F.concat(F.lit("closed "), F.date_format("_start", "yyyy-MM-dd"), F.lit(": "), F.col("decision")), "_note")).otherwise(F.col("source"))
    cols = ["affiliation_id", "person_id", "department_id", "rank_name", "appointment_type", "is_primary", "start_day", "end_day", "source"]
    kept = j.withColumn("_end", F.when(closes, F.col("_start")).otherwise(F.col("end_day"))).withColumn("_src", source)
    kept = kept.select("affiliation_id", "person_id", "department_id", "rank_name", "appointment_type", "is_primary", "start_day", F.col("_end").alias("end_day"), F.col("_src").alias("source"), "outcome", F.lit(False).alias("is_new"))
    fresh = j.where("outcome in ('rank', 'type')")
    places = value_ranks(fresh.select("affiliation_id"), "affiliation_id").select(F.col("affiliation_id").alias("_a"), "rank_asc")
    top = intervals.agg(F.coalesce(F.max("affiliation_id"), F.lit(0)).alias("_top"))  # one row
    new_rank = F.when(F.col("outcome") == "rank", F.col("decision")).otherwise(F.col("rank_name"))
    kind = F.coalesce(F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])[F.col("decision")], F.lit("regular"))
    opened = fresh.join(places, F.col("affiliation_id") == F.col("_a")).join(F.broadcast(top)).select(
        (F.col("_top") + F.col("rank_asc")).alias("affiliation_id"), "person_id", "department_id", new_rank.alias("rank_name"), kind.alias("appointment_type"), F.lit(1).alias("is_primary"), F.col("_start").alias("start_day"),
        F.lit(None).cast("date").alias("end_day"), F.col("_note").alias("source"), "outcome", F.lit(True).alias("is_new"),
    )
    return kept.unionByName(opened.select(*cols, "outcome", "is_new"))

"""Queries of the discovery, roster and rank-review rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.text import flexible_date, rank_name
from tallymark.operators import changes as C
from tallymark.operators import metrics as M
from tallymark.operators import resolve as R
from tallymark.operators import rules as U
from tallymark.plans.base_sql import BASE, FLEX, RANK
from tallymark.plans.monitoring import _DOM
from tallymark.plans.resolution import _CP, _NORM
from tallymark.session import materialize, table
from tallymark.sources.standard import appointments, readings

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = BASE + sql
        return f

    return add


def _current(spark, d):
    return M.current_appointments(appointments(spark, d), table(spark, d, "department"))


# ------------------------------------------------------------ discovery
_Q = lambda words: ", ".join(f"'{w}'" for w in words)
_ANY = lambda c, words: f"regexp_matches({c}, '{'|'.join(words)}')"
_GENERIC = _Q(R.GENERIC)
_LABELS = f"labels AS (SELECT department_id, {_NORM.format(c='university')} AS name, list_filter(list_distinct(string_split({_NORM.format(c='university')}, ' ')), lambda w: w NOT IN ({_GENERIC}) AND length(w) > 2) AS need FROM department)"
_HIT = "len(need) > 0 AND (contains(' ' || txt || ' ', ' ' || name || ' ') OR (len(need) > 1 AND list_has_all(string_split(txt, ' '), need)))"
_STATUS = f"""CASE WHEN at_home THEN 'accepted' WHEN txt = '' OR txt IN ({_Q(U.PLACEHOLDERS)}) THEN 'pending'
  WHEN {_ANY('txt', U.FOUND_BEFORE_FACULTY)} OR {_ANY('txt', U.FOUND_FOREIGN)} OR coalesce(ratio > 4e0 OR ratio < 0.2e0, false) THEN 'rejected' WHEN tracked OR NOT {_ANY('txt', U.FOUND_INSTITUTION)} THEN 'pending' ELSE 'rejected' END"""
_FOUND = f""", {_LABELS}, kt AS (SELECT *, coalesce({_NORM.format(c='last_known_institution')}, '') AS txt, CASE WHEN NOT isnan(cites_ratio) THEN cites_ratio END AS ratio FROM identity_candidates WHERE external_id IS NOT NULL),
hits AS (SELECT candidate_id, person_id, department_id FROM kt, labels WHERE txt <> '' AND {_HIT}),
athome AS (SELECT DISTINCT h.candidate_id FROM hits h JOIN cur c ON c.person_id = h.person_id AND c.department_id = h.department_id),
judged AS (SELECT kt.*, kt.candidate_id IN (SELECT candidate_id FROM athome) AS at_home, kt.candidate_id IN (SELECT candidate_id FROM hits) AS tracked FROM kt),
found AS (SELECT candidate_id, person_id, external_id, source, status AS was, reviewed_by, {_STATUS} AS status, coalesce(CASE WHEN NOT isnan(name_sim) THEN name_sim END, 0) AS name,
  round(0.5e0 * coalesce(CASE WHEN NOT isnan(name_sim) THEN name_sim END, 0) + 0.35e0 * CASE WHEN at_home THEN 1e0 ELSE 0e0 END + 0.15e0 * {_CP.replace('0.1e0', '0.5e0').replace('1.5e0', '2e0').replace('0.03e0', '0.2e0').replace('3e0', '5e0')}, 6) AS score FROM judged),
folded AS (SELECT person_id, CASE WHEN count(*) FILTER (status = 'accepted') = 1 AND max(score) FILTER (status = 'accepted') >= 0.85e0 AND max(name) FILTER (status = 'accepted') >= 0.9e0
    AND round(max(score) FILTER (status = 'accepted') - greatest(coalesce(max(score) FILTER (status = 'pending'), 0), 0), 6) >= 0.15e0 THEN 'accepted' WHEN bool_and(status = 'rejected') THEN 'rejected' ELSE 'pending' END AS outcome
  FROM found WHERE person_id IS NOT NULL GROUP BY person_id)"""


def _found(spark, d):
    """Records with the status and score that the discovery rules give them."""
    recs = table(spark, d, "identity_candidates").where("external_id is not null")
    hits = materialize(R.label_hits(recs.where("last_known_institution is not null"), "candidate_id", "last_known_institution", table(spark, d, "department"), "department_id", "university"), "label-hits")
    mine = recs.where("person_id is not null").select("candidate_id", "person_id").join(hits, "candidate_id")
    home = mine.join(_current(spark, d).select("person_id", "department_id"), ["person_id", "department_id"], "left_semi").select("candidate_id").distinct().withColumn("_at", F.lit(True))
    tracked = hits.select("candidate_id").distinct().withColumn("_tracked", F.lit(True))
    j = recs.join(tracked, "candidate_id", "left").join(home, "candidate_id", "left")
    number = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double"))
    at_home, ratio, name = F.coalesce("_at", F.lit(False)), number("cites_ratio"), F.coalesce(number("name_sim"), F.lit(0.0))
    cites = F.when(ratio.isNull(), 0.5).when(ratio.between(0.5, 2.0), 1.0).when(ratio.between(0.2, 5.0), 0.5).otherwise(0.0)
    return j.select(
        "candidate_id", "person_id", "external_id", "source", F.col("status").alias("was"), "reviewed_by", U.found_status(at_home, F.col("last_known_institution"), ratio, F.coalesce("_tracked", F.lit(False))).alias("status"),
        name.alias("name_sim"), U.discovery_score(name, F.when(at_home, 1.0).otherwise(0.0), cites).alias("score"),
    )


@query(f"{_FOUND} SELECT candidate_id, status, score FROM found")
def discovery_statuses(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d).select("candidate_id", "status", "score")


@query(f"{_FOUND} SELECT candidate_id, person_id, outcome, CASE WHEN status = 'accepted' AND outcome <> 'accepted' THEN 'pending' ELSE status END AS status FROM found JOIN folded USING (person_id)")
def discovery_decisions(spark: SparkSession, d: str) -> DataFrame:
    return U.decide_found(_found(spark, d).where("person_id is not null"), "person_id").select("candidate_id", "person_id", "outcome", "status")


@query("""SELECT p.person_id, CASE WHEN k.n = 1 THEN k.e ELSE p.openalex_author_id END AS openalex_author_id, CASE WHEN k.n > 1 THEN 'contested' WHEN k.n = 1 AND p.openalex_author_id IS DISTINCT FROM k.e THEN 'written' ELSE 'kept' END AS outcome
FROM person p LEFT JOIN (SELECT person_id, count(*) AS n, min(external_id) AS e FROM identity_candidates WHERE status = 'accepted' AND external_id <> '' GROUP BY person_id) k USING (person_id)""")
def applied_decisions(spark: SparkSession, d: str) -> DataFrame:
    return U.apply_accepted(table(spark, d, "person"), table(spark, d, "identity_candidates"), "openalex_author_id")


@query(f"""{_FOUND}, fresh AS (SELECT k.candidate_id, k.status AS was, k.reviewed_by, CASE WHEN coalesce(k.external_id, '') = '' THEN CASE WHEN k.status = 'pending' THEN 'rejected' ELSE k.status END WHEN coalesce(k.reviewed_by, 'auto') <> 'auto' THEN k.status ELSE f.status END AS now
  FROM identity_candidates k LEFT JOIN found f USING (candidate_id))
SELECT candidate_id, now AS new_status, now <> was AS is_changed, CASE WHEN now = was THEN reviewed_by WHEN now IN ('accepted', 'rejected') THEN 'auto' END AS new_reviewed_by FROM fresh""")
def reclassified(spark: SparkSession, d: str) -> DataFrame:
    fresh = _found(spark, d).select("candidate_id", F.col("status").alias("_fresh"))
    queue = table(spark, d, "identity_candidates").join(fresh, "candidate_id", "left")
    return U.reclassify(queue, F.col("_fresh"), "auto").select("candidate_id", "new_status", "is_changed", "new_reviewed_by")


# ------------------------------------------------------------ roster
_JSON = "CASE WHEN json_valid(raw_json) THEN json_extract_string(raw_json, '$.affiliation') END"
_LOW = "lower(txt0)"
_TOLD = f"regexp_replace(regexp_replace({_LOW}, '\\bassoc\\b\\.?', 'associate', 'g'), '\\bass(?:is)?t\\b\\.?', 'assistant', 'g')"
_RANK_TOLD = f"CASE WHEN contains({_TOLD}, 'assistant prof') THEN 'assistant' WHEN contains({_TOLD}, 'associate prof') THEN 'associate' WHEN regexp_matches({_TOLD}, '\\bprofessor\\b') AND NOT contains({_TOLD}, 'assistant') AND NOT contains({_TOLD}, 'associate') THEN 'full' ELSE rank_name END"
_PLACE = "coalesce(list_position(['assistant', 'associate', 'full'], {c}), 0)"


@query(f""", {_LABELS}, paid AS (SELECT person_id, arg_max({_JSON}, (delivered_on, delivery_row_id)) FILTER ({_JSON} IS NOT NULL) AS txt0 FROM snapshot_delivery WHERE source = 'google_scholar' GROUP BY person_id),
votes AS (SELECT c.department_id, {_DOM.format(c='p.personal_url')} AS domain FROM cur c JOIN person p USING (person_id) WHERE p.personal_url IS NOT NULL),
homes AS (SELECT department_id, domain FROM (SELECT department_id, domain, count(*) AS n, row_number() OVER (PARTITION BY department_id ORDER BY count(*) DESC, domain) AS i FROM votes GROUP BY department_id, domain) WHERE i = 1 AND n > 1),
owners AS (SELECT domain, min(department_id) AS owner FROM homes GROUP BY domain),
prof AS (SELECT c.affiliation_id AS profile_id, c.person_id, c.department_id, c.rank_name, coalesce(q.txt0, '') AS txt0, {_NORM.format(c="coalesce(q.txt0, '')")} AS txt, {_DOM.format(c='p.personal_url')} AS email, h.total_citations AS cites, 2026 - p.phd_year AS years
  FROM cur c JOIN person p USING (person_id) LEFT JOIN paid q USING (person_id) LEFT JOIN heads h USING (person_id)),
hits AS (SELECT profile_id, l.department_id AS d FROM prof, labels l WHERE txt <> '' AND {_HIT}),
f AS (SELECT prof.*, o.owner, hm.domain IS NOT NULL AS home, EXISTS (SELECT 1 FROM hits x WHERE x.profile_id = prof.profile_id AND x.d = prof.department_id) AS here0, EXISTS (SELECT 1 FROM hits x WHERE x.profile_id = prof.profile_id AND x.d = o.owner) AS at_owner,
    (SELECT count(*) FROM hits x WHERE x.profile_id = prof.profile_id AND x.d <> prof.department_id) AS others, (SELECT min(x.d) FROM hits x WHERE x.profile_id = prof.profile_id AND x.d <> prof.department_id) AS other
  FROM prof LEFT JOIN owners o ON o.domain = prof.email LEFT JOIN homes hm ON hm.department_id = prof.department_id AND hm.domain = prof.email),
g AS (SELECT *, here0 AND NOT {_ANY(_LOW, U.UNTRACKED_CAMPUS)} AS here, coalesce(email <> '', false) AND NOT home AS away FROM f),
act AS (SELECT *, CASE WHEN {_ANY(_LOW, U.HELD_BEFORE_FACULTY)} THEN NULL WHEN (coalesce(cites < 25 AND years >= 5, false) AND NOT here0) OR (NOT here AND {_ANY(_LOW, U.HELD_FOREIGN)}) THEN 'wrong'
    WHEN here THEN CASE WHEN {_PLACE.format(c=_RANK_TOLD)} > {_PLACE.format(c='rank_name')} THEN 'promote' END WHEN {_ANY(_LOW, U.UNTRACKED_CAMPUS)} AND away THEN 'depart'
    WHEN others = 1 OR (away AND coalesce(owner <> department_id, false) AND (NOT {_ANY(_LOW, U.HELD_INSTITUTION)} OR at_owner)) THEN 'move' WHEN {_ANY(_LOW, U.HELD_INSTITUTION)} AND away THEN 'depart' END AS action FROM g)
SELECT profile_id, action, CASE action WHEN 'promote' THEN department_id WHEN 'move' THEN CASE WHEN others = 1 THEN other ELSE owner END END AS to_department FROM act""")
def roster_actions(spark: SparkSession, d: str) -> DataFrame:
    """What the latest profile text of each person with a current appointment says of it; the domain of the own page stands for that of the mail."""
    cur, people, dep = _current(spark, d), table(spark, d, "person"), table(spark, d, "department")
    said = F.when(F.get_json_object("raw_json", "$").isNotNull(), F.get_json_object("raw_json", "$.affiliation"))
    texts = table(spark, d, "snapshot_delivery").where("source = 'google_scholar'").select("person_id", "delivered_on", "delivery_row_id", said.alias("text")).where("text is not null")
    texts = texts.groupBy("person_id").agg(F.max_by("text", F.struct("delivered_on", "delivery_row_id")).alias("text"))
    heads = M.headline(readings(spark, d), people).select("person_id", F.col("total_citations").alias("cites"))
    who = people.select("person_id", C.registrable(F.col("personal_url")).alias("email"), (2026 - F.col("phd_year")).alias("years"))
    posts = materialize(cur.select(F.col("affiliation_id").alias("profile_id"), "person_id", "department_id", "rank_name").join(who, "person_id"), "posts")
    profiles = materialize(posts.join(texts, "person_id", "left").join(heads, "person_id", "left"), "profiles")
    homes = C.majority(posts.where("email is not null").select("department_id", F.col("email").alias("domain")), "department_id", "domain").select("department_id", "domain")
    homes = materialize(homes, "homes")
    owners = homes.groupBy("domain").agg(F.min("department_id").alias("department_id"))
    hits = R.label_hits(profiles.where("text is not null"), "profile_id", "text", dep, "department_id", "university")
    return U.roster_actions(profiles, hits, homes, owners)


_DECIDED = f"""told AS (SELECT person_id, arg_max({{'r': {RANK.format(c='"rank"')}, 's': {FLEX.format(c='start_date')}, 'o': extracted_on}}, (extracted_on, loaded_at, extract_id)) AS t FROM roster_extract GROUP BY person_id),
dec AS (SELECT a.*, f.source AS src, told.t.o AS decided_on, coalesce(told.t.s, told.t.o) AS st, CASE WHEN told.t.r <> 'other' THEN told.t.r WHEN told.t.r = 'other' THEN CASE a.affiliation_id % 3 WHEN 0 THEN 'emeritus' WHEN 1 THEN 'adjunct or lecturer' ELSE 'left the program' END END AS dec
  FROM ap a JOIN affiliation f ON f.affiliation_id = a.affiliation_id LEFT JOIN told ON told.person_id = a.person_id),
out AS (SELECT *, CASE WHEN dec IS NULL THEN NULL WHEN NOT (end_day IS NULL) THEN 'skipped' WHEN dec = rank_name THEN 'verified' WHEN dec IN ('assistant', 'associate', 'full') THEN 'rank' WHEN dec = 'left the program' THEN 'left' ELSE 'type' END AS outcome FROM dec)"""


@query(f""", {_DECIDED} SELECT affiliation_id, rank_name, appointment_type, start_day, CASE WHEN outcome IN ('rank', 'type', 'left') THEN st ELSE end_day END AS end_day, outcome, false AS is_new FROM out
UNION ALL SELECT (SELECT max(affiliation_id) FROM affiliation) + row_number() OVER (ORDER BY affiliation_id), CASE WHEN outcome = 'rank' THEN dec ELSE rank_name END, CASE dec WHEN 'emeritus' THEN 'emeritus' WHEN 'adjunct or lecturer' THEN 'adjunct' ELSE 'regular' END, st, NULL, outcome, true FROM out WHERE outcome IN ('rank', 'type')""")
def rank_review_applied(spark: SparkSession, d: str) -> DataFrame:
    """Appointments after a review that takes each person's latest extract for the decision; rank 'other' stands for three kinds of leaving, by id."""
    told = table(spark, d, "roster_extract").groupBy("person_id").agg(
        F.max_by(F.struct(rank_name(F.col("rank")).alias("r"), flexible_date(F.col("start_date")).alias("since"), F.col("extracted_on").alias("decided_on")), F.struct("extracted_on", "loaded_at", "extract_id")).alias("t")
    )
    leaves = F.element_at(F.array(F.lit("emeritus"), F.lit("adjunct or lecturer"), F.lit("left the program")), (F.col("affiliation_id") % 3 + 1).cast("int"))
    rows = appointments(spark, d)
    decisions = rows.select("affiliation_id", "person_id").join(told, "person_id").select("affiliation_id", F.when(F.col("t.r") == "other", leaves).otherwise(F.col("t.r")).alias("decision"), "t.since", "t.decided_on", F.lit("reviewer a").alias("reviewer"))
    return U.apply_rank_review(rows.drop("is_open"), decisions).select("affiliation_id", "rank_name", "appointment_type", "start_day", "end_day", "outcome", "is_new")

"""Queries of entity resolution and audit over the candidate records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.names import norm_name
from tallymark.functions.similarity import jaro_winkler
from tallymark.operators import audit as A
from tallymark.operators import metrics as M
from tallymark.operators import resolve as R
from tallymark.plans.base_sql import BASE
from tallymark.session import small_side, table
from tallymark.sources.standard import appointments, readings

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = (BASE.replace("WITH rd", "WITH RECURSIVE rd", 1) if ", walk AS" in sql else BASE) + sql
        return f

    return add


def _records(spark, d):
    return table(spark, d, "identity_candidates").where("person_id is not null and status <> 'none'")


_REC = "identity_candidates WHERE person_id IS NOT NULL AND status <> 'none'"
_NORM = "trim(regexp_replace(strip_accents(lower({c})), '[^a-z]+', ' ', 'g'))"


@query(f"SELECT person_id, {_NORM.format(c='display_name')} AS name FROM person")
def norm_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "person").select("person_id", norm_name(F.col("display_name")).alias("name"))


@query()
def jaro_winkler_pairs(spark: SparkSession, d: str) -> DataFrame:
    people = table(spark, d, "person").select("person_id", norm_name(F.col("display_name")).alias("ours"))
    return _records(spark, d).select("person_id", "candidate_id", norm_name(F.col("candidate_name")).alias("theirs")).join(people, "person_id").select("person_id", "candidate_id", F.round(jaro_winkler("ours", "theirs"), 6).alias("similarity"))


@query()
def name_similarity_pairs(spark: SparkSession, d: str) -> DataFrame:
    people = table(spark, d, "person").select("person_id", F.col("display_name").alias("own"), "first_name", "last_name")
    pairs = _records(spark, d).select("person_id", "candidate_id", F.array("candidate_name").alias("variants")).join(people, "person_id")
    return R.name_similarity(pairs, "own", "first_name", "last_name", "variants").select("person_id", "candidate_id", "similarity")


@query(f"""SELECT k.candidate_id, CASE WHEN u.hit THEN 1e0 WHEN n.inst <> '' AND n.phd <> '' AND (contains(n.inst, n.phd) OR contains(n.phd, n.inst)) THEN 0.5e0 ELSE 0e0 END AS inst_level
FROM identity_candidates k JOIN (SELECT candidate_id, coalesce({_NORM.format(c='last_known_institution')}, '') AS inst, coalesce({_NORM.format(c='p.phd_institution')}, '') AS phd
  FROM identity_candidates JOIN person p USING (person_id) WHERE status <> 'none') n USING (candidate_id)
LEFT JOIN (SELECT DISTINCT k.candidate_id, true AS hit FROM identity_candidates k JOIN cur c USING (person_id) JOIN department d ON d.department_id = c.department_id
  WHERE {_NORM.format(c='d.university')} = {_NORM.format(c='k.last_known_institution')}) u USING (candidate_id)""")
def institution_match(spark: SparkSession, d: str) -> DataFrame:
    recs = _records(spark, d).select("candidate_id", "person_id", F.coalesce(norm_name(F.col("last_known_institution")), F.lit("")).alias("inst"))
    phd = table(spark, d, "person").select("person_id", F.coalesce(norm_name(F.col("phd_institution")), F.lit("")).alias("phd"))
    home = M.current_appointments(appointments(spark, d), table(spark, d, "department")).join(small_side(table(spark, d, "department").select("department_id", norm_name(F.col("university")).alias("inst"))), "department_id")
    hits = recs.join(home.select("person_id", "inst"), ["person_id", "inst"], "left_semi").select("candidate_id", F.lit(True).alias("hit"))
    level = F.when(F.col("hit"), 1.0).when((F.col("inst") != "") & (F.col("phd") != "") & (F.col("inst").contains(F.col("phd")) | F.col("phd").contains(F.col("inst"))), 0.5).otherwise(0.0)
    return recs.join(phd, "person_id").join(hits, "candidate_id", "left").select("candidate_id", level.alias("inst_level"))


_PLAUS = "CASE WHEN {r} IS NULL THEN 0.5e0 WHEN {r} BETWEEN {a} AND {b} THEN 1e0 WHEN {r} BETWEEN {c} AND {e} THEN 0.5e0 ELSE 0e0 END"
_RATIO = "coalesce(k.cited_by_count, 0) / nullif(g.t, 0)"
_GS = "(SELECT person_id, max(total_citations) AS t FROM latest WHERE source = 'google_scholar' GROUP BY person_id) g"


@query(f"""SELECT candidate_id, {_PLAUS.format(r=_RATIO, a='0.1e0', b='1.5e0', c='0.03e0', e='3e0')} AS matcher, {_PLAUS.format(r=_RATIO, a='0.5e0', b='2e0', c='0.2e0', e='5e0')} AS discovery
FROM (SELECT * FROM {_REC}) k LEFT JOIN {_GS} USING (person_id)""")
def plausibility_levels(spark: SparkSession, d: str) -> DataFrame:
    g = M.latest_readings(readings(spark, d)).where("source = 'google_scholar'").groupBy("person_id").agg(F.max("total_citations").alias("t"))
    j = _records(spark, d).select("candidate_id", "person_id", "cited_by_count").join(g, "person_id", "left")
    return j.select("candidate_id", R.plausibility(F.col("cited_by_count"), F.col("t"), (0.1, 1.5), (0.03, 3.0)).alias("matcher"), R.plausibility(F.col("cited_by_count"), F.col("t"), (0.5, 2.0), (0.2, 5.0)).alias("discovery"))


_CP = "CASE WHEN cites_ratio IS NULL OR isnan(cites_ratio) THEN 0.5e0 WHEN cites_ratio BETWEEN 0.1e0 AND 1.5e0 THEN 1e0 WHEN cites_ratio BETWEEN 0.03e0 AND 3e0 THEN 0.5e0 ELSE 0e0 END"
_Z = "coalesce(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, {v})"
_SCORED = f"""scored AS (SELECT *, round(0.45e0 * {_Z.format(c='name_sim', v='0e0')} + 0.3e0 * {_Z.format(c='inst_match', v='0e0')} + 0.15e0 * {_Z.format(c='topic_share', v='0.5e0')} + 0.1e0 * {_CP}, 6) AS total
  FROM {_REC})"""


def _scored(spark, d):
    z = lambda c, v: F.coalesce(F.nanvl(F.col(c), F.lit(None).cast("double")), F.lit(v))
    ratio = F.nanvl(F.col("cites_ratio"), F.lit(None).cast("double"))
    cp = F.when(ratio.isNull(), 0.5).when(ratio.between(0.1, 1.5), 1.0).when(ratio.between(0.03, 3.0), 0.5).otherwise(0.0)
    total = 0.45 * z("name_sim", 0.0) + 0.3 * z("inst_match", 0.0) + 0.15 * z("topic_share", 0.5) + 0.1 * cp
    return _records(spark, d).withColumn("total", F.round(total, 6))


@query(f", {_SCORED} SELECT candidate_id, total FROM scored")
def candidate_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("candidate_id", "total")


_TOP = f""", {_SCORED}, top AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY total DESC, candidate_id) AS place FROM scored QUALIFY place <= 5)"""


@query(f"{_TOP} SELECT person_id, candidate_id, total, place FROM top")
def candidate_topk(spark: SparkSession, d: str) -> DataFrame:
    return R.top_candidates(_scored(spark, d), "person_id", "total", "candidate_id").select("person_id", "candidate_id", "total", F.col("place").cast("bigint").alias("place"))


@query(f"""{_TOP}, flagged AS (SELECT *, coalesce(works_count, 0) <= 5 AND coalesce(cited_by_count, 0) < 50 AS stub FROM top)
SELECT a.person_id, CASE WHEN NOT a.stub AND a.total >= 0.75e0 AND a.name_sim >= 0.9e0 AND a.inst_match >= 1 AND a.total - coalesce(b.runner, 0) >= 0.15e0 THEN 'accepted' ELSE 'pending' END AS decision
FROM flagged a LEFT JOIN (SELECT person_id, max(total) AS runner FROM flagged WHERE place > 1 AND NOT stub GROUP BY person_id) b USING (person_id) WHERE a.place = 1""")
def candidate_decisions(spark: SparkSession, d: str) -> DataFrame:
    scored = _scored(spark, d).drop("score").withColumnRenamed("total", "score")
    for c in ("name_sim", "inst_match"):
        scored = scored.withColumn(c, F.nanvl(F.col(c), F.lit(None).cast("double")))
    return R.decide(R.top_candidates(scored, "person_id", "score", "candidate_id"), "person_id")


@query("""SELECT person_id, arg_max(candidate_id, (coalesce(works_count, 0), coalesce(cited_by_count, 0), -candidate_id)) AS primary_id FROM identity_candidates WHERE status = 'accepted' GROUP BY person_id""")
def primary_record(spark: SparkSession, d: str) -> DataFrame:
    return R.primary_record(_records(spark, d).where("status = 'accepted'"), "person_id", "candidate_id", "candidate_id")


@query("""SELECT person_id, arg_max(total_citations, (CASE source WHEN 'google_scholar' THEN 2 WHEN 'pop' THEN 1 ELSE 0 END, moment, snapshot_id)) AS known_total FROM rd
WHERE total_citations IS NOT NULL AND moment IS NOT NULL GROUP BY person_id""")
def known_totals(spark: SparkSession, d: str) -> DataFrame:
    level = F.when(F.col("source") == "google_scholar", 2).when(F.col("source") == "pop", 1).otherwise(0)
    rows = readings(spark, d).where("total_citations is not null and moment is not null")
    return rows.groupBy("person_id").agg(F.max_by("total_citations", F.struct(level, "moment", "snapshot_id")).alias("known_total"))


@query("SELECT p.person_id, p.orcid FROM person p WHERE p.orcid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM identity_candidates k WHERE k.status = 'accepted' AND k.person_id = p.person_id AND k.orcid = p.orcid)")
def orcid_independent(spark: SparkSession, d: str) -> DataFrame:
    carried = _records(spark, d).where("status = 'accepted' and orcid is not null").select("person_id", "orcid")
    return table(spark, d, "person").where("orcid is not null").select("person_id", "orcid").join(carried, ["person_id", "orcid"], "left_anti")


@query(f"""{_TOP} SELECT candidate_id, person_id, status FROM identity_candidates WHERE person_id IS NOT NULL AND person_id NOT IN (SELECT person_id FROM top)
UNION ALL SELECT candidate_id, person_id, CASE WHEN reviewed_by LIKE 'reviewer%' THEN status ELSE 'pending' END FROM top""")
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    queue = table(spark, d, "identity_candidates").where("person_id is not null").select("candidate_id", "person_id", "status")
    new = R.top_candidates(_scored(spark, d), "person_id", "total", "candidate_id")
    new = new.select("candidate_id", "person_id", F.when(F.col("reviewed_by").startswith("reviewer"), F.col("status")).otherwise("pending").alias("status"))
    return R.carry_forward(queue, new, "person_id")


_GEN = ", ".join(f"'{w}'" for w in R.GENERIC)


@query(f""", labels AS (SELECT department_id, {_NORM.format(c='university')} AS name, list_filter(list_distinct(string_split({_NORM.format(c='university')}, ' ')), lambda w: w NOT IN ({_GEN}) AND length(w) > 2) AS need FROM department),
texts AS (SELECT candidate_id, {_NORM.format(c='last_known_institution')} AS txt FROM identity_candidates WHERE last_known_institution IS NOT NULL)
SELECT candidate_id, department_id FROM texts, labels WHERE len(need) > 0 AND (contains(' ' || txt || ' ', ' ' || name || ' ') OR (len(need) > 1 AND list_has_all(string_split(txt, ' '), need)))""")
def affiliation_labels(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "identity_candidates").where("last_known_institution is not null")
    return R.label_hits(texts, "candidate_id", "last_known_institution", table(spark, d, "department"), "department_id", "university")


_WORDS = lambda t, c: f"SELECT DISTINCT unnest(string_split({_NORM.format(c=c)}, ' ')) AS w FROM {t} WHERE {c} IS NOT NULL"


@query(f"SELECT x.w AS a, y.w AS b FROM ({_WORDS('identity_candidates', 'last_known_institution')}) x, ({_WORDS('department', 'university')}) y WHERE abs(length(x.w) - length(y.w)) < 2 AND levenshtein(x.w, y.w) < 2")
def edit_distance_le1(spark: SparkSession, d: str) -> DataFrame:
    words = lambda t, c: table(spark, d, t).select(F.explode(F.split(norm_name(F.col(c)), " ")).alias("w"))
    return R.near_words(words("identity_candidates", "last_known_institution"), words("department", "university"))


@query("SELECT university, arg_min(department_id, (kind <> 'planning', ror_id IS NULL, department_id)) AS department_id FROM department GROUP BY university")
def resolve_institution(spark: SparkSession, d: str) -> DataFrame:
    order = F.struct(F.col("kind") != "planning", F.col("ror_id").isNull(), "department_id")
    return table(spark, d, "department").groupBy("university").agg(F.min_by("department_id", order).alias("department_id"))


@query(f""", who AS (SELECT person_id, {_NORM.format(c='first_name')} AS f, string_split({_NORM.format(c='last_name')}, ' ') AS l FROM person),
txt AS (SELECT candidate_id, string_split({_NORM.format(c='candidate_name')}, ' ') AS ws FROM {_REC}),
held AS (SELECT candidate_id, person_id, f, list_filter(ws, lambda w: NOT list_contains(l, w))[1] AS lead FROM txt, who WHERE list_has_all(ws, l)),
agreed AS (SELECT candidate_id, person_id, CASE WHEN lead = f THEN 1e0 WHEN starts_with(f, lead) OR starts_with(lead, f) THEN 0.9e0 ELSE 0e0 END AS agreement FROM held)
SELECT candidate_id, arg_max(person_id, (agreement, -person_id)) AS person_id, max(agreement) AS agreement FROM agreed WHERE agreement >= 0.85e0 GROUP BY candidate_id""")
def known_people(spark: SparkSession, d: str) -> DataFrame:
    return R.known_people(_records(spark, d), "candidate_id", "candidate_name", table(spark, d, "person"))


@query("SELECT person_id, count(*) AS n FROM identity_candidates WHERE status IN ('accepted', 'rejected') GROUP BY person_id HAVING count(*) > 1")
def multiple_accepts(spark: SparkSession, d: str) -> DataFrame:
    """People with several decided records."""
    return _records(spark, d).where("status in ('accepted', 'rejected')").groupBy("person_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("""SELECT person_id, candidate_id, row_number() OVER (PARTITION BY person_id ORDER BY candidate_id) AS place FROM identity_candidates k
WHERE person_id IS NOT NULL AND name_sim >= 0.9e0 AND NOT isnan(name_sim) AND status <> 'rejected' QUALIFY place <= 4""")
def plausible_links(spark: SparkSession, d: str) -> DataFrame:
    rows = _records(spark, d).where("name_sim >= 0.9 and not isnan(name_sim) and status <> 'rejected'").withColumn("order_key", F.lit(0))
    return R.top_candidates(rows, "person_id", "order_key", "candidate_id", keep=4).select("person_id", "candidate_id", F.col("place").cast("bigint").alias("place"))


@query("SELECT person_id, max(reviewed_at) AS last_searched FROM identity_candidates WHERE person_id IS NOT NULL GROUP BY person_id")
def last_searched(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "identity_candidates").where("person_id is not null").groupBy("person_id").agg(F.max("reviewed_at").alias("last_searched"))


# ------------------------------------------------------------ audit
_BASE_T = "(SELECT person_id, max(total_citations) AS base FROM latest WHERE source IN ('google_scholar', 'pop') GROUP BY person_id) b"


def _with_base(spark, d, status: str):
    base = M.latest_readings(readings(spark, d)).where("source in ('google_scholar', 'pop')").groupBy("person_id").agg(F.max("total_citations").alias("base"))
    return table(spark, d, "identity_candidates").where(f"person_id is not null and {status}").join(base, "person_id", "left")


@query(f"""SELECT candidate_id, cited_by_count / base AS ratio FROM identity_candidates k JOIN {_BASE_T} USING (person_id)
WHERE status = 'accepted' AND base >= 25 AND (cited_by_count > 3 * base OR cited_by_count / base < 0.05e0)""")
def audit_implausible(spark: SparkSession, d: str) -> DataFrame:
    rows = _with_base(spark, d, "status = 'accepted'").withColumn("ratio", A.implausible(F.col("cited_by_count"), F.col("base")))
    return rows.where("ratio is not null").select("candidate_id", "ratio")


_SETTLE = f""", rows AS (SELECT k.person_id, k.candidate_id, CASE WHEN isnan(k.topic_share) THEN NULL ELSE k.topic_share END AS topic, k.cited_by_count AS c, coalesce(k.works_count, 0) AS w, b.base,
  coalesce(k.last_known_institution = h.home, true) AS inst_ok, coalesce(h.total, 0) AS held, h.total IS NOT NULL AS has
  FROM identity_candidates k LEFT JOIN {_BASE_T} USING (person_id) LEFT JOIN (SELECT person_id, sum(cited_by_count) AS total, arg_max(last_known_institution, (coalesce(works_count, 0), candidate_id)) AS home FROM identity_candidates WHERE status = 'accepted' GROUP BY person_id) h USING (person_id)
  WHERE k.status = 'rejected' AND k.person_id IS NOT NULL AND k.name_sim >= 0.85e0 AND NOT isnan(k.name_sim)),
seq AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY candidate_id) AS i FROM rows)"""
_TAKES = """(w <= 3 OR coalesce(base >= 25 AND c IS NOT NULL AND CASE WHEN {has} THEN (inst_ok OR coalesce(topic, 0) >= 0.5e0) AND ({total} + c) / base <= 1.2e0 ELSE c / base <= 1.5e0 END, false))"""


_FIRST = _TAKES.format(has="has", total="held")
_LATER = "(s.w <= 3 OR coalesce(s.base >= 25 AND s.c IS NOT NULL AND CASE WHEN v.has_now THEN (s.inst_ok OR coalesce(s.topic, 0) >= 0.5e0) AND (v.total + s.c) / s.base <= 1.2e0 ELSE s.c / s.base <= 1.5e0 END, false))"


@query(
    _SETTLE
    + f""", walk AS (SELECT person_id, candidate_id, i, {_FIRST} AS take, held + CASE WHEN {_FIRST} THEN coalesce(c, 0) ELSE 0 END AS total, has OR ({_FIRST} AND c IS NOT NULL) AS has_now FROM seq WHERE i = 1
  UNION ALL SELECT person_id, candidate_id, i, take, total + CASE WHEN take THEN coalesce(c, 0) ELSE 0 END, has_now OR (take AND c IS NOT NULL) FROM (
    SELECT s.person_id, s.candidate_id, s.i, s.c, v.total, v.has_now, {_LATER} AS take FROM walk v JOIN seq s ON s.person_id = v.person_id AND s.i = v.i + 1))
SELECT person_id, candidate_id FROM walk WHERE take"""
)
def greedy_settle(spark: SparkSession, d: str) -> DataFrame:
    """Rejected records of a like name that a person could still take beside the accepted ones, in candidate order, each raising the total that later ones see."""
    order = F.struct(F.coalesce("works_count", F.lit(0)), "candidate_id")
    held = _records(spark, d).where("status = 'accepted'").groupBy("person_id").agg(F.sum("cited_by_count").alias("held"), F.max_by("last_known_institution", order).alias("home"))
    rows = _with_base(spark, d, "status = 'rejected'").join(held, "person_id", "left").where("name_sim >= 0.85D and not isnan(name_sim)").select(
        "person_id", "candidate_id", F.lit(1.0).alias("name_sim"), F.lit(1.0).alias("inst_match"), "cited_by_count", "works_count", "base", F.coalesce("held", F.lit(0)).alias("held"), F.col("held").isNotNull().alias("has_record"),
        (F.col("last_known_institution") == F.col("home")).alias("last_inst_ok"), F.nanvl("topic_share", F.lit(None).cast("double")).alias("topic_share"),
    )
    return A.settle(rows, "person_id", "candidate_id")


@query(f"""SELECT person_id, count(*) AS n FROM (SELECT k.person_id, coalesce(base >= 25 AND (cited_by_count > 3 * base OR cited_by_count / base < 0.05e0), false) AS flagged
FROM (SELECT * FROM {_REC}) k LEFT JOIN {_BASE_T} USING (person_id)) GROUP BY person_id HAVING bool_and(flagged)""")
def all_flagged(spark: SparkSession, d: str) -> DataFrame:
    rows = _with_base(spark, d, "status <> 'none'").withColumn("flagged", A.implausible(F.col("cited_by_count"), F.col("base")).isNotNull())
    return A.all_flagged(rows, "person_id", "flagged")


@query(f"""SELECT candidate_id, CASE WHEN status = 'accepted' AND r > 3 THEN 'rejected' WHEN status = 'rejected' AND r BETWEEN 0.5e0 AND 1.5e0 AND reviewed_by NOT LIKE 'reviewer%' THEN 'pending' ELSE status END AS status
FROM (SELECT k.*, CASE WHEN base >= 25 THEN cited_by_count / base END AS r FROM (SELECT * FROM {_REC}) k LEFT JOIN {_BASE_T} USING (person_id))""")
def audit_update(spark: SparkSession, d: str) -> DataFrame:
    """Status after the audit: decisions in order of precedence, a reviewer's rejection stands."""
    ratio = F.when(F.col("base") >= A.MIN_BASE, F.col("cited_by_count") / F.col("base"))
    rows = _with_base(spark, d, "status <> 'none'").withColumn("r", ratio)
    back = (F.col("status") == "rejected") & F.col("r").between(0.5, 1.5) & ~F.col("reviewed_by").startswith("reviewer")
    return rows.select("candidate_id", F.when((F.col("status") == "accepted") & (F.col("r") > A.MAX_RATIO), "rejected").when(back, "pending").otherwise(F.col("status")).alias("status"))


@query(f"""SELECT candidate_id, CASE WHEN n < 0.8e0 OR n IS NULL THEN 'D' WHEN n >= 0.95e0 AND i >= 1 THEN 'A' WHEN i >= 1 THEN 'B' WHEN n >= 0.95e0 THEN 'C' ELSE 'D' END AS band,
  candidate_id = first_value(candidate_id) OVER (PARTITION BY person_id ORDER BY coalesce(works_count, 0) DESC, candidate_id) AS is_best
FROM (SELECT *, CASE WHEN NOT isnan(name_sim) THEN name_sim END AS n, CASE WHEN NOT isnan(inst_match) THEN inst_match END AS i FROM {_REC})""")
def review_bands(spark: SparkSession, d: str) -> DataFrame:
    n, i = F.nanvl("name_sim", F.lit(None).cast("double")), F.nanvl("inst_match", F.lit(None).cast("double"))
    band = F.when((n < 0.8) | n.isNull(), "D").when((n >= 0.95) & (i >= 1), "A").when(i >= 1, "B").when(n >= 0.95, "C").otherwise("D")
    rows = _records(spark, d)
    best = rows.groupBy("person_id").agg(F.max_by("candidate_id", F.struct(F.coalesce("works_count", F.lit(0)), -F.col("candidate_id"))).alias("best"))
    return rows.join(best, "person_id").select("candidate_id", band.alias("band"), (F.col("candidate_id") == F.col("best")).alias("is_best"))

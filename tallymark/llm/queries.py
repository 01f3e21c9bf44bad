"""Queries of the problems tagged llm, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.text import rank_name, source_name, source_trust, usable, written_day, written_millis
from tallymark.llm.digest import RANK_ERROR, certified, digests, estimates, exact_medians, exact_percentiles, merge
from tallymark.llm.linkage import institution_parts, link, name_forms
from tallymark.llm.lookalike import lookalike_classes, lookalike_pairs, unified
from tallymark.llm.mixing import Target, mix, shares
from tallymark.llm.packing import pack
from tallymark.llm.survivor import Bundle, Dependency, survivors
from tallymark.llm.tokens import with_token_counts
from tallymark.session import materialize, shuffled, small_side, table

# ---------------------------------------------------------------- problem 1
FIGURES = ("total_citations", "h_index", "works_count")


FIVE_YEAR = ("citations_5yr", "h_index_5yr")


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("collected_at")
    return table(spark, sf_dir, "metric_snapshot").select(
        "snapshot_id", "person_id", source_name(F.col("source")).alias("source_even"), written_day(at).alias("reading_day"), written_millis(at).alias("millis"), *[usable(F.col(f)).alias(f) for f in (*FIGURES, *FIVE_YEAR)]
    )


def _best(spark: SparkSession, sf_dir: str, with_fields: bool) -> DataFrame:
    """The surviving record of each person and day.

    The three figures come each from its best reading. The five-year figures are a bundle of a
    lower claim: if they come from the source of the total, then from its moment too, for a
    source's reading of another moment does not go with it. Where that breaks, the search branches.
    """
    own = lambda *f: (*f, "source_even") if with_fields else ()
    bundles = [Bundle(f"best_{f}", own(f), F.col(f).isNotNull()) for f in FIGURES]
    bundles.append(Bundle("best_five_year", own(*FIVE_YEAR), F.col(FIVE_YEAR[0]).isNotNull() | F.col(FIVE_YEAR[1]).isNotNull(), tier=1))
    rules = [Dependency(("source_even",), ("millis",), among=("best_total_citations", "best_five_year"))]
    trust = [source_trust(F.col("source_even")), F.col("millis")]
    return survivors(_readings(spark, sf_dir), ["person_id", "reading_day"], "snapshot_id", trust, bundles, rules)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(f).alias("metric_name"), F.col(f"best_{f}.snapshot_id").alias("snapshot_id")) for f in FIGURES])
    return (
        _best(spark, sf_dir, False)
        .select("person_id", "reading_day", F.explode(each).alias("e"))
        .select("person_id", "reading_day", F.col("e.metric_name").alias("metric_name"), F.col("e.snapshot_id").alias("snapshot_id"))
        .where(F.col("snapshot_id").isNotNull())
    )


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of each group with the source of each bundle, and whether its search branched."""
    best = lambda b, f: F.col(f"best_{b}.{f}")
    return _best(spark, sf_dir, True).select(
        "person_id", "reading_day", *[best(f, f).alias(f) for f in FIGURES], *[best("five_year", f).alias(f) for f in FIVE_YEAR], *[best(f, "source_even").alias(f"{f}_source") for f in (*FIGURES, "five_year")], "branched"
    )


def p1_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors in which one source gives one h-index and one total: source fixes both among the chosen records."""
    bundles = [Bundle(f"best_{f}", (f, "source_even"), F.col(f).isNotNull()) for f in FIGURES]
    trust = [source_trust(F.col("source_even")), F.col("millis")]
    out = survivors(_readings(spark, sf_dir), ["person_id", "reading_day"], "snapshot_id", trust, bundles, [Dependency(("source_even",), ("h_index", "total_citations"))])
    return out.select("person_id", "reading_day", *[F.col(f"best_{f}.{f}").alias(f) for f in FIGURES])


# ---------------------------------------------------------------- problem 2
MEASURES = ("total_citations", "h_index")


def _latest_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings on the latest written day of their person and source, with the person's current rank.

    One row per reading and measure with a usable figure. A person with several current rows
    of different rank has the rank of the greatest affiliation_id.
    """
    current = (
        table(spark, sf_dir, "affiliation")
        .where(F.col("end_date").isNull() & (F.col("is_primary") == 1) & (F.col("appointment_type") == "regular"))
        .groupBy("person_id")
        .agg(F.max(F.when(rank_name(F.col("rank")).isNotNull(), F.struct("affiliation_id", rank_name(F.col("rank")).alias("rank_name")))).alias("r"))
        .select("person_id", F.col("r.rank_name").alias("rank_name"))
        .where("rank_name is not null")
    )
    readings = table(spark, sf_dir, "metric_snapshot").select(
        "snapshot_id", "person_id", source_name(F.col("source")).alias("source_name"), F.to_date(written_day(F.col("collected_at"))).alias("day"), *[usable(F.col(f)).alias(f) for f in MEASURES]
    )
    readings = readings.where("source_name is not null and day is not null")
    last = readings.groupBy("person_id", "source_name").agg(F.max("day").alias("day")).join(current, "person_id")
    rows = readings.join(last, ["person_id", "source_name", "day"])
    cells = F.array(*[F.struct(F.lit(f).alias("metric_name"), F.col(f).alias("figure")) for f in MEASURES])
    return (
        rows.select("snapshot_id", "source_name", "rank_name", "day", F.explode(cells).alias("c"))
        .select("snapshot_id", "source_name", "rank_name", "day", "c.metric_name", "c.figure")
        .where("figure is not null")
    )


GROUPS = ["metric_name", "source_name", "rank_name"]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(_latest_readings(spark, sf_dir), "latest")
    medians = exact_medians(rows, GROUPS, F.col("figure"))
    # Fixed value: a figure is far out beyond 25 times the median.
    return rows.join(small_side(medians), GROUPS).where(F.col("figure") > 25 * F.col("median")).select("metric_name", "snapshot_id")


QUANTILES = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


def _estimates(rows: DataFrame) -> DataFrame:
    est = materialize(estimates(merge(digests(rows, GROUPS, F.col("figure")), GROUPS), GROUPS, QUANTILES), "estimates")
    return certified(rows, GROUPS, F.col("figure"), est)


def p2_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest estimates per measure, source and rank, each with the rank error that the second pass counted."""
    return _estimates(materialize(_latest_readings(spark, sf_dir), "latest"))


def p2_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles, and whether the estimate from the digest kept the stated error bound."""
    rows = materialize(_latest_readings(spark, sf_dir), "latest")
    sure = _estimates(rows).select(*GROUPS, "quantile", (F.col("rank_error") <= RANK_ERROR).alias("within_bound"))
    return exact_percentiles(rows, GROUPS, F.col("figure"), QUANTILES).join(small_side(sure), [*GROUPS, "quantile"])


def p2_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of separate months merged to the whole: the combined estimates with their proven error."""
    rows = materialize(_latest_readings(spark, sf_dir).withColumn("month", F.date_format("day", "yyyy-MM")), "latest")
    monthly = merge(digests(rows, [*GROUPS, "month"], F.col("figure")), [*GROUPS, "month"])
    est = materialize(estimates(merge(monthly, GROUPS), GROUPS, [0.5]), "estimates")
    return certified(rows, GROUPS, F.col("figure"), est)


# ---------------------------------------------------------------- problem 7
def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per person with every name, university, doctorate and figure on file."""
    person = table(spark, sf_dir, "person").select("person_id", "first_name", "middle_name", "last_name", "display_name", "phd_institution")
    names = F.array("display_name", F.concat_ws(" ", "first_name", "middle_name", "last_name"))
    forms = person.select("person_id", F.explode(names).alias("name")).unionByName(table(spark, sf_dir, "person_alias").select("person_id", F.col("alias").alias("name")))
    forms = forms.select("person_id", F.explode(name_forms(F.col("name"))).alias("form")).groupBy("person_id").agg(F.collect_set("form").alias("forms"))
    schools = table(spark, sf_dir, "department").select("department_id", F.explode(institution_parts(F.col("university"))).alias("school"))
    insts = shuffled(table(spark, sf_dir, "affiliation").select("person_id", "department_id").distinct()).join(small_side(schools), "department_id").groupBy("person_id").agg(F.collect_set("school").alias("insts"))
    figures = table(spark, sf_dir, "metric_snapshot").select(
        "person_id", source_name(F.col("source")).alias("source_name"), usable(F.col("total_citations")).alias("total"), usable(F.col("h_index")).alias("h")
    )
    # The middle reading of a source does not follow single readings far out of range.
    figures = figures.groupBy("person_id", "source_name").agg(F.percentile_approx("total", 0.7, 200).alias("total"), F.percentile_approx("h", 0.7, 200).alias("h"))
    figures = figures.groupBy("person_id").agg(F.collect_set("total").alias("counts"), F.collect_set("h").alias("indexes"))
    none = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind)).alias(c)
    return (
        person.select("person_id", F.coalesce(institution_parts(F.col("phd_institution")), F.array().cast("array<string>")).alias("doctorate"))
        .join(shuffled(forms), "person_id")
        .join(shuffled(insts), "person_id", "left")
        .join(shuffled(figures), "person_id", "left")
        .select("person_id", "forms", none("insts", "array<string>"), "doctorate", none("counts", "array<bigint>"), none("indexes", "array<bigint>"))
    )


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "identity_candidates")
        .where("status = 'pending'")
        .select(
            "candidate_id",
            name_forms(F.col("candidate_name")).alias("forms"),
            F.coalesce(institution_parts(F.col("last_known_institution")), F.array().cast("array<string>")).alias("insts"),
            usable(F.col("cited_by_count")).alias("count"),
            usable(F.col("h_index")).alias("h_index"),
            F.col("name_sim").alias("reported"),
        )
        .where("size(forms) > 0")
    )


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = materialize(_people(spark, sf_dir), "linkage-people")
    found = materialize(_candidates(spark, sf_dir), "linkage-found")
    return link(people, found)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).select("person_id", "candidate_id")


def p7_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches with their levels of agreement and confidence."""
    return _linked(spark, sf_dir).withColumn("confidence", F.round("confidence", 4))


# ---------------------------------------------------------------- problem 8
def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents and fill of the containers of each spec, over all documents."""
    specs = {int(r["spec_id"]): int(r["capacity_tokens"]) for r in table(spark, sf_dir, "container_spec").where("spec_id is not null and capacity_tokens > 0").collect()}  # three rows
    sizes = with_token_counts(table(spark, sf_dir, "documents"), "text", keep=["doc_id"])
    return pack(sizes, "doc_id", "n_tokens", specs)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and mean fill by spec, beside the fewest containers that could hold the tokens."""
    each = p8_containers(spark, sf_dir).groupBy("spec_id", "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("items"))
    total = each.groupBy("spec_id", "capacity_tokens").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("items").alias("n_items"), F.sum("used").alias("n_tokens"))
    least = F.ceil(F.col("n_tokens") / F.col("capacity_tokens"))
    return total.withColumn("least_containers", least).withColumn("fill", F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")))


def p8_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every packing must keep, counted by spec: documents placed, tokens lost, containers over capacity, split items that fit, gaps between pieces, and whether at most one container is under half full."""
    rows = materialize(p8_containers(spark, sf_dir), "packed")
    sizes = with_token_counts(table(spark, sf_dir, "documents"), "text", keep=["doc_id"]).where("n_tokens is not null")
    pieces = rows.groupBy("spec_id", "capacity_tokens", "doc_id").agg(F.sum("n_tokens").alias("placed"), F.count(F.lit(1)).alias("k"), F.max(F.col("first_token") + F.col("n_tokens")).alias("reach"))
    of_docs = (
        pieces.join(sizes, "doc_id", "full")
        .groupBy("spec_id", "capacity_tokens")
        .agg(
            F.count("placed").alias("n_documents"),
            F.sum(F.coalesce("n_tokens", F.lit(0)) - F.coalesce("placed", F.lit(0))).alias("n_lost"),
            F.count_if((F.col("k") > 1) & (F.col("n_tokens") <= F.col("capacity_tokens"))).alias("n_split_that_fit"),
            F.count_if(F.col("reach") != F.col("placed")).alias("n_gaps"),
        )
    )
    bins = rows.groupBy("spec_id", "container_id", F.col("capacity_tokens").alias("cap")).agg(F.sum("n_tokens").alias("used"), F.max("container_tokens").alias("said"))
    of_bins = bins.groupBy("spec_id").agg(F.count_if((F.col("used") > F.col("cap")) | (F.col("used") != F.col("said"))).alias("n_overfull"), (F.count_if(F.col("used") * 2 < F.col("cap")) <= 1).alias("is_tight"))
    return of_docs.join(of_bins, "spec_id")


# ---------------------------------------------------------------- problem 9
def _source_key(c: Column) -> Column:
    """Spelling of a document source: lower case, no outer spaces, '_' for '-' and spaces."""
    return F.regexp_replace(F.lower(F.trim(c)), "[-\\s]+", "_")


def _targets(spark: SparkSession, sf_dir: str) -> list[Target]:
    rows = table(spark, sf_dir, "mix_target").where("source is not null").withColumn("source", _source_key(F.col("source"))).collect()  # eight rows
    return [Target(r["source"], float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in rows]


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the mixture with the times each is used."""
    docs = table(spark, sf_dir, "documents").select("doc_id", _source_key(F.col("source")).alias("source"), F.md5("text").alias("text_key"), "text")
    sizes = with_token_counts(docs, "text", keep=["doc_id", "source", "text_key"])
    return mix(sizes, "doc_id", "text_key", "source", "n_tokens", _targets(spark, sf_dir))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(p9_mixture(spark, sf_dir), "source", _targets(spark, sf_dir))


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every mixture must keep, by target source: uses of a document over its limit, documents of other sources, and whether the share is within one percent and two of the longest documents."""
    targets = _targets(spark, sf_dir)
    chosen = materialize(p9_mixture(spark, sf_dir), "mixture")
    docs = table(spark, sf_dir, "documents").select("doc_id", _source_key(F.col("source")).alias("own"))
    limits = spark.createDataFrame([(t.source, t.max_repeats) for t in targets], "source string, most int")
    uses = chosen.groupBy("doc_id", "source").agg(F.sum("repeats").alias("k")).join(docs, "doc_id").join(F.broadcast(limits), "source")  # one row per target
    counted = uses.groupBy("source").agg(F.count_if(F.col("k") > F.col("most")).alias("n_over"), F.count_if(F.col("own") != F.col("source")).alias("n_foreign"))
    slack = chosen.agg((0.01 + 2 * F.max("n_tokens") / F.sum(F.col("n_tokens") * F.col("repeats"))).alias("slack"))  # one row
    out = shares(chosen, "source", targets).join(counted, "source", "left").crossJoin(F.broadcast(slack))
    near = F.abs(F.coalesce("actual_share", F.lit(0.0)) - F.col("target_share")) <= F.col("slack")
    return out.select("source", "target_share", F.coalesce("n_over", F.lit(0)).alias("n_over"), F.coalesce("n_foreign", F.lit(0)).alias("n_foreign"), F.coalesce(near, F.lit(False)).alias("is_near"))


# ---------------------------------------------------------------- problem 10
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike_pairs(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its class and the document whose text is the class's form."""
    return lookalike_classes(table(spark, sf_dir, "documents"), "doc_id", "text")[0].drop("_h")


def p10_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p1_found, p1_records, p1_consistent, p2_found, p2_percentiles, p2_estimates, p2_by_month, p7_found, p7_confidence, p8_containers, p8_fill, p8_checks, p9_mixture, p9_shares, p9_checks, p10_found, p10_classes, p10_unified)}

_SOURCE = "CASE regexp_replace(lower({c}), '[^a-z]', '', 'g') WHEN 'googlescholar' THEN 'google_scholar' WHEN '' THEN NULL ELSE regexp_replace(lower({c}), '[^a-z]', '', 'g') END"
_DAY = "CASE WHEN substr(trim({c}), 5, 1) = '-' THEN substr(trim({c}), 1, 10) ELSE substr(trim({c}), 1, 4) || '-' || substr(trim({c}), 5, 2) || '-' || substr(trim({c}), 7, 2) END"
_TIME = "rpad(regexp_replace(CASE WHEN substr(trim({c}), 5, 1) = '-' THEN substr(trim({c}), 11) ELSE substr(trim({c}), 9) END, '[^0-9]', '', 'g'), 9, '0')"
_READINGS = f"""readings AS (
  SELECT snapshot_id, person_id, {_SOURCE.format(c="source")} AS source_even, {_DAY.format(c="collected_at")} AS reading_day, {_TIME.format(c="collected_at")} AS tod,
    {", ".join(f"CASE WHEN {f} >= 0 THEN {f} END AS {f}" for f in (*FIGURES, *FIVE_YEAR))}
  FROM metric_snapshot WHERE collected_at IS NOT NULL),
sized AS (SELECT *, count(*) OVER (PARTITION BY person_id, reading_day) AS n,
  CASE source_even WHEN 'google_scholar' THEN 4 WHEN 'openalex' THEN 3 WHEN 'pop' THEN 2 WHEN 'manual' THEN 1 ELSE 0 END AS trust FROM readings)"""
_PICK = lambda f: f"SELECT person_id, reading_day, '{f}' AS metric_name, snapshot_id, {f} AS figure, source_even, row_number() OVER (PARTITION BY person_id, reading_day ORDER BY trust DESC, tod DESC, snapshot_id DESC) AS rn FROM sized WHERE n > 1 AND {f} IS NOT NULL"
_PICKED = f"WITH {_READINGS}, picked AS (" + " UNION ALL ".join(_PICK(f) for f in FIGURES) + ")"
_LATEST = f"""WITH cur AS (
  SELECT person_id, arg_max(r, affiliation_id) AS rank_name FROM (
    SELECT person_id, affiliation_id, CASE regexp_replace(regexp_replace(lower("rank"), '[^a-z]', '', 'g'), '(professor|prof)$', '')
      WHEN 'assistant' THEN 'assistant' WHEN 'associate' THEN 'associate' WHEN 'full' THEN 'full' WHEN '' THEN 'full' ELSE 'other' END AS r
    FROM affiliation WHERE end_date IS NULL AND is_primary = 1 AND appointment_type = 'regular' AND "rank" IS NOT NULL AND trim("rank") <> '') GROUP BY person_id),
r AS (SELECT snapshot_id, person_id, {_SOURCE.format(c="source")} AS source_name, {_DAY.format(c="collected_at")} AS day, total_citations, h_index FROM metric_snapshot),
l AS (SELECT *, rank() OVER (PARTITION BY person_id, source_name ORDER BY day DESC) AS k FROM r WHERE source_name IS NOT NULL AND day IS NOT NULL),
rows AS (SELECT snapshot_id, source_name, rank_name, 'total_citations' AS metric_name, total_citations AS figure FROM l JOIN cur USING (person_id) WHERE k = 1 AND total_citations >= 0
  UNION ALL SELECT snapshot_id, source_name, rank_name, 'h_index', h_index FROM l JOIN cur USING (person_id) WHERE k = 1 AND h_index >= 0)"""
# What a reader sees of a text, written for itself: not from the operator's tables.
_SHOWN = "regexp_replace(text, '[\\x{AD}\\x{200B}-\\x{200F}\\x{2060}-\\x{2064}\\x{FEFF}\\x{FE00}-\\x{FE0F}\\x00-\\x08\\x0E-\\x1F\\x7F-\\x84\\x86-\\x9F]', '', 'g')"
_SHOWN = f"replace(replace(replace(replace(replace({_SHOWN}, 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬀ', 'ff')"
_WIDE = "array_to_string(list_transform(range(33, 127), lambda i: chr(CAST(i + {shift} AS INTEGER))), '')"
_SHOWN = f"translate(nfc_normalize({_SHOWN}), {_WIDE.format(shift=65248)}, {_WIDE.format(shift=0)})"
_SHOWN = f"regexp_replace({_SHOWN}, '[\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]', ' ', 'g')"
_SHOWN = f"translate({_SHOWN}, '‐‑АаВЕеѕЅІіЈјКМНОоРрСсТХхуёЁїЇѐЀΑΒΕΖΗΙΚΜΝΟΡΤΥΧοόΆΈΊΌΎΪΫ', '--AaBEesSIiJjKMHOoPpCcTXxyëËïÏèÈABEZHIKMNOPTYXoóÁÉÍÓÝÏŸ')"
_SHOWN = f"nfc_normalize({_SHOWN})"
_LOOKS = f"WITH shown AS (SELECT doc_id, text, md5({_SHOWN}) AS look FROM documents WHERE text IS NOT NULL)"
_CLASSES = _LOOKS + """, classed AS (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY look) AS class_id,
  first_value(canon) OVER (PARTITION BY look ORDER BY plain DESC, canon) AS canonical_id FROM (SELECT *, min(doc_id) OVER (PARTITION BY look, text) AS canon, CASE WHEN md5(text) = look THEN 1 ELSE 0 END AS plain FROM shown))"""
ORACLE = {
    # Tokens cannot be counted in SQL; the properties that a packing and a mixture must keep can be stated.
    "p8_checks": """SELECT CAST(spec_id AS BIGINT) AS spec_id, CAST(capacity_tokens AS BIGINT) AS capacity_tokens, (SELECT count(*) FROM documents WHERE text IS NOT NULL) AS n_documents,
  0 AS n_lost, 0 AS n_split_that_fit, 0 AS n_gaps, 0 AS n_overfull, true AS is_tight FROM container_spec WHERE spec_id IS NOT NULL AND capacity_tokens > 0""",
    "p9_checks": "SELECT regexp_replace(lower(trim(source)), '[-\\s]+', '_', 'g') AS source, target_share, 0 AS n_over, 0 AS n_foreign, true AS is_near FROM mix_target WHERE source IS NOT NULL AND target_share > 0 AND max_repeats > 0",
    "p10_found": _LOOKS + " SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM shown a JOIN shown b ON a.look = b.look AND a.doc_id < b.doc_id AND a.text <> b.text",
    "p10_classes": _CLASSES + " SELECT doc_id, class_id, canonical_id FROM classed",
    "p10_unified": _CLASSES
    + """ SELECT d.doc_id, c.class_id, c.canonical_id, k.text IS DISTINCT FROM d.text AS is_changed, k.text
FROM documents d LEFT JOIN classed c USING (doc_id) LEFT JOIN documents k ON k.doc_id = c.canonical_id""",
    "p1_found": _PICKED + " SELECT person_id, reading_day, metric_name, snapshot_id FROM picked WHERE rn = 1",
    "p1_records": _PICKED
    + f""", sure AS (SELECT DISTINCT person_id, reading_day FROM sized WHERE n > 1),
total AS (SELECT s.person_id, s.reading_day, s.source_even, s.tod FROM picked p JOIN sized s USING (snapshot_id) WHERE p.rn = 1 AND p.metric_name = 'total_citations'),
offered AS (SELECT s.*, coalesce(s.source_even = t.source_even AND s.tod <> t.tod, false) AS clashes FROM sized s LEFT JOIN total t ON t.person_id = s.person_id AND t.reading_day = s.reading_day
  WHERE s.n > 1 AND (s.citations_5yr IS NOT NULL OR s.h_index_5yr IS NOT NULL)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY person_id, reading_day ORDER BY trust DESC, tod DESC, snapshot_id DESC) AS k FROM offered),
five AS (SELECT person_id, reading_day, arg_min({{'c': citations_5yr, 'h': h_index_5yr, 's': source_even}}, k) FILTER (NOT clashes) AS v, bool_or(k = 1 AND clashes) AS branched FROM ranked GROUP BY person_id, reading_day)
SELECT s.person_id, s.reading_day, {", ".join(f"max(CASE WHEN metric_name = '{f}' THEN figure END) AS {f}, max(CASE WHEN metric_name = '{f}' THEN p.source_even END) AS {f}_source" for f in FIGURES)},
  any_value(f.v.c) AS citations_5yr, any_value(f.v.h) AS h_index_5yr, any_value(f.v.s) AS five_year_source, coalesce(bool_or(f.branched), false) AS branched
FROM sure s LEFT JOIN picked p ON p.person_id = s.person_id AND p.reading_day = s.reading_day AND p.rn = 1 LEFT JOIN five f ON f.person_id = s.person_id AND f.reading_day = s.reading_day GROUP BY s.person_id, s.reading_day""",
    # Every consistent choice of a group is written out; the best by the order of the operator.
    "p1_consistent": f"""WITH {_READINGS},
k AS (SELECT *, row_number() OVER (PARTITION BY person_id, reading_day ORDER BY trust DESC, tod DESC, snapshot_id DESC) AS place,
  CAST(substr(tod, 1, 2) AS BIGINT) * 3600000 + CAST(substr(tod, 3, 2) AS BIGINT) * 60000 + CAST(substr(tod, 5, 2) AS BIGINT) * 1000 + CAST(substr(tod, 7, 3) AS BIGINT) AS ms FROM sized WHERE n > 1),
g AS (SELECT DISTINCT person_id, reading_day FROM k),
{", ".join(f"o{i} AS (SELECT person_id, reading_day, place, trust, ms, snapshot_id, source_even AS s, h_index AS h, total_citations AS t, {f} AS v FROM k WHERE {f} IS NOT NULL UNION ALL SELECT person_id, reading_day, 1000000, 0, 0, 0, NULL, NULL, NULL, NULL FROM g)" for i, f in enumerate(FIGURES))},
tried AS (SELECT o0.person_id, o0.reading_day, o0.v AS total_citations, o1.v AS h_index, o2.v AS works_count,
  row_number() OVER (PARTITION BY o0.person_id, o0.reading_day ORDER BY CAST(o0.s IS NULL AND o0.v IS NULL AS INT) + CAST(o1.s IS NULL AND o1.v IS NULL AS INT) + CAST(o2.s IS NULL AND o2.v IS NULL AS INT),
    o0.trust + o1.trust + o2.trust DESC, o0.ms + o1.ms + o2.ms DESC, o0.snapshot_id + o1.snapshot_id + o2.snapshot_id DESC, o0.place, o1.place, o2.place) AS r
  FROM o0 JOIN o1 ON o1.person_id = o0.person_id AND o1.reading_day = o0.reading_day JOIN o2 ON o2.person_id = o0.person_id AND o2.reading_day = o0.reading_day
  WHERE NOT coalesce(o0.s = o1.s AND (o0.h <> o1.h OR o0.t <> o1.t), false) AND NOT coalesce(o0.s = o1.s AND o0.t <> o1.t, false)
    AND NOT coalesce(o0.s = o2.s AND o0.h <> o2.h, false) AND NOT coalesce(o0.s = o2.s AND o0.t <> o2.t, false)
    AND NOT coalesce(o1.s = o2.s AND o1.h <> o2.h, false) AND NOT coalesce(o1.s = o2.s AND o1.t <> o2.t, false) AND NOT coalesce(o0.s = o1.s AND o0.h <> o1.h, false))
SELECT person_id, reading_day, total_citations, h_index, works_count FROM tried WHERE r = 1""",
    "p2_percentiles": _LATEST
    + f""", ord AS (SELECT metric_name, source_name, rank_name, figure, row_number() OVER (PARTITION BY metric_name, source_name, rank_name ORDER BY figure) AS i, count(*) OVER (PARTITION BY metric_name, source_name, rank_name) AS n FROM rows),
q AS (SELECT CAST(unnest([{", ".join(map(str, QUANTILES))}]) AS DOUBLE) AS quantile)
SELECT metric_name, source_name, rank_name, quantile, n, figure AS percentile, true AS within_bound FROM ord, q WHERE i = greatest(1, CAST(ceil(quantile * n) AS BIGINT))""",
    "p2_found": _LATEST
    + """, m AS (SELECT metric_name, source_name, rank_name, median(figure) AS med FROM rows GROUP BY ALL)
SELECT metric_name, snapshot_id FROM rows JOIN m USING (metric_name, source_name, rank_name) WHERE figure > 25 * med""",
}

"""Queries of the general problems 3 to 6 over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.text import day_text, figure, flexible_date, rank_name
from tallymark.operators.history import attribute_history
from tallymark.operators.intervals import periods_and_gaps
from tallymark.operators.shred import ChildTable, Node, reconstruct, shred
from tallymark.operators.snapshot_diff import snapshot_changes
from tallymark.session import table

PAYLOAD = (
    Node("interests", repeated=True),
    Node("cites_per_year", repeated=True, keyed=True, children=(Node("year"), Node("n"))),
    Node("counts_by_year", repeated=True, keyed=True, children=(Node("year"), Node("cited_by_count"))),
    Node("last_known_institutions", repeated=True, children=(Node("id"), Node("display_name"), Node("lineage", repeated=True))),
    Node("records", repeated=True, children=(Node("id"), Node("cited_by_count"))),
)
CHILDREN = (
    ChildTable("interest", "interests[]"),
    ChildTable("year", "cites_per_year[]/year", "cites_per_year[]/n"),
    ChildTable("year", "cites_per_year{}/key", "cites_per_year{}/value"),
    ChildTable("year", "counts_by_year[]/year", "counts_by_year[]/cited_by_count"),
    ChildTable("year", "counts_by_year{}/key", "counts_by_year{}/value"),
    ChildTable("institution", "last_known_institutions[]/id", "last_known_institutions[]/display_name"),
    ChildTable("lineage", "last_known_institutions[]/lineage[]"),
    ChildTable("record", "records[]/id", "records[]/cited_by_count"),
)


def payload_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    deliveries = table(spark, sf_dir, "snapshot_delivery")
    return reconstruct(shred(deliveries, "delivery_row_id", "raw_json", PAYLOAD), "delivery_row_id", PAYLOAD, CHILDREN)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_children(spark, sf_dir).drop("child_value", "payload_no")


def p3_child_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children with the figure or name that stands beside their key."""
    return payload_children(spark, sf_dir).where(F.col("child_value").isNotNull()).drop("payload_no")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "affiliation")
    until = F.when(F.col("end_date").isNull(), F.to_date(F.lit("9999-12-31"))).otherwise(flexible_date(F.col("end_date")))
    spans = periods_and_gaps(rows, "person_id", flexible_date(F.col("start_date")), until)
    return spans.select("person_id", "span_kind", day_text(F.col("first_day")).alias("first_day"), day_text(F.col("until_day")).alias("until_day"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "roster_extract").select(
        "person_id", "extracted_on", "department_id", rank_name(F.col("rank")).alias("rank_name"), flexible_date(F.col("start_date")).alias("starts"), "loaded_at", "extract_id"
    )
    out = attribute_history(rows, "person_id", "extracted_on", {"department_id": "bigint", "rank_name": "string"}, ["loaded_at", "extract_id"], "starts")
    return out.select("person_id", "department_id", "rank_name", day_text(F.col("valid_from")).alias("valid_from"), day_text(F.col("valid_to")).alias("valid_to"))


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "snapshot_delivery")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = snapshot_changes(_deliveries(spark, sf_dir), "source", "delivered_on", "person_id", {"total_citations": figure(F.col("total_citations"))}, ["collected_at", "delivery_row_id"])
    return out.select("source", day_text(F.col("delivered_on")).alias("delivered_on"), "person_id", "delta_kind")


def p6_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes in any figure, with the names of the fields that changed."""
    names = ("total_citations", "h_index", "works_count")
    fields = {c: figure(F.col(c).cast("string")) for c in names}
    out = snapshot_changes(_deliveries(spark, sf_dir), "source", "delivered_on", "person_id", fields, ["collected_at", "delivery_row_id"])
    return out.select("source", day_text(F.col("delivered_on")).alias("delivered_on"), "person_id", "delta_kind", F.concat_ws(",", "changed_fields").alias("changed_fields"))


QUERIES = {f.__name__: f for f in (p3_found, p3_child_values, p4_found, p5_found, p6_found, p6_fields)}

_FLEX = "try_cast(CASE length(trim({c})) WHEN 4 THEN trim({c}) || '-01-01' WHEN 7 THEN trim({c}) || '-01' ELSE substr(trim({c}), 1, 10) END AS DATE)"
_RANK = """CASE WHEN {c} IS NULL OR trim({c}) = '' THEN NULL
  ELSE CASE regexp_replace(regexp_replace(lower({c}), '[^a-z]', '', 'g'), '(professor|prof)$', '')
    WHEN 'assistant' THEN 'assistant' WHEN 'associate' THEN 'associate' WHEN 'full' THEN 'full' WHEN '' THEN 'full' ELSE 'other' END END"""
_NUM = "try_cast(replace(trim({c}), ',', '') AS DECIMAL(38,6))"


def _diff_sql(fields: dict[str, str], with_names: bool) -> str:
    """Full outer join of each delivery with the one before: another way than signed cells."""
    nums = ", ".join(f"{e} AS {n}" for n, e in fields.items())
    differ = " OR ".join(f"b.{n} IS DISTINCT FROM a.{n}" for n in fields)
    names = "array_to_string(list_sort(list_filter([" + ", ".join(f"CASE WHEN b.{n} IS DISTINCT FROM a.{n} THEN '{n}' END" for n in fields) + "], lambda x: x IS NOT NULL)), ',')"
    extra = f", CASE WHEN a.person_id IS NOT NULL AND b.person_id IS NOT NULL THEN {names} ELSE '' END AS changed_fields" if with_names else ""
    return f"""
WITH best AS (
  SELECT source, delivered_on, person_id, {nums} FROM (
    SELECT *, row_number() OVER (PARTITION BY source, delivered_on, person_id ORDER BY collected_at DESC NULLS LAST, delivery_row_id DESC) AS rn FROM snapshot_delivery) WHERE rn = 1),
cal AS (SELECT source, delivered_on, lag(delivered_on) OVER (PARTITION BY source ORDER BY delivered_on) AS prev
  FROM (SELECT DISTINCT source, delivered_on FROM snapshot_delivery)),
later AS (SELECT best.* FROM best JOIN cal USING (source, delivered_on) WHERE prev IS NOT NULL),
earlier AS (SELECT cal.source, cal.delivered_on, best.person_id, {", ".join("best." + n for n in fields)}
  FROM cal JOIN best ON best.source = cal.source AND best.delivered_on = cal.prev)
SELECT coalesce(b.source, a.source) AS source, strftime(coalesce(b.delivered_on, a.delivered_on), '%Y-%m-%d') AS delivered_on,
  coalesce(b.person_id, a.person_id) AS person_id,
  CASE WHEN a.person_id IS NULL THEN 'added' WHEN b.person_id IS NULL THEN 'removed' ELSE 'changed' END AS delta_kind{extra}
FROM later b FULL JOIN earlier a ON a.source = b.source AND a.delivered_on = b.delivered_on AND a.person_id = b.person_id
WHERE a.person_id IS NULL OR b.person_id IS NULL OR {differ}"""


ORACLE = {
    "p3_found": """
WITH raw AS (SELECT delivery_row_id, CAST(raw_json AS JSON) AS j FROM snapshot_delivery WHERE json_valid(raw_json)),
s1 AS (SELECT delivery_row_id, CASE WHEN json_type(j) = 'VARCHAR' AND json_valid(j ->> '$') THEN CAST(j ->> '$' AS JSON) ELSE j END AS j FROM raw),
p AS (SELECT delivery_row_id, CASE WHEN json_type(j, '$.payload') = 'OBJECT' THEN json_extract(j, '$.payload') WHEN json_type(j, '$.payload') = 'VARCHAR' AND json_valid(j ->> '$.payload') THEN CAST(j ->> '$.payload' AS JSON) ELSE j END AS j FROM s1),
fields AS (
  SELECT delivery_row_id, kind, v FROM p, LATERAL (VALUES ('interest', json_extract(j, '$.interests')), ('year', json_extract(j, '$.cites_per_year')), ('year', json_extract(j, '$.counts_by_year')),
    ('institution', json_extract(j, '$.last_known_institutions')), ('record', json_extract(j, '$.records'))) f(kind, v) WHERE v IS NOT NULL AND json_type(v) <> 'NULL'),
entries AS (
  SELECT delivery_row_id, kind, CAST(i AS BIGINT) - 1 AS pos, l[i] AS e FROM (SELECT delivery_row_id, kind, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT delivery_row_id, kind, json_extract(v, '$[*]') AS l FROM fields WHERE json_type(v) = 'ARRAY'))
  UNION ALL SELECT delivery_row_id, kind, 0, v FROM fields WHERE json_type(v) <> 'ARRAY' AND NOT (kind = 'year' AND json_type(v) = 'OBJECT')),
good AS (SELECT * FROM entries WHERE json_type(e) <> 'NULL'),
lines AS (SELECT delivery_row_id, pos, json_extract(e, '$.lineage') AS v FROM good WHERE kind = 'institution')
SELECT delivery_row_id, kind AS child_kind, pos AS outer_pos, CAST(-1 AS BIGINT) AS inner_pos, CASE kind WHEN 'interest' THEN e ->> '$' WHEN 'year' THEN e ->> '$.year' ELSE e ->> '$.id' END AS child_key FROM good
UNION ALL SELECT delivery_row_id, 'year', -1, -1, unnest(json_keys(v)) FROM fields WHERE kind = 'year' AND json_type(v) = 'OBJECT'
UNION ALL SELECT delivery_row_id, 'lineage', pos, CAST(i AS BIGINT) - 1, l[i] ->> '$' FROM (SELECT delivery_row_id, pos, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT delivery_row_id, pos, CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') ELSE [v] END AS l FROM lines WHERE v IS NOT NULL AND json_type(v) <> 'NULL')) WHERE json_type(l[i]) <> 'NULL'""",
    "p4_found": f"""
WITH iv AS (
  SELECT person_id, {_FLEX.format(c='start_date')} AS a, CASE WHEN end_date IS NULL THEN DATE '9999-12-31' ELSE {_FLEX.format(c='end_date')} END AS b FROM affiliation),
ok AS (SELECT * FROM iv WHERE a IS NOT NULL AND b > a),
marked AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY person_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM ok),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY person_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS n FROM marked),
periods AS (SELECT person_id, min(a) AS a, max(b) AS b FROM numbered GROUP BY person_id, n),
gaps AS (SELECT person_id, b AS a, lead(a) OVER (PARTITION BY person_id ORDER BY a) AS b FROM periods)
SELECT person_id, 'period' AS span_kind, strftime(a, '%Y-%m-%d') AS first_day, strftime(b, '%Y-%m-%d') AS until_day FROM periods
UNION ALL SELECT person_id, 'gap', strftime(a, '%Y-%m-%d'), strftime(b, '%Y-%m-%d') FROM gaps WHERE b IS NOT NULL""",
    "p5_found": f"""
WITH counted AS (
  SELECT person_id, extracted_on, department_id AS d, {_RANK.format(c='"rank"')} AS r, try_cast(start_date AS DATE) AS s FROM (
    SELECT *, row_number() OVER (PARTITION BY person_id, extracted_on ORDER BY loaded_at DESC NULLS LAST, extract_id DESC) AS rn FROM roster_extract) WHERE rn = 1),
filled AS (
  SELECT person_id, extracted_on, s, last_value(d IGNORE NULLS) OVER w AS d, last_value(r IGNORE NULLS) OVER w AS r FROM counted
  WINDOW w AS (PARTITION BY person_id ORDER BY extracted_on ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
marked AS (
  SELECT *, CASE WHEN row_number() OVER w = 1 OR d IS DISTINCT FROM lag(d) OVER w OR r IS DISTINCT FROM lag(r) OVER w THEN 1 ELSE 0 END AS fresh FROM filled
  WINDOW w AS (PARTITION BY person_id ORDER BY extracted_on)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY person_id ORDER BY extracted_on) AS n FROM marked),
versions AS (SELECT person_id, n, any_value(d) AS d, any_value(r) AS r, least(min(extracted_on), coalesce(min(s), min(extracted_on))) AS f FROM numbered GROUP BY person_id, n)
SELECT person_id, d AS department_id, r AS rank_name, strftime(f, '%Y-%m-%d') AS valid_from,
  strftime(coalesce(lead(f) OVER (PARTITION BY person_id ORDER BY n), DATE '9999-12-31'), '%Y-%m-%d') AS valid_to FROM versions""",
    "p6_found": _diff_sql({"total_citations": _NUM.format(c="total_citations")}, False),
    "p6_fields": _diff_sql({c: _NUM.format(c=f"CAST({c} AS VARCHAR)") for c in ("total_citations", "h_index", "works_count")}, True),
}
# The same entries with what stands beside their key.
ORACLE["p3_child_values"] = (
    ORACLE["p3_found"].partition("lines AS (")[0].rstrip().removesuffix(",")
    + """, valued AS (SELECT delivery_row_id, kind AS child_kind, pos AS outer_pos, CAST(-1 AS BIGINT) AS inner_pos, CASE kind WHEN 'year' THEN e ->> '$.year' ELSE e ->> '$.id' END AS child_key,
  CASE kind WHEN 'year' THEN coalesce(e ->> '$.n', e ->> '$.cited_by_count') WHEN 'institution' THEN e ->> '$.display_name' WHEN 'record' THEN e ->> '$.cited_by_count' END AS child_value FROM good WHERE kind IN ('year', 'institution', 'record')
  UNION ALL SELECT delivery_row_id, 'year', -1, -1, k, json_extract_string(v, '$."' || k || '"') FROM (SELECT delivery_row_id, v, unnest(json_keys(v)) AS k FROM fields WHERE kind = 'year' AND json_type(v) = 'OBJECT'))
SELECT * FROM valued WHERE child_value IS NOT NULL"""
)

"""Queries of text extraction and of the streaming tier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import extract as X
from tallymark.operators import metrics as M
from tallymark.plans.base_sql import BASE
from tallymark.session import table
from tallymark.sources.standard import appointments
from tallymark.streaming import follow as S

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


def _lines(spark, d):
    """Lines of all documents, their sentences on lines of their own."""
    text = X.text_of(F.regexp_replace("text", "[.] ", ".\n"))
    return X.page_lines(table(spark, d, "documents").select("doc_id", text.alias("text")), "doc_id", F.col("text"))


_LINES = """, parts AS (SELECT doc_id, list_filter(list_transform(string_split(replace(text, '. ', '.' || chr(10)), chr(10)), lambda x: trim(regexp_replace(x, '[ \\t\\x{A0}]+', ' ', 'g'), ' ')), lambda x: x <> '') AS l FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, i - 1 AS line_no, l[i] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM parts))"""


@query(f"{_LINES} SELECT doc_id, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM lines GROUP BY doc_id")
def page_text_lines(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


_Q = lambda words: ", ".join(f"'{w}'" for w in words)
_PART = "regexp_extract(line, '^([^,:;|]+?)(?: -|[,:;|])', 1)"
_NAMED = f"""trim(regexp_replace(regexp_replace(trim(regexp_replace({_PART}, '\\([^)]*\\)', ' ', 'g')), '^(?i:dr|prof|professor|mrs?|ms|mx)\\.?\\s+', ''), '(?:\\s+(?:\\p{{Lu}}{{2,6}}|Ph\\.?\\s?D\\.?|[JS]r\\.?))+\\s*$', ''))"""


@query(f"""{_LINES}, c AS (SELECT doc_id, line_no, {_NAMED} AS name FROM lines), w AS (SELECT *, string_split_regex(name, '\\s+') AS ws, string_split_regex(strip_accents(lower(replace(replace(replace(replace(name, 'Ø', 'O'), 'ø', 'o'), 'Ł', 'L'), 'ł', 'l'))), '[^a-z]+') AS bare FROM c)
SELECT doc_id, line_no, name FROM w WHERE len(ws) BETWEEN 2 AND 4 AND len(list_filter(ws, lambda x: NOT regexp_matches(x, '^\\p{{Lu}}[\\p{{L}}.’''-]*$'))) = 0 AND regexp_matches(ws[-1], '\\p{{L}}{{2}}')
  AND name <> upper(name) AND NOT list_has_any(bare, [{_Q(X.NOT_NAMES)}])""")
def page_name_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the documents that begin with a name and a mark."""
    name = X.name_on(F.regexp_extract("line", "^([^,:;|]+?)(?: -|[,:;|])", 1))
    return _lines(spark, d).select("doc_id", "line_no", name.alias("name")).where("name is not null")


@query(f"""{_LINES}, w AS (SELECT doc_id, line_no, line, list_transform(list_filter(string_split_regex(lower(line), '[^\\p{{L}}]+'), lambda x: x <> ''), lambda x: CASE x WHEN 'prof' THEN 'professor' WHEN 'assoc' THEN 'associate' WHEN 'asst' THEN 'assistant' WHEN 'assist' THEN 'assistant' ELSE x END) AS ws FROM lines),
t AS (SELECT *, coalesce(list_position(ws, 'professor'), 0) AS p, list_filter(ws, lambda x: x IN ({_Q(X.TITLE_WORDS)}))[1] AS opens FROM w WHERE list_has_any(ws, [{_Q(X.TITLE_WORDS)}])),
b AS (SELECT *, CASE WHEN p > 1 THEN ws[p - 1] END AS before, CASE WHEN p > 1 THEN ws[1:p - 1] ELSE [] END AS ahead, ' ' || array_to_string(ws, ' ') || ' ' AS txt FROM t)
SELECT doc_id, line_no, CASE WHEN p = 0 OR opens <> 'professor' OR list_has_any(ws, [{_Q(X.OFF_LADDER)}]) OR coalesce(before IN ('research', 'teaching'), false) OR regexp_matches(txt, ' (in residence|part time|of teaching|teaching stream|research stream) ') THEN NULL
  WHEN before IN ('assistant', 'associate', 'full') THEN before
  WHEN list_has_any(ahead, [{_Q(X.CHAIR_MARKS)}]) OR regexp_matches(line, '^(?:.*\\s)?\\p{{Lu}}[\\p{{L}}\\p{{N}}.’''-]*\\s+(?i:professor|prof\\b)') THEN NULL ELSE 'full' END AS rank_name FROM b""")
def page_title_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the documents with a title and the rank that it tells."""
    return _lines(spark, d).where(X.is_title(F.col("line"))).select("doc_id", "line_no", X.title_rank(F.col("line")).alias("rank_name"))


@query()
def page_titles(spark: SparkSession, d: str) -> DataFrame:
    """Names with ranked titles in all documents ('doc-' and their id) and in listings of up to 200 people: each person's line, then the rank of the appointment."""
    people = table(spark, d, "person").select("person_id", "display_name")
    ranks = table(spark, d, "affiliation").where("end_date is null and is_primary = 1").select("person_id", "department_id", "rank")
    title = F.concat(F.initcap(F.regexp_replace(F.trim("rank"), "(?i)\\s*professor\\s*", "")), F.lit(" Professor"))
    listing = ranks.join(people, "person_id").where("department_id is not null and rank is not null")
    page = F.concat_ws("-", F.col("department_id").cast("string"), F.expr("person_id div 200").cast("string"))
    listing = listing.select(page.alias("page_id"), F.concat_ws("\n", F.trim("display_name"), title).alias("entry"))
    pages = listing.distinct().groupBy("page_id").agg(F.concat_ws("\n", F.sort_array(F.collect_list("entry"))).alias("text"))
    docs = table(spark, d, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("page_id"), "text")
    pages = pages.unionByName(docs)
    return X.names_with_titles(X.page_lines(pages, "page_id", F.col("text")), "page_id")


@query()
def page_scan(spark: SparkSession, d: str) -> DataFrame:
    """Listings of up to 200 people of a department, read against those of them on file one rank lower or missing: ranks that agree, promotions, and names not on the roster."""
    who = table(spark, d, "person").select("person_id", "first_name", "last_name")
    posts = _current(spark, d).join(who, "person_id").select(F.concat_ws("-", "department_id", F.expr("person_id div 200")).alias("page_id"), "person_id", "first_name", "last_name", "rank_name").dropDuplicates(["page_id", "person_id"])
    entry = F.concat_ws("\n", F.concat_ws(" ", "first_name", "last_name"), F.concat(F.initcap("rank_name"), F.lit(" Professor")))
    pages = posts.groupBy("page_id").agg(F.concat_ws("\n", F.sort_array(F.collect_list(entry))).alias("text"))
    lines = X.page_lines(pages, "page_id", F.col("text"))
    lower = F.when((F.col("person_id") % 7 == 0) & (F.col("rank_name") == "full"), "associate").otherwise(F.col("rank_name"))
    roster = posts.where("person_id % 11 <> 0").withColumn("rank_name", lower)
    return X.scan_pages(lines, "page_id", roster, who)


@query("SELECT doc_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host FROM documents WHERE url IS NOT NULL")
def page_hosts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("url is not null").select("doc_id", F.lower(F.try_parse_url("url", F.lit("HOST"))).alias("host"))


def _line_links(text):
    """A link for each line or sentence of a text, in eight kinds: of the own host or another, whole or relative, repeated, quoted and spelt either way, or no link to a page."""
    n = F.size(F.split(F.coalesce(text, F.lit("")), "\n|[.] "))
    own = F.regexp_extract("url", "^(?i)(https?://[^/?#]+)", 1)

    def link(i):
        kinds = [('<a href="/line/', '">'), ("<A class='x' HREF='/line/", "'>"), ('<a href="https://elsewhere.example/', '">'), ('<a href="#', '">'), ('<a href="mailto:x', '@u.example">')]
        texts = [F.concat(F.lit(head), i.cast("string"), F.lit(tail)) for head, tail in kinds]
        texts.append(F.concat(F.lit('<a href="/line/'), (i - 5).cast("string"), F.lit('#part">')))
        texts.append(F.concat(F.lit('<a href="'), own, F.lit("/whole/"), i.cast("string"), F.lit('">')))
        texts.append(F.concat(F.lit('<a href="/line/'), (i - 7).cast("string"), F.lit('">')))
        return F.concat(F.get(F.array(*texts), i % len(texts)), F.lit("x</a>\n"))

    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), link), "")


@query()
def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of pages made from the documents' urls and the lines and sentences of their texts, kept to the page's own host."""
    docs = table(spark, d, "documents").where("url is not null").select("doc_id", "url", "text")
    html = F.concat(F.lit('<a href="'), F.col("url"), F.lit('">x</a><a href="/people">y</a><a href="https://elsewhere.example/">z</a><a href="/people">y</a>'), _line_links(F.col("text")))
    return X.page_links(docs.select("doc_id", "url", html.alias("html")), "doc_id", "url", "html")


def _stream(spark, d):
    schema = table(spark, d, "metric_snapshot").schema
    return S.reading_stream(spark, f"{d}/metric_snapshot.parque[t]", schema)  # a pattern, for the table may be a file or a folder


@query("SELECT person_id, source, moment, snapshot_id, total_citations FROM (SELECT *, row_number() OVER (PARTITION BY person_id, source ORDER BY moment DESC, snapshot_id DESC) AS n FROM rd WHERE source IS NOT NULL AND moment IS NOT NULL) WHERE n = 1")
def stream_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return S.run_to_end(S.latest_per_key(_stream(spark, d)), "latest", ["person_id", "source"])


@query("SELECT strftime(date_trunc('week', CAST(day AS DATE)), '%Y-%m-%d') AS week_start, source, count(*) AS n FROM rd WHERE source IS NOT NULL AND day IS NOT NULL GROUP BY 1, 2")
def stream_weekly_counts(spark: SparkSession, d: str) -> DataFrame:
    return S.run_to_end(S.weekly_counts(_stream(spark, d)), "weekly", ["week_start", "source"])


@query("SELECT person_id, source, count(DISTINCT moment) AS n FROM rd WHERE day IS NOT NULL GROUP BY person_id, source")
def stream_once_per_key(spark: SparkSession, d: str) -> DataFrame:
    once = S.run_to_end(S.once_per_key(_stream(spark, d)), "once")
    return once.groupBy("person_id", "source").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT person_id, moment, previous, total_citations FROM (SELECT person_id, moment, total_citations, lag(total_citations) OVER (PARTITION BY person_id ORDER BY moment, snapshot_id) AS previous FROM rd WHERE total_citations IS NOT NULL AND moment IS NOT NULL)
WHERE previous > 0 AND total_citations <> 0 AND (previous - total_citations) / previous > 0.2e0""")
def stream_previous_drops(spark: SparkSession, d: str) -> DataFrame:
    return S.previous_reading_drops(_stream(spark, d))


_SKIPPED = "coalesce(trigger, '') ILIKE '%manual%'"


@query(f"""SELECT stream, reported, outcome, queued, last_searched, stalled_since, batches FROM (
  WITH told AS (SELECT source AS stream, started_at AS t, run_id, coalesce(n_succeeded, 0) AS searched, n_attempted AS waiting, coalesce(n_failed, 0) AS empty,
    CASE WHEN {_SKIPPED} THEN 'skipped' WHEN coalesce(n_succeeded, 0) > 0 THEN 'searched' WHEN n_attempted = 0 THEN 'idle' WHEN contains(coalesce(notes, ''), 'quota') THEN 'blocked' ELSE 'failed' END AS outcome FROM collection_run WHERE source IS NOT NULL AND started_at IS NOT NULL)
  SELECT stream, strftime(max(t), '%Y-%m-%d') AS reported, arg_max(outcome, t) AS outcome, (arg_max(waiting - searched, t) FILTER (outcome <> 'skipped' AND waiting IS NOT NULL)) AS queued, CAST(max(CAST(t AS DATE)) FILTER (outcome = 'searched') AS VARCHAR) AS last_searched,
    CAST((SELECT min(CAST(b.t AS DATE)) FROM told b WHERE b.stream = told.stream AND b.outcome IN ('blocked', 'failed') AND b.t > coalesce((SELECT max(c.t) FROM told c WHERE c.stream = told.stream AND c.outcome IN ('searched', 'idle')), TIMESTAMP '0001-01-01')) AS VARCHAR) AS stalled_since,
    coalesce((SELECT string_agg(strftime(q.t, '%Y-%m-%d') || ':' || q.searched || ':' || q.empty || ':0', ';' ORDER BY q.t) FROM (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY t DESC) AS i FROM told WHERE outcome = 'searched') q WHERE q.i <= 10 AND q.stream = told.stream), '') AS batches
  FROM told GROUP BY stream)""")
def run_status_fold(spark: SparkSession, d: str) -> DataFrame:
    """The status of each source's runs, folded in time order: a run made by hand counts as skipped, failures as empty searches."""
    runs = table(spark, d, "collection_run").where("source is not null and started_at is not null").select(
        F.col("source").alias("stream"), F.col("started_at").alias("at"), F.col("n_succeeded").alias("searched"), F.col("n_attempted").alias("waiting"), F.coalesce("n_failed", F.lit(0)).alias("empty"), F.lit(0).alias("found"),
        F.coalesce("notes", F.lit("")).contains("quota").alias("is_blocked"), F.lower(F.coalesce("trigger", F.lit(""))).contains("manual").alias("is_skipped"),
    )
    out = S.fold_status(runs)
    return out.select("stream", F.date_format("reported", "yyyy-MM-dd").alias("reported"), "outcome", "queued", F.col("last_searched").cast("string").alias("last_searched"), F.col("stalled_since").cast("string").alias("stalled_since"), "batches")

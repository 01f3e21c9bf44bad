"""Landed service responses and review entries as tables: profiles, authors, doctorates, identifiers, run records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.session import small_side

PROFILE = (
    "struct<search_parameters: struct<author_id: string>, author: struct<name: string, affiliations: string, email: string, website: string, interests: array<struct<title: string>>>, "
    "cited_by: struct<table: array<struct<citations: map<string, bigint>, h_index: map<string, bigint>, i10_index: map<string, bigint>>>, graph: array<struct<year: bigint, citations: bigint>>>>"
)
SEARCH = "struct<organic_results: array<struct<publication_info: struct<authors: array<struct<author_id: string, name: string>>>>>>"
EDUCATION = (
    "struct<`affiliation-group`: array<struct<summaries: array<struct<`education-summary`: struct<`role-title`: string, `department-name`: string, "
    "organization: struct<name: string>, `end-date`: struct<year: struct<value: string>>>>>>>>"
)
#: Words of a title that make it a doctorate, as they read once dots are gone.
DOCTORAL_WORDS = ("phd", "dphil", "doctor", "doctoral", "doctorate", "scd", "dsc", "drphil")
# Fixed value: how an identifier is written.
ORCID = r"(?i)(\d{4}-\d{4}-\d{4}-\d{3}[\dX])"


def cell(c: Column) -> Column:
    """A spreadsheet cell: outer spaces go, blanks and error marks are null."""
    t = F.trim(c)
    return F.when((t != "") & ~t.startswith("#"), t)


def profiles(landed: DataFrame, requested: str, body: str) -> DataFrame:
    """Landed profile responses in canonical form, one row each; is_gone marks an empty profile, whose id no longer resolves."""
    r = landed.select(F.col(requested).alias("_q"), F.from_json(body, PROFILE).alias("r"))
    stat = lambda k, of: F.get(F.filter(F.transform("r.cited_by.table", lambda e: of(e[k])), lambda v: v.isNotNull()), 0)
    whole = lambda m: m["all"]
    recent = lambda m: F.get(F.map_values(F.map_filter(m, lambda k, _: k.startswith("since"))), 0)
    email = F.regexp_extract("r.author.email", r" at (.+)$", 1)
    years = F.filter("r.cited_by.graph", lambda g: g["year"].isNotNull())
    return r.select(
        F.coalesce("r.search_parameters.author_id", "_q").alias("scholar_id"),
        F.col("r.author.name").alias("name"),
        F.col("r.author.affiliations").alias("affiliation"),
        F.when(email != "", F.concat(F.lit("@"), F.trim(email))).alias("email_domain"),
        F.transform("r.author.interests", lambda i: i["title"]).alias("interests"),
        F.col("r.author.website").alias("homepage"),
        *[stat(k, of).alias(n) for n, k, of in (("citedby", "citations", whole), ("citedby5y", "citations", recent), ("hindex", "h_index", whole), ("hindex5y", "h_index", recent), ("i10index", "i10_index", whole), ("i10index5y", "i10_index", recent))],
        F.map_from_entries(F.transform(years, lambda g: F.struct(g["year"].cast("string"), F.coalesce(g["citations"], F.lit(0))))).alias("cites_per_year"),
        (F.coalesce("r.author.name", F.lit("")).eqNullSafe("") & (F.coalesce(F.size("r.cited_by.table"), F.lit(0)) <= 0)).alias("is_gone"),
    )


def linked_authors(landed: DataFrame, query_id: str, body: str) -> DataFrame:
    """(query_id, author_id, name): each linked author of a search response with the first name given for it."""
    items = landed.select(query_id, F.posexplode(F.from_json(body, SEARCH)["organic_results"]).alias("_i", "_item"))
    authors = items.select(query_id, "_i", F.posexplode("_item.publication_info.authors").alias("_j", "_a")).where("_a.author_id <> '' and _a.name <> ''")
    return authors.groupBy(query_id, F.col("_a.author_id").alias("author_id")).agg(F.min_by(F.trim("_a.name"), F.struct("_i", "_j")).alias("name"))


def profile_links(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """(page_id, author_id, name) of profile links on pages that answer a search; other pages say nothing and give nothing."""
    answers = F.col(url).rlike(r"^https?://[^/]+/scholar(?:\?|$)") & F.col(html).rlike(r'id="gs_res_ccl|class="gs_ri"|did not match any articles')
    link = r'<a href="/citations\?user=([\w-]{12})[^"]*"[^>]*>([^<]+)</a>'
    found = pages.where(answers).select(page_id, F.posexplode(F.regexp_extract_all(html, F.lit(link), 0)).alias("_o", "_l"))
    each = found.select(page_id, "_o", F.regexp_extract("_l", link, 1).alias("author_id"), F.trim(F.regexp_extract("_l", link, 2)).alias("name"))
    return each.groupBy(page_id, "author_id").agg(F.min_by("name", "_o").alias("name"))


def doctorates(landed: DataFrame, person: str, body: str) -> DataFrame:
    """(person, year, organization, department) of the latest doctoral entry with a title, an end year and an organization."""
    groups = landed.select(person, F.explode(F.from_json(body, EDUCATION)["affiliation-group"]).alias("_g"))
    entry = groups.select(person, F.explode("_g.summaries").alias("_s")).select(person, F.col("_s.education-summary").alias("e"))
    year, org = F.col("e.end-date.year.value"), F.col("e.organization.name")
    # 'Ph. D.' and 'Dr. phil.' read as one word each.
    said = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower("e.role-title"), r"\.", " "), r"\b(ph|sc|d)\s+d\b", "$1d"), r"\bdr?\s+phil\b", "dphil")
    doctoral = F.arrays_overlap(F.split(said, "[^a-z]+"), F.array(*[F.lit(w) for w in DOCTORAL_WORDS]))
    fit = entry.where(doctoral & (year != "") & (org != ""))
    best = fit.groupBy(person).agg(F.max(F.struct(year.alias("year"), org.alias("organization"), F.coalesce(F.col("e.department-name"), F.lit("")).alias("department"))).alias("b"))
    return best.select(person, "b.*")


def parse_orcid(c: Column) -> Column:
    found = F.upper(F.regexp_extract(c, ORCID, 1))
    return F.when(found != "", found)


def since_date(c: Column, fallback: Column) -> Column:
    """A year means its first day, a date passes, a blank takes the fallback."""
    t = F.trim(c)
    return F.when(F.coalesce(t, F.lit("")) == "", fallback).when(t.rlike(r"^\d{4}$"), F.concat(t, F.lit("-01-01")).try_cast("date")).otherwise(F.substring(t, 1, 10).try_cast("date"))


def apply_orcids(people: DataFrame, decisions: DataFrame) -> DataFrame:
    """(person_id, orcid, outcome) of identifiers read by a reviewer: 'confirmed', 'filled', 'replaced' or 'kept'.

    decisions: person_id, orcid (any written form), decided_at. The latest decision of a person counts.
    """
    d = decisions.select("person_id", parse_orcid(F.col("orcid")).alias("_o"), "decided_at").where("_o is not null")
    d = d.groupBy("person_id").agg(F.max_by("_o", F.struct("decided_at", "_o")).alias("_o"))
    had = F.upper(F.trim("orcid"))
    j = people.select("person_id", "orcid").join(d, "person_id", "left")
    outcome = F.when(F.col("_o").isNull(), "kept").when(had == F.col("_o"), "confirmed").when(F.coalesce(had, F.lit("")) == "", "filled").otherwise("replaced")
    return j.select("person_id", F.coalesce("_o", "orcid").alias("orcid"), outcome.alias("outcome"))


def upsert_matches(queue: DataFrame, found: DataFrame) -> DataFrame:
    """Queue rows (person_id, external_id, status, reviewed_by) after records found by identifier are accepted.

    A record a person rejected stays rejected; a found record that is not in the queue is added.
    """
    f = found.select("person_id", "external_id").distinct().withColumn("_f", F.lit(True))
    j = queue.select("person_id", "external_id", "status", "reviewed_by").join(f, ["person_id", "external_id"], "full")
    by_person = F.coalesce("reviewed_by", F.lit("")).rlike("^reviewer")
    take = F.col("_f").isNotNull() & ~F.coalesce((F.col("status") == "accepted") | ((F.col("status") == "rejected") & by_person), F.lit(False))
    return j.select("person_id", "external_id", F.when(take, "accepted").otherwise(F.col("status")).alias("status"), F.when(take, "orcid").otherwise(F.col("reviewed_by")).alias("reviewed_by"))


def sole_accepted(people: DataFrame, queue: DataFrame, id_column: str) -> DataFrame:
    """(person_id, id_column): the accepted record of people without an identifier who have exactly one."""
    one = queue.where("status = 'accepted' and external_id is not null").groupBy("person_id").agg(F.count(F.lit(1)).alias("_n"), F.min("external_id").alias("_e")).where("_n = 1")
    j = people.select("person_id", id_column).join(one.select("person_id", "_e"), "person_id", "left")
    return j.select("person_id", F.coalesce(id_column, "_e").alias(id_column))


def reconcile_with_works(records: DataFrame, works: DataFrame, ratio: float = 1.25, least: int = 5, complete: float = 0.9) -> DataFrame:
    """Records (record_id, works_count, cited_by_count, index_count) with the totals to trust.

    The sums of the works (record_id, n_works, total) stand where the index holds clearly more
    works than the record says and nearly all of them were read.
    """
    j = records.join(works.select("record_id", "n_works", "total"), "record_id", "left")
    said = F.coalesce("works_count", F.lit(0))
    stale = (F.col("index_count") >= least) & (F.col("index_count") >= F.greatest(said * ratio, said + least)) & (F.col("n_works") >= complete * F.col("index_count"))
    stale = F.coalesce(stale, F.lit(False))
    pick = lambda a, b: F.when(stale, F.col(a)).otherwise(F.col(b))
    return j.select("record_id", pick("n_works", "works_count").alias("works_count"), pick("total", "cited_by_count").alias("cited_by_count"), stale.alias("is_reconciled"))


def merge_run_records(rows: DataFrame) -> DataFrame:
    """One record per (source, day) of several (seq, rolling, notes, stale_ids): a rolling run's stands before others, then the latest; stale ids add up."""
    order = F.struct(F.coalesce("rolling", F.lit(0)) > 0, "seq")
    base = rows.groupBy("source", "day").agg(F.max_by(F.struct("rolling", "notes"), order).alias("r"))
    ids = rows.select("source", "day", F.explode("stale_ids").alias("_i")).distinct().groupBy("source", "day").agg(F.sort_array(F.collect_list("_i")).alias("stale_ids"))
    return base.join(ids, ["source", "day"], "left").select("source", "day", "r.*", F.coalesce("stale_ids", F.array().cast("array<string>")).alias("stale_ids"))


def weekly_plan(total: int, discovery: int, left: int | None, floor: int = 10) -> tuple[int, int]:
    """(searches a run may spend, of these for discovery) when ``left`` remain; a run cut below ``floor`` gives discovery none."""
    spend = total if left is None else max(0, min(total, left))
    if spend == total:
        return total, min(discovery, total)
    return spend, spend * discovery // total if total and spend >= floor else 0


def flag_report(flags: list[DataFrame], people: DataFrame) -> DataFrame:
    """Flags (person_id, flag) of several rules beside the person's last name, in its order."""
    out = flags[0]
    for f in flags[1:]:
        out = out.unionByName(f)
    return out.join(people.select("person_id", "last_name"), "person_id").select("person_id", "last_name", "flag").orderBy("last_name", "person_id", "flag")


def extra_records_to_review(accepted: DataFrame, primary: DataFrame, topic_share: float = 0.5, fragment: int = 3) -> DataFrame:
    """Accepted records beside the primary one that agree neither in institution nor in topics and are no fragment.

    accepted: person_id, external_id, works_count, institution, topic_share; primary: person_id, primary_id.
    """
    own = primary.select(F.col("person_id").alias("_who"), F.col("primary_id").alias("_main"))
    main = accepted.join(own, (F.col("person_id") == F.col("_who")) & (F.col("external_id") == F.col("_main"))).select("_who", "_main", F.col("institution").alias("_home"))
    j = accepted.join(main, F.col("person_id") == F.col("_who")).where("external_id <> _main")
    away = F.coalesce(F.col("institution") != F.col("_home"), F.lit(False))
    return j.where(away & (F.coalesce("topic_share", F.lit(0.0)) < topic_share) & (F.coalesce("works_count", F.lit(0)) > fragment)).select("person_id", "external_id")


def export_json(index: DataFrame, path: str) -> None:
    """A search index as lines of JSON."""
    index.select(F.to_json(F.struct(*index.columns)).alias("value")).write.mode("overwrite").text(path)


def current_members(appointments: DataFrame, departments: DataFrame) -> DataFrame:
    """(person_id, department_id, short_name) of open primary appointments of any type."""
    return appointments.where("is_open and is_primary = 1").select("person_id", "department_id").join(small_side(departments.select("department_id", "short_name")), "department_id")

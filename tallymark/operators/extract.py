"""Names, titles, ranks and links out of page text.

Lines are read as words: a title is judged by the words around 'professor', a heading by what
kinds of words it is made of, a name by the form of its words. All of it is column expressions
but the decoding of character references, which has no built-in and runs in Arrow batches.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.names import plain

#: Elements whose content is never shown, and those that end a line of the page.
HIDDEN = ("script", "style", "noscript", "svg")
BLOCKS = ("br", "p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "td", "th", "dt", "dd")

#: Short forms of the words of a title.
SHORT = {"prof": "professor", "assoc": "associate", "asst": "assistant", "assist": "assistant"}
#: Words that open a title of any kind.
TITLE_WORDS = ("professor", "lecturer", "instructor", "reader", "dean", "director", "adjunct", "affiliate", "visiting", "emeritus", "emerita", "fellow", "postdoctoral")
#: Words on a title's line that make it a post outside the ranks.
OFF_LADDER = ("adjunct", "affiliate", "affiliated", "clinical", "courtesy", "emerita", "emeriti", "emeritus", "fellow", "honorary", "instruction", "instructional", "instructor", "lecturer", "postdoc", "postdoctoral", "practice", "sessional", "visiting")
#: Words that do so only right before 'professor', and pairs of words that do so anywhere.
OFF_LADDER_BEFORE = ("research", "teaching")
OFF_LADDER_PAIRS = ("in residence", "part time", "of teaching", "teaching stream", "research stream")
#: Words before a bare 'professor' that mark a named chair.
CHAIR_MARKS = ("chair", "distinguished", "endowed", "family", "foundation", "memorial", "professorship")
#: Words that headings are made of: one of the first in a heading opens a side section, the others may stand beside it.
SIDE_WORDS = ("adjunct", "affiliated", "affiliate", "affiliates", "courtesy", "cross", "emeriti", "emeritus", "emerita", "former", "lecturers", "memoriam", "part", "retired", "staff", "visiting")
HEADING_WORDS = ("administrative", "and", "appointed", "appointments", "faculty", "in", "of", "professors", "scholars", "sessional", "time")
CORE_WORDS = ("core", "current", "faculty", "full", "members", "our", "tenure", "tenured", "time", "track")
#: Words of pages that no name holds.
NOT_NAMES = (
    "about", "academic", "admissions", "advisor", "alumni", "and", "architecture", "assistant", "assoc", "associate", "asst", "calendar", "campus", "career", "center", "centre", "chair", "city", "college", "committee", "community",
    "contact", "coordinator", "course", "courses", "dean", "degree", "department", "design", "director", "directory", "doctoral", "education", "email", "emerita", "emeritus", "engineering", "events", "faculty", "fellow",
    "for", "full", "graduate", "group", "head", "history", "home", "housing", "institute", "interests", "lab", "laboratory", "lecturer", "library", "master", "media", "meet", "menu", "more", "news", "office", "of",
    "our", "page", "people", "phone", "planning", "policy", "prof", "professor", "profile", "program", "programme", "project", "public", "publications", "read", "regional", "research", "school", "science", "search", "seminar",
    "social", "staff", "stories", "student", "students", "studies", "studio", "support", "team", "the", "transport", "undergraduate", "university", "urban", "view", "welcome", "with",
)
#: Words that mark a link to a page of people, and those that mark another kind of page.
PEOPLE_LINKS = ("directory", "faculty", "people", "profile", "profiles", "staff", "team")
OTHER_LINKS = ("alumni", "event", "events", "news", "student", "students")
#: Paths under which people are often listed, tried after the links of a page.
USUAL_PATHS = ("people", "faculty", "staff", "directory", "about/people")


@F.pandas_udf(T.StringType())
def _decoded(text: pd.Series) -> pd.Series:
    """Named and numeric character references as characters."""
    return text.map(lambda t: t if t is None or "&" not in t else html.unescape(t))


def text_of(page: Column) -> Column:
    """Visible text with the line structure kept; null stays null.

    The page is cut at its tags. A piece that follows the end of a line-ending element starts a
    new line, any other piece goes on after a space.
    """
    shown = F.regexp_replace(page, rf"(?is)<({'|'.join(HIDDEN)})\b.*?</\1\s*>|<!--.*?-->", " ")
    ends = F.array(*[F.lit(x) for b in BLOCKS for x in ([b] if b == "br" else ["/" + b])])

    def piece(p: Column, i: Column) -> Column:
        tag = F.lower(F.regexp_extract(p, r"^(/?[a-zA-Z][a-zA-Z0-9]*)", 1))
        rest = F.regexp_replace(p, r"^[^>]*>?", "")
        return F.when(i == 0, p).otherwise(F.concat(F.when(F.array_contains(ends, tag), "\n").otherwise(" "), rest))

    flat = _decoded(F.array_join(F.transform(F.split(shown, "<"), piece), ""))
    lines = F.transform(F.split(flat, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t ]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def page_lines(pages: DataFrame, page_id: str, text: Column) -> DataFrame:
    """(page_id, line_no, line): non-blank lines, numbered from 0 by their place."""
    return pages.select(page_id, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).where(F.trim("line") != "").select(page_id, F.col("line_no").cast("bigint").alias("line_no"), F.trim("line").alias("line"))


def _among(words: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def title_words(line: Column) -> Column:
    """Lower-case words of a line, short forms of titles written out."""
    words = F.filter(F.split(F.lower(line), r"[^\p{L}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.coalesce(F.create_map(*[F.lit(x) for kv in SHORT.items() for x in kv])[w], w))


def title_rank(line: Column) -> Column:
    """Rank of the first title on a line; null for a post without rank, a named chair or no title."""
    words = title_words(line)
    at = F.array_position(words, "professor").cast("int")  # from 1; 0 if there is none
    ahead = F.slice(words, 1, F.greatest(at - 1, F.lit(0)))
    before = F.try_element_at(ahead, F.lit(-1))
    opens = F.get(F.filter(words, lambda w: F.array_contains(_among(TITLE_WORDS), w)), 0)
    text = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    off = F.arrays_overlap(words, _among(OFF_LADDER)) | F.coalesce(before.isin(*OFF_LADDER_BEFORE), F.lit(False)) | F.exists(_among(OFF_LADDER_PAIRS), lambda p: text.contains(F.concat(F.lit(" "), p, F.lit(" "))))
    ranked = before.isin("assistant", "associate", "full")
    # A capitalised word right before a bare title, nothing between, names a chair.
    named = F.arrays_overlap(ahead, _among(CHAIR_MARKS)) | line.rlike(r"^(?:.*\s)?\p{Lu}[\p{L}\p{N}.’'-]*\s+(?i:professor|prof\b)")
    return F.when((at == 0) | off | (opens != "professor"), None).when(F.coalesce(ranked, F.lit(False)), before).when(line.isNotNull() & ~F.coalesce(named, F.lit(False)), F.lit("full"))


def is_title(line: Column) -> Column:
    return F.arrays_overlap(title_words(line), _among(TITLE_WORDS))


def section_of(line: Column) -> Column:
    """'side' for a heading of emeriti, adjuncts, visitors or staff, 'core' for one of the faculty itself, else null."""
    words = title_words(line)
    made_of = lambda *lists: F.size(F.array_except(words, _among(sum(lists, ())))) == 0
    short = F.size(words).between(1, 5)
    side = short & F.arrays_overlap(words, _among(SIDE_WORDS)) & made_of(SIDE_WORDS, HEADING_WORDS)
    core = short & F.array_contains(words, "faculty") & made_of(CORE_WORDS)
    return F.when(side, "side").when(core, "core")


def name_on(line: Column) -> Column:
    """The person's name if the line is essentially a name, without honorifics, remarks in brackets and credentials; else null."""
    c = F.regexp_replace(F.trim(F.regexp_replace(line, r"\([^)]*\)", " ")), r"^(?i:dr|prof|professor|mrs?|ms|mx)\.?\s+", "")
    # Credentials stand after a comma in a few capitals each, or bare in capitals alone.
    c = F.trim(F.regexp_replace(c, r"(?:,\s*(?:(?:\p{Lu}\p{Ll}{0,2}\.?\s?){2,6}|[JS]r\.?)|\s+(?:\p{Lu}{2,6}|Ph\.?\s?D\.?|[JS]r\.?))+[\s,]*$", ""))
    words = F.split(c, r"\s+")
    form = F.forall(words, lambda w: w.rlike(r"^\p{Lu}[\p{L}.’'-]*$")) & F.try_element_at(words, F.lit(-1)).rlike(r"\p{L}{2}")
    bare = F.split(F.regexp_replace(plain(c), "[^a-z]+", " "), " ")
    return F.when(F.size(words).between(2, 4) & form & (c != F.upper(c)) & ~F.arrays_overlap(bare, _among(NOT_NAMES)), c)


def name_key(name: Column) -> Column:
    """A name as plain words, apostrophes closed up."""
    return F.trim(F.regexp_replace(F.regexp_replace(plain(name), "['’]", ""), "[^a-z]+", " "))


def names_with_titles(lines: DataFrame, page_id: str) -> DataFrame:
    """(page_id, name, rank_name): the nearest name at most three lines above a ranked title, or on its line before a comma.

    Lines under a side heading (emeriti, adjuncts, staff) count only after the next core heading.
    A title between a name and a later title keeps the name. A name appears once per page, with its
    first rank. A page is one window partition; pages are bounded documents.
    """
    w = Window.partitionBy(page_id).orderBy("line_no")
    rows = lines.withColumn("_sec", F.last(section_of(F.col("line")), ignorenulls=True).over(w)).withColumn("_rank", title_rank(F.col("line"))).withColumn("_title", is_title(F.col("line"))).withColumn("_name", name_on(F.col("line")))
    # Only a line that is a title ends the reach of the names above it.
    back = lambda c, n: F.lag(c, n).over(w)
    t1, t2 = F.coalesce(back("_title", 1), F.lit(False)), F.coalesce(back("_title", 2), F.lit(False))
    own = name_on(F.regexp_extract("line", r"^([^,|;]+)[,|;]", 1))
    found = F.coalesce(own, back("_name", 1), F.when(~t1, back("_name", 2)), F.when(~t1 & ~t2, back("_name", 3)))
    hits = rows.withColumn("name", found).where("_rank is not null and name is not null and coalesce(_sec, 'core') = 'core'")
    first = hits.groupBy(page_id, name_key(F.col("name")).alias("_k")).agg(F.min(F.struct("line_no", "name", "_rank")).alias("h"))
    return first.select(page_id, F.col("h.name").alias("name"), F.col("h._rank").alias("rank_name"))


def named_on_lines(lines: DataFrame, page_id: str, roster: DataFrame, longest: int = 110, extra: int = 45) -> DataFrame:
    """(page_id, person_id, line_no, line): lines that name a person of the page's roster as a listing does.

    roster: page_id, person_id, first_name, last_name. A line names a person who stands on it as
    'First Last', 'First M. Last' or 'Last, First', if it is at most ``longest`` characters
    long with at most ``extra`` beside the name. People meet lines through their last word, an
    equi-join, and not every person every line.
    """
    key = lambda c: F.element_at(F.split(name_key(c), " "), -1)
    who = roster.select(F.col(page_id).alias("_page"), "person_id", name_key(F.col("first_name")).alias("_f"), name_key(F.col("last_name")).alias("_l"), key(F.col("last_name")).alias("_w")).where("_f <> '' and _l <> ''")
    text = lines.where(F.length("line") <= longest).select(page_id, "line_no", "line", F.concat(F.lit(" "), name_key(F.col("line")), F.lit(" ")).alias("_t"))
    text = text.withColumn("_w", F.explode(F.array_distinct(F.split(F.trim("_t"), " "))))
    both = text.join(who, (F.col(page_id) == F.col("_page")) & (text["_w"] == who["_w"]))
    straight = F.concat(F.lit(" "), F.col("_f"), F.lit(" "), F.col("_l"), F.lit(" "))
    turned = F.concat(F.lit(" "), F.col("_l"), F.lit(" "), F.col("_f"), F.lit(" "))
    middle = F.concat(F.lit(" "), F.col("_f"), F.lit(" "))
    # One word between: what follows the first name holds the last name after a single word.
    after = F.call_function("substring_index", F.col("_t"), middle, F.lit(-1))
    between = F.col("_t").contains(middle) & F.substring(after, F.instr(after, " ") + 1, 4000).startswith(F.concat(F.col("_l"), F.lit(" ")))
    holds = F.col("_t").contains(straight) | (F.col("_t").contains(turned) & F.col("line").contains(",")) | between
    size = F.length("_f") + F.length("_l") + 1
    return both.where(holds & (F.length("line") - size <= extra)).select(page_id, "person_id", "line_no", "line").distinct()


def ranks_on_pages(lines: DataFrame, page_id: str, roster: DataFrame) -> DataFrame:
    """(page_id, person_id, has_title, rank_name) for each roster person a page names.

    The title stands on the line of the name or on one of the two after it, before the next
    person's name. The first ranked line of a person counts.
    """
    w = Window.partitionBy(page_id).orderBy("line_no")
    ahead = lambda c, n: F.lead(c, n).over(w)
    marks = lines.select(page_id, "line_no", "line", title_rank(F.col("line")).alias("_r"), is_title(F.col("line")).alias("_t"), name_key(name_on(F.col("line"))).alias("_n"))
    for n in (1, 2):
        marks = marks.withColumn(f"_r{n}", ahead("_r", n)).withColumn(f"_t{n}", F.coalesce(ahead("_t", n), F.lit(False))).withColumn(f"_n{n}", ahead("_n", n))
    other = lambda n: ~F.col(f"_t{n}") & F.col(f"_n{n}").isNotNull() & ~F.col(f"_n{n}").eqNullSafe(F.col("_n"))
    in_1 = ~F.col("_t") & ~other(1)
    in_2 = in_1 & ~F.col("_t1") & ~other(2)
    title = F.col("_t") | (in_1 & F.col("_t1")) | (in_2 & F.col("_t2"))
    rank = F.when(F.col("_t"), F.col("_r")).when(in_1 & F.col("_t1"), F.col("_r1")).when(in_2, F.col("_r2"))
    marks = marks.select(page_id, "line_no", title.alias("_has"), rank.alias("_rank"))
    found = named_on_lines(lines, page_id, roster).join(marks, [page_id, "line_no"])
    return found.groupBy(page_id, "person_id").agg(F.bool_or("_has").alias("has_title"), F.min_by("_rank", F.when(F.col("_rank").isNotNull(), F.col("line_no"))).alias("rank_name"))


RANK_ORDER = {"assistant": 0, "associate": 1, "full": 2}


def scan_pages(lines: DataFrame, page_id: str, roster: DataFrame, everyone: DataFrame, least: int = 2) -> DataFrame:
    """What a page says of its roster and of others: (page_id, kind, person_id, name_key, old_rank, new_rank).

    roster: page_id, person_id, first_name, last_name, rank_name; everyone: person_id,
    first_name, last_name. Only a page that names ``least`` of its roster is a listing. Roster
    people are 'rank_ok', 'promotion', 'demotion', 'no_rank' (a title outside the ranks) or
    'not_found'. A page that gives titles to at least two and none below full does not tell
    ranks apart, so its 'full' says nothing. A ranked name not on the roster is a
    'possible_move' if somebody of that name is on file, else 'new_hire', or 'new_hire_unsure'
    on a page that names more strangers than 3 and than roster people: a wider directory.
    """
    order = lambda c: F.create_map(*[F.lit(x) for kv in RANK_ORDER.items() for x in kv])[c]
    read = ranks_on_pages(lines, page_id, roster)
    pages = read.groupBy(page_id).agg(
        F.count(F.lit(1)).alias("_named"), (F.coalesce(F.count_if("has_title"), F.lit(0)) >= 2).alias("_some"), F.coalesce(F.bool_or(F.col("rank_name").isin("assistant", "associate")), F.lit(False)).alias("_apart")
    ).where(F.col("_named") >= least)
    told = roster.join(pages, page_id).join(read.withColumnRenamed("rank_name", "_read"), [page_id, "person_id"], "left")
    new = F.when(~((F.col("_read") == "full") & F.col("_some") & ~F.col("_apart")), F.col("_read"))
    kind = (
        F.when(~F.coalesce("has_title", F.lit(False)), "not_found").when(F.col("_new").isNull(), "no_rank").when(F.col("_new") == F.col("rank_name"), "rank_ok")
        .when(order(F.col("_new")) > F.coalesce(order(F.col("rank_name")), F.lit(-1)), "promotion").otherwise("demotion")
    )
    own = told.withColumn("_new", new).select(page_id, kind.alias("kind"), "person_id", name_key(F.concat_ws(" ", "first_name", "last_name")).alias("name_key"), F.col("rank_name").alias("old_rank"), F.col("_new").alias("new_rank"))
    # First and last word: a middle name on one side only makes no stranger.
    ends = lambda c: F.regexp_replace(c, " .* ", " ")
    keyed = lambda df, *keep: df.select(*keep, ends(name_key(F.concat_ws(" ", "first_name", "last_name"))).alias("_ends"))
    others = names_with_titles(lines, page_id).select(page_id, name_key(F.col("name")).alias("name_key"), ends(name_key(F.col("name"))).alias("_ends"), F.col("rank_name").alias("new_rank")).join(pages.select(page_id, "_named"), page_id)
    others = others.join(keyed(roster, page_id), [page_id, "_ends"], "left_anti").join(keyed(everyone, F.col("person_id").alias("_held")).groupBy("_ends").agg(F.min("_held").alias("person_id")), "_ends", "left")
    strangers = others.groupBy(page_id).agg(F.count_if(F.col("person_id").isNull()).alias("_n"))
    wide = F.col("_n") > F.greatest(F.lit(3), F.col("_named"))
    more = others.join(strangers, page_id).select(
        page_id, F.when(F.col("person_id").isNotNull(), "possible_move").when(wide, "new_hire_unsure").otherwise("new_hire").alias("kind"), "person_id", "name_key", F.lit(None).cast("string").alias("old_rank"), "new_rank"
    )
    return own.unionByName(more)


def page_links(pages: DataFrame, page_id: str, url: str, html_text: str, keep: int = 6, people_only: bool = False) -> DataFrame:
    """(page_id, place, link): distinct links to the page's own host, in page order, at most ``keep``.

    With ``people_only`` a link counts only if its label or address has a word for a page of
    people and none for students, alumni, news or events; the usual paths of such pages
    follow after the links. What follows '?' in a link goes then.
    """
    host = lambda c: F.lower(F.regexp_extract(c, r"^(?i:https?)://([^/?#]+)", 1))
    anchor = r"(?is)<a\b[^>]*\bhref\s*=\s*[\"']([^\"'#]+)[^>]*>(.*?)(?:</a|$)"
    raw = pages.select(page_id, F.col(url).alias("_u"), F.posexplode(F.regexp_extract_all(html_text, F.lit(anchor), 0)).alias("_o", "_a"))
    raw = raw.withColumn("_h", F.regexp_extract("_a", anchor, 1))
    root = lambda c: F.regexp_extract(c, r"^((?i:https?)://[^/?#]+)", 1)
    if people_only:
        said = F.split(F.lower(F.concat_ws(" ", F.regexp_replace(F.regexp_extract("_a", anchor, 2), "<[^>]*>", " "), F.col("_h"))), "[^a-z]+")
        raw = raw.where(F.arrays_overlap(said, _among(PEOPLE_LINKS)) & ~F.arrays_overlap(said, _among(OTHER_LINKS)))
    raw = raw.select(page_id, "_u", "_o", "_h")
    if people_only:
        paths = F.posexplode(F.array(*[F.lit(f"/{p}/") for p in USUAL_PATHS])).alias("_p", "_h")
        raw = raw.unionByName(pages.select(page_id, F.col(url).alias("_u"), paths).select(page_id, "_u", (F.col("_p") + 1_000_000).alias("_o"), "_h"))
    full = F.when(F.col("_h").rlike(r"^(?i)https?://"), F.col("_h")).when(F.col("_h").startswith("/"), F.concat(root(F.col("_u")), F.col("_h")))
    if people_only:
        full = F.regexp_replace(full, r"\?.*$", "")
    same = raw.withColumn("link", full).where(host(F.col("link")) == host(F.col("_u"))).groupBy(page_id, "link").agg(F.min("_o").alias("_o"))
    place = F.row_number().over(Window.partitionBy(page_id).orderBy("_o"))
    return same.withColumn("place", place).where(F.col("place") <= keep).select(page_id, "place", "link")


def scan_changes(found: DataFrame, roster: DataFrame, held: DataFrame) -> DataFrame:
    """Names read on pages against the roster: (department_id, name_key, kind, old_rank, new_rank).

    found and roster: department_id, name_key, rank_name. 'rank_ok' or 'rank_change' for people
    on the roster, 'new_hire' for others, without those on the ``held`` list (department_id, name_key).
    """
    j = found.join(roster.withColumnRenamed("rank_name", "old_rank"), ["department_id", "name_key"], "left")
    kind = F.when(F.col("old_rank").isNull(), "new_hire").when(F.col("old_rank") == F.col("rank_name"), "rank_ok").otherwise("rank_change")
    out = j.select("department_id", "name_key", kind.alias("kind"), "old_rank", F.col("rank_name").alias("new_rank"))
    kept = out.join(held.select("department_id", "name_key").withColumn("_held", F.lit(True)), ["department_id", "name_key"], "left")
    return kept.where("kind <> 'new_hire' or _held is null").drop("_held")

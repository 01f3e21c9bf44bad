"""Spelling of sources and ranks, figures and written dates, as JVM-side columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sources and ranks of the data model, in order of trust and of career.
SOURCES = ("google_scholar", "openalex", "pop", "manual")
RANKS = ("assistant", "associate", "full", "other")


def letters(c: Column) -> Column:
    """Lower-case letters only; every separator and punctuation mark goes."""
    return F.regexp_replace(F.lower(c), "[^a-z]", "")


def source_name(c: Column) -> Column:
    """Evened-out source: one of SOURCES, else the letters as written, null stays null."""
    key = letters(c)
    # Most rows are spelled plainly; only the others go through the pattern.
    return F.when(c.isin(*SOURCES), c).when(key == "googlescholar", F.lit("google_scholar")).when(key != "", key)


def rank_name(c: Column) -> Column:
    """Evened-out rank: one of RANKS; other words give 'other', null and blank give null."""
    key = F.regexp_replace(letters(c), "(?:professor|prof)$", "")
    out = F.when(c.isNull() | (F.trim(c) == ""), F.lit(None).cast("string"))
    return out.when(key.isin(*RANKS[:3]), key).when(key == "", F.lit("full")).otherwise(F.lit("other"))


def source_trust(source: Column) -> Column:
    """Trust of an evened-out source: 4 for the most trusted, 0 for one not listed."""
    out = None
    for i, name in enumerate(SOURCES):
        level = F.lit(len(SOURCES) - i)
        out = F.when(source == name, level) if out is None else out.when(source == name, level)
    return out.otherwise(F.lit(0))


def usable(c: Column) -> Column:
    """A figure if it is neither null nor negative, else null."""
    return F.when(c >= 0, c)


def written_day(c: Column) -> Column:
    """Day of an ISO 8601 text as 'YYYY-MM-DD', basic or extended form; else null."""
    t = F.trim(c)
    basic = F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))
    return (
        F.when(F.substring(t, 5, 1) == "-", F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(t, 1, 10)))
        .when(t.rlike(r"^\d{8}(?:\D|$)"), basic)
    )


def written_millis(c: Column) -> Column:
    """Milliseconds since midnight of an ISO 8601 text; no time of day counts as 0."""
    t = F.trim(c)
    rest = F.when(F.substring(t, 5, 1) == "-", F.substring(t, 11, 40)).otherwise(F.substring(t, 9, 40))
    digits = F.rpad(F.regexp_replace(rest, r"\D", ""), 9, "0")
    part = lambda i, n: F.substring(digits, i, n).try_cast("long")
    millis = part(1, 2) * 3_600_000 + part(3, 2) * 60_000 + part(5, 2) * 1_000 + part(7, 3)
    return F.coalesce(millis, F.lit(0).cast("long"))


def flexible_date(c: Column) -> Column:
    """Date of 'YYYY', 'YYYY-MM', 'YYYY-MM-DD' or a longer ISO text; else null."""
    t = F.trim(c)
    full = (
        F.when(F.length(t) == 4, F.concat(t, F.lit("-01-01")))
        .when(F.length(t) == 7, F.concat(t, F.lit("-01")))
        .otherwise(F.substring(t, 1, 10))
    )
    return F.when(full.rlike(r"^\d{4}-\d{2}-\d{2}$"), full.try_cast("date"))


def figure(c: Column) -> Column:
    """A figure written as text as decimal(38,6): outer spaces and thousands commas go,
    anything that is no number then is null."""
    t = F.regexp_replace(F.trim(c), ",", "")
    return F.when(t.rlike(r"^[+-]?\d+(?:\.\d*)?$"), t.try_cast("decimal(38,6)"))


def day_text(c: Column) -> Column:
    """A date as 'YYYY-MM-DD'."""
    return F.date_format(c, "yyyy-MM-dd")

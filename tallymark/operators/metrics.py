"""The view graph: current appointments, latest and headline figures, percentiles, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.text import source_trust
from tallymark.operators.ranking import kth_values, measure_ranks
from tallymark.session import materialize, small_side

#: Fewest members for a group to be ranked.
RANKED_FROM = 3


def current_appointments(appointments: DataFrame, departments: DataFrame) -> DataFrame:
    """Open primary regular appointments with the kind of their department."""
    mine = appointments.where(F.col("is_open") & (F.col("is_primary") == 1) & (F.col("appointment_type") == "regular"))
    return mine.join(small_side(departments.select("department_id", "kind")), "department_id")


def latest_readings(readings: DataFrame) -> DataFrame:
    """Readings of the latest moment of their person and source; all of them on a tie.

    The moments, numbers, fold in a hashed grouped maximum before the join, so a person with
    very many readings is one row on the small side.
    """
    last = readings.where("source is not null and moment is not null").groupBy("person_id", "source").agg(F.max("moment").alias("moment"))
    return readings.join(last, ["person_id", "source", "moment"], "left_semi")


def held_readings(latest: DataFrame, people: DataFrame, source: str, id_column: str) -> DataFrame:
    """Latest readings of a source for people who hold its identifier."""
    holders = people.where(F.col(id_column).isNotNull() & (F.col(id_column) != "")).select("person_id")
    return latest.where(F.col("source") == source).join(holders, "person_id", "left_semi")


def headline(readings: DataFrame, people: DataFrame) -> DataFrame:
    """One figure per person by source precedence, then latest moment, then greatest snapshot_id.

    Readings of the two profile sources count only for people who hold that source's
    identifier. The latest reading of the most trusted source is the greatest of all by that
    order, so one grouped maximum over the readings finds it.
    """
    holds = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    held = people.select("person_id", holds("google_scholar_id").alias("_gs"), holds("openalex_author_id").alias("_oa"))
    known = readings.where("source is not null and moment is not null").join(held, "person_id", "left")
    counts = F.when(F.col("source") == "google_scholar", F.col("_gs")).when(F.col("source") == "openalex", F.col("_oa")).otherwise(F.lit(True))
    rest = [c for c in readings.columns if c not in ("person_id", "moment", "snapshot_id")]
    best = known.where(counts).groupBy("person_id").agg(F.max(F.struct(source_trust(F.col("source")).alias("_t"), "moment", "snapshot_id", *rest)).alias("r"))
    return best.select("person_id", "r.*").drop("_t").withColumn("is_fallback", (F.col("source") != "google_scholar").cast("int"))


def _years(df: DataFrame) -> DataFrame:
    years = F.substring("day", 1, 4).try_cast("bigint") - F.col("phd_year")
    return df.withColumn("years_since_phd", years).withColumn("citations_per_year", F.when(F.col("years_since_phd") > 0, F.col("total_citations") / F.col("years_since_phd")))


def ranked_people(current: DataFrame, departments: DataFrame, people: DataFrame, heads: DataFrame) -> DataFrame:
    """Headline figures of the people with a current appointment of kind 'planning'."""
    return _years(
        current.where("kind = 'planning'")
        .join(small_side(departments.select("department_id", F.col("short_name").alias("department"))), "department_id")
        .join(people.select("person_id", "display_name", "phd_year"), "person_id")
        .join(heads.select("person_id", "source", "is_fallback", "day", "total_citations", "h_index"), "person_id")
        .select("person_id", "display_name", "department_id", "department", "rank_name", heads["source"], "is_fallback", "day", "total_citations", "h_index", "phd_year")
    )


def percentiles(ranked: DataFrame) -> DataFrame:
    """Percent ranks of citations and h-index, overall and within rank.

    Both measures are ranked in one pass; each measure then joins back once by rank and value.
    """
    out = materialize(ranked, "ranked-people")
    ranks = materialize(measure_ranks(out, "rank_name", ["total_citations", "h_index"]), "ranks")
    for measure, short, place in (("total_citations", "citations", "rank_by_citations"), ("h_index", "h", "rank_by_h_index")):
        of = ranks.where(F.col("_m") == measure).select("_g", "_v", F.col("pct_all").alias(f"pct_{short}_all"), F.col("desc_all").alias(place), F.col("pct_group").alias(f"pct_{short}_rank"))
        out = out.join(of, F.col("rank_name").eqNullSafe(F.col("_g")) & F.col(measure).eqNullSafe(F.col("_v"))).drop("_g", "_v")
    return out.drop("phd_year")


def other_units(current: DataFrame, departments: DataFrame, people: DataFrame, heads: DataFrame) -> DataFrame:
    """Figures of people whose current appointment is in a department of kind 'other'."""
    return _years(
        current.where("kind = 'other'")
        .join(small_side(departments.select("department_id", F.col("name").alias("unit"), "university")), "department_id")
        .join(people.select("person_id", "display_name", "phd_year"), "person_id")
        .join(heads.select("person_id", "source", "is_fallback", "day", "total_citations", "h_index"), "person_id")
        .select("person_id", "display_name", "department_id", "unit", "university", "rank_name", heads["source"], "is_fallback", "day", "total_citations", "h_index", "phd_year")
    ).drop("phd_year")


def department_summary(ranked: DataFrame, departments: DataFrame) -> DataFrame:
    """Members, totals, means and medians by department, ranked by median from three members on.

    The median counts null figures as the lowest, as the mean of the middle two rows.
    """
    ranked = materialize(ranked, "ranked-people")
    medians = kth_values(ranked, "department_id", {m: {f"{m}_lo": "(n + 1) div 2", f"{m}_hi": "(n + 2) div 2"} for m in ("total_citations", "h_index")})
    lo, hi = (lambda m: F.col(f"{m}_lo")), (lambda m: F.col(f"{m}_hi"))
    middle = lambda m: F.when(lo(m).isNull(), hi(m).cast("double")).when(hi(m).isNull(), lo(m).cast("double")).otherwise((lo(m) + hi(m)) / 2)
    medians = medians.select("department_id", middle("total_citations").alias("median_citations"), middle("h_index").alias("median_h_index"))
    sums = ranked.groupBy("department_id").agg(
        F.count(F.lit(1)).alias("n_faculty"),
        F.sum("total_citations").alias("total_citations"),
        F.avg("total_citations").alias("mean_citations"),
        F.avg("h_index").alias("mean_h_index"),
        F.avg((F.col("source") == "google_scholar").cast("double")).alias("share_with_scholar_profile"),
    )
    out = sums.join(medians, "department_id")
    ranking = F.rank().over(Window.partitionBy(F.col("n_faculty") >= RANKED_FROM).orderBy(F.col("median_citations").desc_nulls_last()))
    # One row per department from here on.
    return (
        departments.select("department_id", "short_name", "university", "country", "acsp_member")
        .join(out, "department_id")
        .withColumn("citations_per_faculty", F.col("total_citations") / F.col("n_faculty"))
        .withColumn("rank_by_median_citations", F.when(F.col("n_faculty") >= RANKED_FROM, ranking.cast("bigint")))
    )


def rank_benchmarks(current: DataFrame, heads: DataFrame) -> DataFrame:
    """Lower median and upper quartile of the most trusted source's figures by rank."""
    rows = heads.where("source = 'google_scholar' and total_citations is not null and h_index is not null").select("person_id", "total_citations", "h_index")
    rows = rows.join(current.where("kind = 'planning'").select("person_id", "rank_name"), "person_id")
    places = {"total_citations": {"median_citations": "(n + 1) div 2", "p75_citations": "(3 * n + 3) div 4"}, "h_index": {"median_h_index": "(n + 1) div 2"}}
    return kth_values(rows, "rank_name", places)

"""Readers and writers of curated tables, snapshot files, run records and saved pages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L = T.StringType(), T.LongType()


def _schema(text: str, numbers: str = "") -> T.StructType:
    wide = set(numbers.split())
    return T.StructType([T.StructField(c, _L if c in wide else _S) for c in text.split()])


SCHEMAS = {
    "department": _schema("department_id short_name name university country url openalex_institution_id ror_id acsp_member active kind", "department_id active"),
    "person": _schema("person_id first_name middle_name last_name display_name phd_year phd_institution interests google_scholar_id openalex_author_id orcid semantic_scholar_id researchgate_url linkedin_url personal_url notes", "person_id phd_year"),
    "person_alias": _schema("person_id alias", "person_id"),
    "affiliation": _schema("affiliation_id person_id department_id rank appointment_type is_primary start_date end_date source", "affiliation_id person_id department_id is_primary"),
    "metric_snapshot": _schema("person_id source collected_at total_citations h_index i10_index citations_5yr h_index_5yr works_count raw_json", "person_id total_citations h_index i10_index citations_5yr h_index_5yr works_count"),
}
#: Values of columns that a file may lack.
DEFAULTS = {"department": {"kind": "planning", "active": 1}, "affiliation": {"appointment_type": "regular", "is_primary": 1}}
META = T.StructType([T.StructField("trigger", _S), T.StructField("notes", _S), T.StructField("ok", _L), T.StructField("failed", _L), T.StructField("attempted", _L), T.StructField("stopped", _S), T.StructField("_corrupt_record", _S)])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, defaults: dict | None = None, keep_blank: bool = False) -> DataFrame:
    """A CSV file with a header under a declared schema; blanks are null unless ``keep_blank``.

    Columns go by name. A missing column takes its default or null, an unknown one is an error.
    Quoted fields may hold line ends and doubled quotes. Text that is no number gives null.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    raw = (reader.option("nullValue", None).option("emptyValue", "") if keep_blank else reader).csv(path)
    unknown = set(raw.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"unknown columns in {path}: {sorted(unknown)}")
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        if f.name not in raw.columns:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
        elif keep_blank and f.dataType == _S:
            cols.append(F.coalesce(F.col(f.name), F.lit("")).alias(f.name))
        else:
            value = F.nullif(F.trim(F.col(f.name)), F.lit(""))
            cols.append((value if f.dataType == _S else value.try_cast(f.dataType)).alias(f.name))
    return raw.select(*cols)


def load_tables(spark: SparkSession, roster_dir: str) -> dict[str, DataFrame]:
    """The curated tables of a folder, one CSV file each."""
    return {t: read_csv(spark, f"{roster_dir}/{t}.csv", SCHEMAS[t], DEFAULTS.get(t)) for t in ("department", "person", "person_alias", "affiliation")}


def read_snapshots(spark: SparkSession, root: str, source: str = "*", first_day: str | None = None) -> DataFrame:
    """Snapshot files <root>/<source>/<day>.csv as one table, with path_source, path_day and run_id.

    Only the named source's folder is listed, and ``first_day`` prunes files by their name. A run
    is one file, numbered in the order of source and day.
    """
    schema = SCHEMAS["metric_snapshot"]
    raw = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False).csv(f"{root}/{source}/*.csv")
    path = F.col("_metadata.file_path")
    rows = raw.select("*", F.regexp_extract(path, r"/([^/]+)/[^/]+\.csv$", 1).alias("path_source"), F.regexp_extract(path, r"/([^/]+)\.csv$", 1).alias("path_day"))
    if first_day is not None:
        rows = rows.where(F.col("path_day") >= first_day)
    files = rows.select("path_source", "path_day").distinct()
    from pyspark.sql import Window

    # One row per file.
    runs = files.withColumn("run_id", F.row_number().over(Window.orderBy("path_source", "path_day")).cast("bigint"))
    return rows.join(F.broadcast(runs), ["path_source", "path_day"])


def read_run_records(spark: SparkSession, root: str) -> DataFrame:
    """Run records <root>/<source>/<day>.meta.json; unreadable ones are left out."""
    raw = spark.read.schema(META).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(f"{root}/*/*.meta.json")
    path = F.col("_metadata.file_path")
    rows = raw.select("*", F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1).alias("source"), F.regexp_extract(path, r"/([^/]+)\.meta\.json$", 1).alias("day"))
    return rows.where("_corrupt_record is null").drop("_corrupt_record")


def read_saved_pages(spark: SparkSession, root: str) -> DataFrame:
    """Saved texts <dept>__*.txt: department_id from the name, the URL on line 1, the text after it."""
    raw = spark.read.text(f"{root}/*__*.txt", wholetext=True)
    parts = F.split("value", "\n", 2)
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)__[^/]*\.txt$", 1).alias("department_id"), F.trim(parts[0]).alias("url"), F.get(parts, 1).alias("text"))


def read_decisions(spark: SparkSession, path: str, needed: list[str]) -> DataFrame:
    """A review sheet exported as CSV, all text; rows without a decision go, a missing needed column is an error."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    missing = [c for c in needed if c not in raw.columns]
    if missing:
        raise ValueError(f"missing columns in {path}: {missing}")
    return raw.where(F.trim(F.coalesce("decision", F.lit(""))) != "") if "decision" in raw.columns else raw


def validate(tables: dict[str, DataFrame], snapshots: DataFrame | None = None) -> DataFrame:
    """Violations (check, key) of keys, references, allowed values and the one-primary rule; empty if all is well."""
    found = []

    def add(check: str, df: DataFrame, key) -> None:
        found.append(df.select(F.lit(check).alias("check"), F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("key")))

    def unique(check: str, df: DataFrame, key: list[str]) -> None:
        add(check, df.groupBy(*key).count().where("count > 1"), key)

    d, p, a, al = (tables[t] for t in ("department", "person", "affiliation", "person_alias"))
    unique("department.department_id unique", d, ["department_id"])
    unique("department.short_name unique", d.where("short_name is not null"), ["short_name"])
    unique("person.person_id unique", p, ["person_id"])
    for c in ("google_scholar_id", "openalex_author_id", "orcid"):
        unique(f"person.{c} unique", p.where(F.col(c).isNotNull()), [c])
    unique("affiliation.affiliation_id unique", a, ["affiliation_id"])
    unique("person_alias unique", al, ["person_id", "alias"])
    add("affiliation.person_id known", a.join(p.select("person_id"), "person_id", "left_anti"), ["affiliation_id"])
    add("affiliation.department_id known", a.join(d.select("department_id"), "department_id", "left_anti"), ["affiliation_id"])
    add("department.kind allowed", d.where("kind not in ('planning', 'other')"), ["department_id"])
    unique("one current primary appointment", a.where("end_date is null and is_primary = 1"), ["person_id"])
    add("note: person without appointment", p.join(a.select("person_id"), "person_id", "left_anti"), ["person_id"])
    if snapshots is not None:
        add("snapshot.source equals its folder", snapshots.where("source <> path_source"), ["path_source", "path_day", "person_id"])
        unique("snapshot (person, source, day) unique", snapshots, ["person_id", "source", "collected_at"])
        add("snapshot.person_id known", snapshots.join(p.select("person_id"), "person_id", "left_anti"), ["path_source", "path_day", "person_id"])
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def replace_table(df: DataFrame, path: str) -> None:
    """Write to a new folder beside ``path`` and rename it into place; the old table is there until then.

    ``df`` may read from ``path`` itself.
    """
    spark = df.sparkSession
    fs, path_of = _fs(spark, path)
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    if fs.exists(path_of(path)):
        fs.rename(path_of(path), path_of(old))
    fs.rename(path_of(fresh), path_of(path))
    fs.delete(path_of(old), True)


def append_readings(df: DataFrame, path: str) -> int:
    """Append the readings that the table at ``path`` lacks by (person, source, day); returns their number.

    Files are laid out by source, so reading one source prunes the others. No row to add leaves
    the table as it is.
    """
    spark = df.sparkSession
    fs, path_of = _fs(spark, path)
    key = ["person_id", "source", "collected_at"]
    fresh = df.dropDuplicates(key)
    if fs.exists(path_of(path)):
        fresh = fresh.join(spark.read.parquet(path).select(*key), key, "left_anti")
    fresh = fresh.persist()
    n = fresh.count()
    if n:
        fresh.write.mode("append").partitionBy("source").parquet(path)
    fresh.unpersist()
    return n


def write_report(df: DataFrame, path: str, order: list[str]) -> None:
    """A report for people as one ordered CSV file; null is blank."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def write_review_sheet(df: DataFrame, path: str, entry_columns: list[str], force: bool = False) -> None:
    """Write a review sheet, but not over one in which a reviewer has made an entry."""
    spark = df.sparkSession
    fs, path_of = _fs(spark, path)
    if not force and fs.exists(path_of(path)):
        held = spark.read.option("header", True).csv(path)
        filled = " or ".join(f"trim(coalesce(`{c}`, '')) <> ''" for c in entry_columns if c in held.columns)
        if filled and not held.where(filled).isEmpty():
            raise ValueError(f"{path} holds a reviewer's entries")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def publish(readings: DataFrame, latest: DataFrame, path: str) -> None:
    """Readings without the payloads of any but the latest of each person and source."""
    keep = latest.select("snapshot_id", F.lit(True).alias("_keep"))
    readings.join(keep, "snapshot_id", "left").withColumn("raw_json", F.when(F.col("_keep"), F.col("raw_json"))).drop("_keep").write.mode("overwrite").parquet(path)

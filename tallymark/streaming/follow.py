"""Following append-only reading files with Structured Streaming.

A stream keeps its checkpoint, its state tables and its output below one named folder. Started
again with the same folder it goes on after the last finished micro-batch; without a name it
gets a fresh folder below the shared one. A micro-batch writes folders of its own by number, so
one that is run again after a failure replaces what it wrote before, and what exists is read
from the folder and never from the memory of the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.functions.text import source_name
from tallymark.session import shared_dir
from tallymark.sources.standard import moment, moment_text

#: How late a reading may come for its week or its key to be kept in state.
LATE = "400 days"


def reading_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 8) -> DataFrame:
    """Readings as they are written below ``path``, evened out, with ``moment`` and ``at`` (a timestamp)."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    rows = rows.select("snapshot_id", "person_id", source_name(F.col("source")).alias("source"), moment(F.col("collected_at")).alias("m"), "total_citations")
    at = F.try_to_timestamp(F.substring(moment_text(F.col("m")), 1, 17), F.lit("yyyy-MM-dd'T'HHmmss"))
    return rows.select("snapshot_id", "person_id", "source", moment_text(F.col("m")).alias("moment"), at.alias("at"), "total_citations")


def _base(spark: SparkSession, name: str, folder: str | None) -> str:
    return folder.rstrip("/") if folder else f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _drop(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches below ``path`` with their number as ``batch``; empty if there is none."""
    schema = f"{schema}, batch bigint"
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def run_to_end(stream: DataFrame, name: str, keys: list[str] | None = None, folder: str | None = None) -> DataFrame:
    """Run a stream over all that is there now and read what it has written so far.

    With ``keys`` the stream runs in update mode: a batch writes only the rows that it changed,
    and the result holds each key's row of the latest batch. Without, it appends.
    """
    spark = stream.sparkSession
    base = _base(spark, name, folder)

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={n}")

    query = stream.writeStream.outputMode("update" if keys else "append").foreachBatch(write).option("checkpointLocation", f"{base}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = _written(spark, f"{base}/out", _ddl(stream))
    if not keys:
        return rows.drop("batch")
    rest = [c for c in stream.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in stream.columns])


def latest_per_key(readings: DataFrame) -> DataFrame:
    """Latest reading of each person and source; an older file that comes late replaces nothing."""
    keyed = readings.where("source is not null and moment is not null")
    best = keyed.groupBy("person_id", "source").agg(F.max(F.struct("moment", "snapshot_id", "total_citations")).alias("r"))
    return best.select("person_id", "source", F.col("r.moment").alias("moment"), F.col("r.snapshot_id").alias("snapshot_id"), F.col("r.total_citations").alias("total_citations"))


def weekly_counts(readings: DataFrame, late: str = LATE) -> DataFrame:
    """Readings per source and week, weeks starting on Monday, under a watermark."""
    # Windows are laid out from the epoch, a Thursday; four days on is a Monday.
    week = F.window("at", "7 days", "7 days", "4 days")
    counts = readings.where("source is not null and at is not null").withWatermark("at", late).groupBy(week.alias("w"), "source").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.date_format("w.start", "yyyy-MM-dd").alias("week_start"), "source", "n")


def once_per_key(readings: DataFrame, late: str = LATE) -> DataFrame:
    """Readings without re-deliveries of the same person, source and moment."""
    return readings.where("at is not null").withWatermark("at", late).dropDuplicatesWithinWatermark(["person_id", "source", "moment"])


def previous_reading_drops(stream: DataFrame, share: float = 0.2, folder: str | None = None) -> DataFrame:
    """Falls of more than ``share`` against the person's reading before, over all that is there now.

    A micro-batch keeps the latest reading of each person in a table of its own and compares
    the next batch with it, so state is read by key and not held in memory. A batch's state
    stays until the one after it is written.
    """
    spark = stream.sparkSession
    base = _base(spark, "previous", folder)
    order = Window.partitionBy("person_id").orderBy("moment", "snapshot_id")
    cols = ["person_id", "moment", "snapshot_id", "total_citations"]

    def step(batch: DataFrame, n: int) -> None:
        rows = batch.where("total_citations is not null and moment is not null").select(*cols, F.lit(True).alias("is_new"))
        if n > 0:
            rows = rows.unionByName(spark.read.parquet(f"{base}/state/batch={n - 1}").withColumn("is_new", F.lit(False)))
        seen = rows.withColumn("previous", F.lag("total_citations").over(order))
        fell = f"is_new and previous > 0 and total_citations <> 0 and (previous - total_citations) / previous > {share}D"
        seen.where(fell).select("person_id", "moment", "previous", "total_citations").write.mode("overwrite").parquet(f"{base}/out/batch={n}")
        last = rows.groupBy("person_id").agg(F.max(F.struct("moment", "snapshot_id", "total_citations")).alias("r")).select("person_id", "r.*")
        last.write.mode("overwrite").parquet(f"{base}/state/batch={n}")
        if n > 1:
            _drop(spark, f"{base}/state/batch={n - 2}")

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{base}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    return _written(spark, f"{base}/out", "person_id bigint, moment string, previous bigint, total_citations bigint").drop("batch")


def fold_status(runs: DataFrame, keep: int = 10) -> DataFrame:
    """One status per stream of runs, folded in the order of ``at``.

    runs: stream, at (a timestamp), searched, waiting (null: the run told nothing), empty,
    found, is_blocked, is_skipped. A skipped run only reports. Of the others, one that
    searched is 'searched', one with nobody waiting 'idle', else 'blocked' or 'failed'; queued
    is what a run left waiting. The first run without success since the last success begins
    the stall. Result: stream, reported, outcome, queued, last_searched, stalled_since and
    batches, the last ``keep`` days with searches.

    Each figure is an aggregate of its own, so a stream of very many runs folds before the shuffle.
    """
    told = ~F.coalesce(F.col("is_skipped"), F.lit(False))
    searched = F.coalesce("searched", F.lit(0))
    outcome = F.when(searched > 0, "searched").when(F.col("waiting") == 0, "idle").when(F.coalesce(F.col("is_blocked"), F.lit(False)), "blocked").otherwise("failed")
    rows = runs.select("stream", "at", "waiting", "empty", "found", searched.alias("searched"), F.when(told, outcome).otherwise("skipped").alias("outcome"))
    good = F.col("outcome").isin("searched", "idle")
    marked = rows.groupBy("stream").agg(
        F.max("at").alias("reported"),
        F.max_by("outcome", "at").alias("outcome"),
        F.max_by(F.col("waiting") - F.col("searched"), F.when((F.col("outcome") != "skipped") & F.col("waiting").isNotNull(), F.col("at"))).alias("queued"),
        F.max(F.when(F.col("outcome") == "searched", F.to_date("at"))).alias("last_searched"),
        F.max(F.when(good, F.col("at"))).alias("_good"),
    )
    stalls = rows.where(F.col("outcome").isin("blocked", "failed")).join(marked.select("stream", "_good"), "stream").where("_good is null or at > _good").groupBy("stream").agg(F.min(F.to_date("at")).alias("stalled_since"))
    newest = Window.partitionBy("stream").orderBy(F.desc("at"))
    batches = rows.where("outcome = 'searched'").withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= keep)
    entry = F.struct("at", F.concat_ws(":", F.date_format("at", "yyyy-MM-dd"), F.col("searched"), F.coalesce("empty", F.lit(0)), F.coalesce("found", F.lit(0))).alias("e"))
    batches = batches.groupBy("stream").agg(F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda x: x["e"]), ";").alias("batches"))
    return marked.drop("_good").join(stalls, "stream", "left").join(batches, "stream", "left").withColumn("batches", F.coalesce("batches", F.lit("")))

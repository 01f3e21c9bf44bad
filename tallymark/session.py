"""Session helpers: shared scratch tables, bounded broadcasts, table access."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of a side that is broadcast after its size was counted.
BROADCAST_ROWS = 20_000


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share, as named in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder, gone when the program
    ends; a cluster session without it is an error, because a machine's own folder would be
    lost with the machine.
    """
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tallymark-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return "file://" + _LOCAL[0]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table into the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives the loss of executors, and keeps
    columns compressed and prunable for the stages that read it again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` with the hint that its join goes by shuffle and merge.

    For sides that grow with the data. The planner takes a written table for as large as its
    compressed files and an exploded one for as large as it was before, so it would send tables
    through the driver that are many times its limit of a broadcast. A counted side on the other
    hand of the join (``small_side``) still broadcasts.
    """
    return df.hint("merge")


#: Plan nodes whose work should not be done once to count a table and once more to join it.
_WORK = re.compile(r"\b(?:Join|Aggregate|Window|Generate|Distinct|Deduplicate|RepartitionByExpression|MapInArrow|MapInPandas|FlatMapGroups\w*|ArrowEvalPython|Sort)\b")


def small_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``most`` rows.

    A table that takes more than a scan to compute is written first, so it is computed once. The
    count stops after ``most + 1`` rows. A larger side is returned without the hint, and the join
    then shuffles.
    """
    if _WORK.search(df._jdf.queryExecution().optimizedPlan().toString()):
        df = materialize(df, "side")
    n = df.limit(most + 1).count()
    return F.broadcast(df) if n <= most else df


#: A key with more than this share of all rows counts as hot; fewer than one in its inverse can be.
HOT_SHARE = 0.001


def spread_join(df: DataFrame, side: DataFrame, key: str, n: str) -> DataFrame:
    """``df`` left-joined with ``side``, which has one row per ``key`` and the number of df's rows of that key in ``n``.

    Keys with more than a thousandth of all rows, fewer than a thousand of them whatever the
    data, join by broadcast, so their rows stay where they are; the others join by shuffle.
    ``side`` should be a written table. A null key joins nothing. The column ``n`` is dropped.
    """
    total = side.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    hot = side.where(F.col(n) > total * HOT_SHARE)
    if not total or hot.isEmpty():
        return df.join(side.drop(n), key, "left")
    marked = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left").drop(n)
    rest = marked.where("_hot is null").select(*df.columns).join(side.where(F.col(n) <= total * HOT_SHARE).drop(n), key, "left")
    return marked.where("_hot").drop("_hot").unionByName(rest)

"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import itertools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "scorespark", *, master: str | None = None, **settings: str) -> SparkSession:
    """Session with UTC time and adaptive execution; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession) -> str:
    """Folder all executors share, as named by the session.

    A temporary folder is used only in local mode, where driver and executors
    are one process; on a cluster an unset folder is an error.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="scorespark-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{working_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, or to ``path``, and read it back.

    The result survives lost executors, is computed once however often it is
    used, and carries its real size, so that the optimizer broadcasts it in a
    join only when it is small enough and otherwise splits skewed partitions.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_by_key(df: DataFrame, key: str, name: str = "table", *, part_rows: int, most: int = 16) -> list[DataFrame]:
    """Write ``df`` once and read it back as one to ``most`` tables of about ``part_rows`` rows or more, each with all rows of its keys.

    Keys are dealt out by a hash.  What needs the rows of a key together, such
    as a join, can go through the tables one after the other and then has the
    shuffles of one of them on disk at a time.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(most)).cast("int"))
    dealt.write.parquet(path, partitionBy="_part", compression="zstd")
    stored = spark.read.schema(dealt.schema).parquet(path)
    n = max(1, min(most, -(-stored.count() // part_rows)))
    cuts = [i * most // n for i in range(n + 1)]
    return [stored.where(F.col("_part").between(a, b - 1)).drop("_part") for a, b in itertools.pairwise(cuts)]


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside gives its shuffle files back once it is written, rather than when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)

"""Reading transaction files and writing processed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.functions.columns import nan_to_null, parse_timestamp
from scorespark.schema import SOURCE_FILE, SOURCE_NAMES, TRANSACTIONS


def read_transactions(
    spark: SparkSession, path: str, *, fmt: str = "csv", strict_timestamps: bool = True
) -> DataFrame:
    """Transactions under our names and types, NaN read as NULL.

    ``csv`` files carry a header with the source names and are read with a
    fixed schema: a malformed line or a different header fails the job.
    ``parquet`` may carry either set of names.
    """
    if fmt == "csv":
        raw = (
            spark.read.schema(SOURCE_FILE)
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("enforceSchema", False)
            .csv(path)
        )
    else:
        raw = spark.read.format(fmt).load(path)
    named = raw.withColumnsRenamed({s: n for s, n in SOURCE_NAMES.items() if s in raw.columns})
    if dict(named.dtypes)["txn_ts"] == "string":
        named = named.withColumn("txn_ts", parse_timestamp("txn_ts", strict=strict_timestamps))
    typed = named.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTIONS.fields])
    return nan_to_null(typed)


def write_table(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    compression: str | None = None,
) -> None:
    """Write a processed table; ``compression`` is the format's usual one unless one is named.

    Rows are rebalanced on the partition columns first, so that a folder gets a
    few files of a good size and a large folder is still written by many tasks.
    """
    writer = df.hint("rebalance", *partition_by) if partition_by else df
    out = writer.write.mode(mode).format(fmt)
    if compression:
        out = out.option("compression", compression)
    if partition_by:
        out = out.partitionBy(*partition_by)
    if fmt == "csv":
        out = out.option("header", True)
    out.save(path)


def first_rows(df: DataFrame, *order: Column | str, n: int = 5) -> DataFrame:
    """First ``n`` rows in a given order; a top-k plan, not a full sort."""
    return df.orderBy(*order).limit(n)

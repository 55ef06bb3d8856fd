"""Shift of a categorical column between two periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.functions.columns import count_if

FLOOR = 1e-6  # share used for a value that a period lacks


def category_drift(df: DataFrame, column: str, *, before: Column, after: Column) -> DataFrame:
    """(value, share_before, share_after, psi_part); the parts sum to the stability index."""
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(count_if(before).alias("a"), count_if(after).alias("b"))
    )
    totals = counted.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b"))).scalar()
    shares = counted.withColumn("t", totals).select(
        "value",
        F.coalesce(F.try_divide(F.col("a"), F.col("t.a")), F.lit(0.0)).alias("share_before"),
        F.coalesce(F.try_divide(F.col("b"), F.col("t.b")), F.lit(0.0)).alias("share_after"),
    )
    p, q = F.greatest("share_before", F.lit(FLOOR)), F.greatest("share_after", F.lit(FLOOR))
    return shares.withColumn("psi_part", (q - p) * F.ln(q / p))


def stability_index(drift: DataFrame) -> DataFrame:
    return drift.agg(F.sum("psi_part").alias("psi"))

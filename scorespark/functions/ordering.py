"""Running totals over a table in a global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorespark.session import materialize

ROWS_PER_RANGE = 250_000
MOST_RANGES = 20_000  # bounds the broadcast list of ranges


def running_totals(df: DataFrame, order: list[str], weight: Column, name: str, *, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all rows up to and including this one.

    ``order`` must identify rows.  Ranges of the order are summed on their own
    and shifted by the total of the ranges before; only the list of ranges, one
    row each, is ever ordered as a whole.
    """
    rows = df.count()
    ranges = min(max(1, -(-rows // rows_per_range)), MOST_RANGES)
    ranged = materialize(
        df.withColumn("_w", weight).repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    totals = ranged.groupBy("_range").agg(F.sum("_w").alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_shift"))
    inner = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(shifts), "_range")
        .withColumn(name, F.sum("_w").over(inner) + F.col("_shift"))
        .drop("_range", "_w", "_shift")
    )

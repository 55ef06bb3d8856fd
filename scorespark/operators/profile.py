"""Profiles of a table: counts, summaries, correlation, missing values, time patterns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorespark.functions.columns import (
    as_number,
    categorical_columns,
    count_if,
    numeric_columns,
    parse_timestamp,
    rows_from_wide,
)
from scorespark.functions.quantiles import exact_quantiles, stored_numbers
from scorespark.schema import ID_COLUMNS

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def overview(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows, non-null values."""
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(df.columns)])
    rows = [
        {
            "position": F.lit(i + 1),
            "variable": F.lit(c),
            "dtype": F.lit(t),
            "n_rows": F.col("n_rows"),
            "n_values": F.col(f"n_{i}"),
        }
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return rows_from_wide(counts, rows)


def describe(df: DataFrame, *, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per numeric column.

    The median is ``q50``.  The columns are stored once, for the quartiles and
    the other numbers alike.
    """
    columns = list(columns if columns is not None else numeric_columns(df))
    numbers = stored_numbers(df, columns)
    quartiles = exact_quantiles(numbers, numbers.columns, [0.25, 0.5, 0.75], cut=False)
    stats = (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    wide = numbers.agg(*[f(F.col(x)).alias(f"{s}_{i}") for i, x in enumerate(numbers.columns) for s, f in stats])
    rows = []
    for i, c in enumerate(columns):
        entry = {"variable": F.lit(c), **{s: F.col(f"{s}_{i}") for s, _ in stats}}
        entry.update({f"q{p}": F.lit(v).cast("double") for p, v in zip((25, 50, 75), quartiles[f"x{i}"])})
        rows.append(entry)
    return rows_from_wide(wide, rows)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Values and their frequencies, most frequent first, ties by value."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), column)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, NULL included."""
    return df.select(column).distinct()


def cardinality(df: DataFrame, *, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column; the approximate form needs no shuffle of values."""
    columns = list(columns if columns is not None else df.columns)
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(columns)])
        return rows_from_wide(wide, [{"variable": F.lit(c), "n_values": F.col(f"d_{i}")} for i, c in enumerate(columns)])
    # Columns under one another as (number, text): a narrower key than one distinct
    # aggregate per column, whose expanded rows carry every column.
    kinds = dict(df.dtypes)
    texts = [(F.col(c) + 0.0 if kinds[c] in ("double", "float") else F.col(c)).cast("string").alias(f"c{i}") for i, c in enumerate(columns)]
    names = {f"c{i}": c for i, c in enumerate(columns)}
    long = df.select(*texts).unpivot([], list(names), "series", "value")
    counted = long.groupBy("series", "value").agg(F.count(F.lit(1)).alias("n")).groupBy("series").agg(F.count("value").alias("n_values"))
    title = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return counted.select(title[F.col("series")].alias("variable"), "n_values")


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values: how many and what percentage."""
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(df.columns)])
    gap = [F.col("n") - F.col(f"n_{i}") for i in range(len(df.columns))]
    rows = [
        {"variable": F.lit(c), "n_missing": g, "percent": F.try_divide(g * 100.0, F.col("n"))}
        for c, g in zip(df.columns, gap)
    ]
    return rows_from_wide(wide, rows).where(F.col("n_missing") > 0)


def correlation(df: DataFrame, *, columns: Sequence[str] | None = None, exclude: Iterable[str] = (*ID_COLUMNS, "country_code")) -> DataFrame:
    """Pearson correlation of every ordered pair of numeric columns, in one pass, two if values are missing.

    Each pair uses the rows where both values are present.  A constant column
    correlates with nothing (NULL).  Fewer than two columns give no rows.
    """
    skip = set(exclude)
    names = [c for c in (columns if columns is not None else numeric_columns(df)) if c not in skip]
    schema = "x string, y string, correlation double"
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], schema)
    numbers = [as_number(c) for c in names]
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, x in enumerate(numbers):
        aggregates += [F.count(x).alias(f"n_{i}"), F.stddev_pop(x).alias(f"d_{i}")]
    pairs = list(combinations(range(len(names)), 2))
    aggregates += [F.covar_pop(numbers[i], numbers[j]).alias(f"c_{i}_{j}") for i, j in pairs]
    row = df.agg(*aggregates).first()
    # The deviations of whole columns serve every pair without gaps; the others get their own.
    complete = {i for i in range(len(names)) if row[f"n_{i}"] == row["n"]}
    gappy = [(i, j) for i, j in pairs if not {i, j} <= complete]
    spread = {(i, j): (row[f"d_{i}"] or 0.0) * (row[f"d_{j}"] or 0.0) for i, j in pairs}
    if gappy:
        own = []
        for i, j in gappy:
            x, y = numbers[i], numbers[j]
            own.append((F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))).alias(f"s_{i}_{j}"))
        found = df.agg(*own).first()
        spread.update({(i, j): found[f"s_{i}_{j}"] or 0.0 for i, j in gappy})
    r = {}
    for i, j in pairs:
        r[i, j] = r[j, i] = row[f"c_{i}_{j}"] / spread[i, j] if spread[i, j] else None
    for i in range(len(names)):
        r[i, i] = 1.0 if row[f"d_{i}"] else None
    rows = [(a, b, r[i, j]) for i, a in enumerate(names) for j, b in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, schema)


def _moment(df: DataFrame, ts: str):
    return parse_timestamp(ts, strict=False) if dict(df.dtypes)[ts] == "string" else F.col(ts)


def parsed_moments(df: DataFrame, *, ts: str = "txn_ts", out: str = "txn_ts") -> DataFrame:
    """Rows whose timestamp can be read; others are left out rather than failing."""
    return df.withColumn(out, _moment(df, ts)).where(F.col(out).isNotNull())


def hourly_counts(df: DataFrame, *, ts: str = "txn_ts") -> DataFrame:
    """Rows per hour of day, hours that occur only."""
    return df.groupBy(F.hour(_moment(df, ts)).alias("hour")).agg(F.count(F.lit(1)).alias("n")).where("hour is not null").orderBy("hour")


def weekday_counts(df: DataFrame, *, ts: str = "txn_ts") -> DataFrame:
    """Rows per weekday, Monday to Sunday, 0 where none."""
    day = F.weekday(_moment(df, ts))
    wide = df.agg(*[count_if(day == i).alias(name) for i, name in enumerate(WEEKDAYS)])
    rows = [{"position": F.lit(i + 1), "weekday": F.lit(name), "n": F.col(name)} for i, name in enumerate(WEEKDAYS)]
    return rows_from_wide(wide, rows)


def daily_counts(df: DataFrame, *, ts: str = "txn_ts") -> DataFrame:
    """Rows per calendar day (its midnight), days that occur only."""
    day = _moment(df, ts).cast("date").cast("timestamp_ntz").alias("day")
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("n")).where("day is not null").orderBy("day")


def top_categories(
    df: DataFrame, *, top: int = 10, exclude: Iterable[str] = ("transaction_id", "batch_id", "subscription_id")
) -> DataFrame:
    """Most frequent values of every string column outside ``exclude``, ties by value.

    All columns are counted together; the rank filter also runs before the
    shuffle, so a column with very many values sends ``top`` rows per task.
    """
    columns = categorical_columns(df, exclude)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "variable", "value")
    counted = long.where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("variable").orderBy(F.desc("n"), "value"))
    return counted.withColumn("position", rank).where(F.col("position") <= top)

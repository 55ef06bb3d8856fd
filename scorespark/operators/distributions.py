"""Data behind histograms and density curves."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.functions.columns import as_number, numeric_columns

LINEAR_BINS = 15
LOG_BINS = 30
DENSITY_BINS = 100  # a bandwidth
DENSITY_REACH = 8  # bandwidths; beyond, the kernel is below 1e-14
# Numeric columns that are categories or are shown by sign instead.
NOT_LOGGED = ("fraud_result", "pricing_strategy", "country_code", "amount")


def _histogram(df: DataFrame, series: dict[str, Column], bins: int) -> DataFrame:
    """Equal-width counts of several series: (variable, bin, lower, upper, n), occupied bins only.

    Intervals are closed on the left, the last one on both sides.  The extremes
    are two numbers a series; a row is stacked as small integers.
    """
    names = list(series)
    spark = df.sparkSession
    empty = spark.createDataFrame([], "variable string, bin int, lower double, upper double, n bigint")
    if not names:
        return empty
    row = df.agg(*[f(series[c]).alias(f"{p}{i}") for i, c in enumerate(names) for p, f in (("a", F.min), ("b", F.max))]).first()
    limits = {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(names) if row[f"a{i}"] is not None}
    if not limits:
        return empty
    edges, placed = [], []
    for i, (c, (low, high)) in enumerate(limits.items()):
        # A constant series gets one unit of width around its value.
        low, high = (low - 0.5, high + 0.5) if low == high else (low, high)
        width = (high - low) / bins
        edges += [(c, b, low + b * width, high if b == bins - 1 else low + (b + 1) * width) for b in range(bins)]
        place = F.least(F.floor((series[c] - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        placed.append(F.when(series[c].isNotNull(), place).alias(f"p{i}"))  # least() would skip a NULL
    names = list(limits)
    wide = df.select(*placed).withColumnsRenamed({f"p{i}": c for i, c in enumerate(names)})
    counted = (
        wide.unpivot([], names, "variable", "bin")
        .where(F.col("bin").isNotNull())
        .groupBy("variable", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    table = spark.createDataFrame(edges, "variable string, bin int, lower double, upper double")
    return counted.join(F.broadcast(table), ["variable", "bin"]).select("variable", "bin", "lower", "upper", "n")


def histogram(df: DataFrame, *, columns: Sequence[str] | None = None, bins: int = LINEAR_BINS) -> DataFrame:
    columns = columns if columns is not None else numeric_columns(df)
    return _histogram(df, {c: as_number(c) for c in columns}, bins)


def _log(x: Column) -> Column:
    return F.when(x > 0, F.log10(x))


def log_histogram(df: DataFrame, *, columns: Sequence[str] | None = None, bins: int = LOG_BINS) -> DataFrame:
    """Histogram of log10; values that are not positive have no place on the axis."""
    columns = columns if columns is not None else numeric_columns(df, NOT_LOGGED)
    return _histogram(df, {c: _log(as_number(c)) for c in columns}, bins)


def credit_debit_histogram(df: DataFrame, *, amount: str = "amount", bins: int = LOG_BINS) -> DataFrame:
    """Log histograms of the magnitudes of credits and of debits."""
    x = as_number(amount)
    return _histogram(df, {"credit": _log(-x), "debit": _log(x)}, bins)


def density_curves(df: DataFrame, series: dict[str, Column], *, points: int = 50) -> DataFrame:
    """Gaussian kernel densities of several series at evenly spaced points: (series, point, x, density).

    Two passes over the rows, whatever the number of series: one for count,
    deviation and extremes, one that merges rows into bins.  Bandwidth is
    deviation * n^(-1/5), a bin a hundredth of it, and only bins with rows exist,
    however long the tails.  A bin stands at the mean of its rows and carries
    their variance as a second order term, so the sum is that over the rows to
    about 1e-7.  It is sent to the points within reach only.  Series without
    two different values have no density.
    """
    spark = df.sparkSession
    empty = spark.createDataFrame([], "series string, point int, x double, density double")
    if not series:
        return empty
    named = [(f"_{i}", c) for i, c in enumerate(series.values())]
    values = df.select(*[c.alias(n) for n, c in named])
    measured = values.agg(*[f(n).alias(f"{p}{n}") for n, _ in named for p, f in (("n", F.count), ("s", F.stddev_samp), ("a", F.min), ("b", F.max))]).first()
    known = [(name, n, measured[f"n{n}"], measured[f"s{n}"], measured[f"a{n}"], measured[f"b{n}"]) for name, (n, _) in zip(series, named) if measured[f"s{n}"]]
    if not known:
        return empty
    width = {n: std * count ** (-0.2) for _, n, count, std, _, _ in known}
    rows = [(i, name, float(low), float((high - low) / (points - 1)), width[n], count * width[n] * sqrt(2 * pi)) for i, (name, n, count, _, low, high) in enumerate(known)]
    # Few numbers a series, so they are literals, found by the place of the series.
    low, step, wide, scale = (F.array(*[F.lit(r[k]) for r in rows])[F.col("s")] for k in (2, 3, 4, 5))
    cell = wide / DENSITY_BINS
    stacked = F.explode(F.array(*[F.struct(F.lit(i).alias("s"), F.col(n).alias("v")) for i, (_, n, *_) in enumerate(known)])).alias("p")
    placed = values.select(stacked).select("p.*").where(F.col("v").isNotNull())
    # Deviations from the middle of the bin keep the variance free of cancellation.
    placed = placed.withColumn("bin", F.floor((F.col("v") - low) / cell))
    off = F.col("v") - (low + (F.col("bin") + 0.5) * cell)
    bins = placed.groupBy("s", "bin").agg(F.count(F.lit(1)).alias("n"), F.avg(off).alias("off"), F.var_pop(off).alias("spread"))
    center = low + (F.col("bin") + 0.5) * cell + F.col("off")
    first = F.greatest(F.ceil((center - DENSITY_REACH * wide - low) / step), F.lit(0))
    last = F.least(F.floor((center + DENSITY_REACH * wide - low) / step), F.lit(points - 1))
    near = F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>")))
    z = (low + F.col("point") * step - F.col("center")) / wide
    mass = F.col("n") * F.exp(-0.5 * z * z) * (1 + (z * z - 1) * F.col("spread") / (2 * wide * wide)) / scale
    sums = bins.select("s", "n", "spread", center.alias("center"), near.alias("point")).groupBy("s", "point").agg(F.sum(mass).alias("density"))
    names = spark.createDataFrame([(i, name) for i, name, *_ in rows], "s int, series string")
    grid = names.select("s", "series", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(points - 1).cast("bigint"))).alias("point")).withColumn("x", low + F.col("point") * step)
    return grid.join(sums, ["s", "point"], "left").select("series", F.col("point").cast("int").alias("point"), "x", F.coalesce("density", F.lit(0.0)).alias("density"))


def density_curve(df: DataFrame, column: str, *, points: int = 50) -> DataFrame:
    """Density of one column: (point, x, density)."""
    return density_curves(df, {column: as_number(column)}, points=points).drop("series")


def all_densities(df: DataFrame, *, columns: Sequence[str] | None = None, amount: str | None = "amount", points: int = 50) -> DataFrame:
    """Densities of every numeric column on its own axis, and on the log axis where values are magnitudes: (variable, axis, point, x, density).

    On the log axis stand the positive values of the columns that are not
    categories, and credits and debits of ``amount`` by magnitude.
    """
    columns = list(columns if columns is not None else numeric_columns(df))
    series = {f"{c} plain": as_number(c) for c in columns}
    series |= {f"{c} log": _log(as_number(c)) for c in columns if c not in NOT_LOGGED}
    if amount is not None and amount in df.columns:
        series |= {"credit log": _log(-as_number(amount)), "debit log": _log(as_number(amount))}
    curves = density_curves(df, series, points=points)
    parts = F.split("series", " (?=[a-z]+$)")
    return curves.select(parts[0].alias("variable"), parts[1].alias("axis"), "point", "x", "density")


def score_scatter(scored: DataFrame, *, x: str = "rfms_score", y: str = "monetary_score") -> DataFrame:
    """Distinct score pairs and how many customers share them."""
    return scored.groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))

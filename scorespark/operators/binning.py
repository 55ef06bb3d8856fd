"""Quantile bins of numeric columns and the choice of categorical columns to bin."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.functions.columns import as_number, categorical_columns, numeric_columns
from scorespark.functions.quantiles import exact_quantiles, group_number, grouped_quantiles

MOST_CATEGORIES = 10
MOST_SEGMENTS = 50
BITMAP_BITS = 32_768  # size of Spark's bitmap aggregate


def _levels(n_bins: int) -> list[float]:
    # Multiples of one step, as evenly spaced grids are computed: 3 * 0.2 is not 0.6, and
    # where a rank falls on a value exactly the last bit decides whether an edge is new.
    return [*(i * (1.0 / n_bins) for i in range(n_bins)), 1.0]


def _distinct(quantiles: Iterable[float | None]) -> list[float]:
    return sorted({e for e in quantiles if e is not None})


@dataclass(frozen=True)
class QuantileBins:
    """Sorted distinct edges per column; a column with one edge or none has no bins."""

    edges: dict[str, list[float]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str] | None = None, *, n_bins: int = 5, ignore: Iterable[str] = (), cut: bool = True) -> QuantileBins:
        """``cut=False`` if the rows of ``df`` are already stored."""
        skip = set(ignore)
        columns = [c for c in (columns if columns is not None else numeric_columns(df)) if c not in skip]
        found = exact_quantiles(df, columns, _levels(n_bins), cut=cut)
        return cls({c: _distinct(found[c]) for c in columns})

    @property
    def binned(self) -> list[str]:
        return [c for c, edges in self.edges.items() if len(edges) >= 2]

    @property
    def by(self) -> list[str]:
        return []

    @property
    def most_bins(self) -> int:
        return max((len(edges) for edges in self.edges.values()), default=0)

    def assign(self, column: str, value: Column | None = None) -> Column:
        """Bin 1..k, intervals closed on the right, the lowest value included; NULL outside."""
        edges = self.edges[column]
        x = as_number(value if value is not None else column)
        if len(edges) < 2:
            return F.lit(None).cast("int")
        above = sum((F.when(x > e, 1).otherwise(0) for e in edges[1:-1]), F.lit(1))
        return F.when((x >= edges[0]) & (x <= edges[-1]), above)

    def table(self, spark: SparkSession) -> DataFrame:
        """(variable, bin_id, lower, upper, label), a few rows per column."""
        rows = [
            (c, i + 1, lo, hi, f"({lo:.{places}f}, {hi:.{places}f}]")
            for c, edges in self.edges.items()
            for places in (_places(edges),)
            for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
        ]
        return spark.createDataFrame(rows, "variable string, bin_id int, lower double, upper double, label string")


@dataclass(frozen=True)
class SegmentBins:
    """Edges of each column in each segment; ``edges`` is keyed by segment, then column.

    Segments are the values of a column with few of them.  All segments and
    columns are searched in the same jobs, each row with the bounds of its segment.
    """

    segment: str
    edges: dict[str, dict[str, list[float]]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], *, segment: str, n_bins: int = 5, most: int = MOST_SEGMENTS, cut: bool = True) -> SegmentBins:
        """``cut=False`` if the rows of ``df`` are already stored.  More than ``most`` segments are an error: their edges would no longer be a handful of literals."""
        found = df.where(F.col(segment).isNotNull()).select(F.col(segment).cast("string").alias("s")).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{segment} has more than {most} values")
        segments = sorted(r["s"] for r in found)
        quantiles = grouped_quantiles(df, columns, _levels(n_bins), by=segment, groups=segments, cut=cut)
        edges = {s: {c: _distinct(own) for c, own in found.items()} for s, found in quantiles.items()}
        return cls(segment, edges)

    @property
    def binned(self) -> list[str]:
        return list(dict.fromkeys(c for own in self.edges.values() for c, e in own.items() if len(e) >= 2))

    @property
    def by(self) -> list[str]:
        return [self.segment]

    @property
    def most_bins(self) -> int:
        return max((len(edges) for own in self.edges.values() for edges in own.values()), default=0)

    def assign(self, column: str, value: Column | None = None) -> Column:
        """Bin within the row's segment; NULL outside and where a segment has no bins."""
        found = [own.get(column, []) for own in self.edges.values()]
        if not any(len(edges) >= 2 for edges in found):
            return F.lit(None).cast("int")
        at = group_number(self.segment, list(self.edges))
        x = as_number(value if value is not None else column)

        def edge(k: int, least: int) -> Column:
            """The segment's edge ``k``, NULL if it has no more than ``least``."""
            return F.get(F.array(*[F.lit(edges[k] if len(edges) > least else None).cast("double") for edges in found]), at)

        most = max(len(edges) for edges in found)
        above = sum((F.when(x > edge(k, k + 1), 1).otherwise(0) for k in range(1, most - 1)), F.lit(1))
        return F.when((x >= edge(0, 1)) & (x <= edge(-1, 1)), above)

    def table(self, spark: SparkSession) -> DataFrame:
        """(segment, variable, bin_id, lower, upper, label), a few rows per segment and column."""
        columns = f"`{self.segment}` string, variable string, bin_id int, lower double, upper double, label string"
        rows = [
            (s, c, i + 1, lo, hi, f"({lo:.{places}f}, {hi:.{places}f}]")
            for s, own in self.edges.items()
            for c, edges in own.items()
            for places in (_places(edges),)
            for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
        ]
        return spark.createDataFrame(rows, columns)


def _places(edges: Sequence[float], least: int = 3, most: int = 17) -> int:
    """Decimals, three or more, with which all edges read differently."""
    return next((p for p in range(least, most) if len({f"{e:.{p}f}" for e in edges}) == len(edges)), most)


def _not_obviously_many(df: DataFrame, columns: Sequence[str], most: int) -> list[str]:
    """Columns whose values hit at most ``most`` places of a hashed bitmap.

    Equal values hit equal places, so a column with more places has more values
    for certain.  One pass, a few kilobytes per column and task, no shuffle of values.
    """
    places = [
        F.bitmap_count(F.bitmap_construct_agg(F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(c), F.lit(BITMAP_BITS))))).alias(f"p{i}")
        for i, c in enumerate(columns)
    ]
    if not places:
        return []
    row = df.agg(*places).first()
    return [c for i, c in enumerate(columns) if (row[i] or 0) <= most]


def categorical_bin_columns(df: DataFrame, *, columns: Sequence[str] | None = None, ignore: Iterable[str] = (), most: int = MOST_CATEGORIES) -> DataFrame:
    """(variable, n_values) of the string columns with at most ``most`` distinct values."""
    skip = set(ignore)
    columns = [c for c in (columns if columns is not None else categorical_columns(df)) if c not in skip]
    few = _not_obviously_many(df, columns, most)
    if not few:
        return df.sparkSession.createDataFrame([], "variable string, n_values bigint")
    counted = df.agg(*[F.count_distinct(c).alias(c) for c in few])
    return counted.unpivot([], few, "variable", "n_values").where(F.col("n_values") <= most)

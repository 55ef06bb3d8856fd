"""Standardising numeric columns with stored parameters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.functions.columns import as_number, numeric_columns


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column: two numbers a column, so literals in the plan."""

    parameters: dict[str, tuple[float | None, float | None]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str] | None = None, *, weight: str | None = None) -> Scaler:
        """Parameters over the rows of ``df``, each standing for ``weight`` rows if given."""
        columns = list(columns if columns is not None else numeric_columns(df))
        if not columns:
            return cls({})
        numbers = [as_number(c) for c in columns]
        if weight is None:
            row = df.agg(*[f(x).alias(f"{p}{i}") for i, x in enumerate(numbers) for p, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
            return cls({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)})
        w = F.col(weight)
        share = [F.sum(F.when(x.isNotNull(), w)) for x in numbers]
        means = df.agg(*[F.try_divide(F.sum(x * w), n) for x, n in zip(numbers, share)]).first()
        spread = df.agg(
            *[F.sqrt(F.try_divide(F.sum((x - F.lit(m)) * (x - F.lit(m)) * w), n)) for x, n, m in zip(numbers, share, means)]
        ).first()
        return cls({c: (means[i], spread[i]) for i, c in enumerate(columns)})

    @classmethod
    def from_table(cls, table: DataFrame) -> Scaler:
        return cls({r["variable"]: (r["mean"], r["std"]) for r in table.collect()})

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, m, s) for c, (m, s) in self.parameters.items()]
        return spark.createDataFrame(rows, "variable string, mean double, std double")

    def transform(self, df: DataFrame) -> DataFrame:
        """(x - mean) / deviation; a constant column is only centred, NULL stays NULL."""
        scaled = {}
        for c, (mean, std) in self.parameters.items():
            if c in df.columns:
                if mean is None:
                    scaled[c] = F.lit(None).cast("double")
                else:
                    scaled[c] = (as_number(c) - F.lit(mean)) / F.lit(std if std else 1.0)
        return df.withColumns(scaled)

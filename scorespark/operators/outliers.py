"""Outliers by distance from the quartiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.functions.columns import as_number, count_if, rows_from_wide
from scorespark.functions.quantiles import exact_quantiles

FENCE = 1.5


@dataclass(frozen=True)
class Fences:
    """Quartiles of a column and the limits 1.5 quartile distances beyond them."""

    q1: float
    q3: float

    @property
    def low(self) -> float:
        return self.q1 - FENCE * (self.q3 - self.q1)

    @property
    def high(self) -> float:
        return self.q3 + FENCE * (self.q3 - self.q1)


def fences(df: DataFrame, *columns: str) -> dict[str, Fences | None]:
    found = exact_quantiles(df, columns, [0.25, 0.75])
    return {c: None if q[0] is None else Fences(*q) for c, q in found.items()}


def _summary(df: DataFrame, parts: list[tuple[str, Column, Column, float | None, float | None]]) -> DataFrame:
    """``parts``: name, rows of the part, outliers among them, lower and upper limit."""
    wide = df.agg(
        *[a for i, (_, rows, out, _, _) in enumerate(parts) for a in (count_if(rows).alias(f"n_{i}"), count_if(rows & out).alias(f"o_{i}"))]
    )
    return rows_from_wide(
        wide,
        [
            {
                "part": F.lit(name),
                "n_rows": F.col(f"n_{i}"),
                "n_outliers": F.col(f"o_{i}"),
                "percent": F.try_divide(F.col(f"o_{i}") * 100.0, F.col(f"n_{i}")),
                "lower": F.lit(low).cast("double"),
                "upper": F.lit(high).cast("double"),
            }
            for i, (name, _, _, low, high) in enumerate(parts)
        ],
    )


def value_outliers(df: DataFrame, *, value: str = "value") -> DataFrame:
    """Rows outside both fences of a column; percent is of all rows."""
    f = fences(df, value)[value]
    x = as_number(value)
    if f is None:
        return _summary(df, [(value, F.lit(True), F.lit(False), None, None)])
    return _summary(df, [(value, F.lit(True), (x < f.low) | (x > f.high), f.low, f.high)])


def amount_outliers(df: DataFrame, *, amount: str = "amount") -> DataFrame:
    """Debits above their upper fence and credits below their lower one; percent is of each part.

    A part without rows is left out.
    """
    x = as_number(amount)
    split = df.withColumns({"_debit": F.when(x >= 0, x), "_credit": F.when(x < 0, x)})
    found = fences(split, "_debit", "_credit")
    parts = []
    if found["_debit"]:
        high = found["_debit"].high
        parts.append(("debit", x >= 0, x > high, None, high))
    if found["_credit"]:
        low = found["_credit"].low
        parts.append(("credit", x < 0, x < low, low, None))
    return _summary(df, parts)


def top_outliers(df: DataFrame, *, value: str = "value", k: int = 5) -> DataFrame:
    """The ``k`` highest rows outside the fences."""
    f = fences(df, value)[value]
    x = as_number(value)
    outside = F.lit(False) if f is None else (x < f.low) | (x > f.high)
    return (
        df.where(outside)
        .orderBy(F.desc(value), "transaction_id")
        .limit(k)
        .select("transaction_id", value, "product_category")
    )


def boxplot_stats(df: DataFrame, *columns: str) -> DataFrame:
    """Quartiles, whiskers (most extreme value inside the fences) and outlier count per column."""
    found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    known = {c: q for c, q in found.items() if q[0] is not None}
    aggregates, rows = [], []
    for i, (c, (q1, q2, q3)) in enumerate(known.items()):
        f, x = Fences(q1, q3), as_number(c)
        inside = F.when((x >= f.low) & (x <= f.high), x)
        aggregates += [
            F.min(inside).alias(f"a_{i}"),
            F.max(inside).alias(f"b_{i}"),
            count_if((x < f.low) | (x > f.high)).alias(f"o_{i}"),
        ]
        rows.append(
            {
                "variable": F.lit(c),
                "q25": F.lit(q1),
                "q50": F.lit(q2),
                "q75": F.lit(q3),
                "whisker_low": F.col(f"a_{i}"),
                "whisker_high": F.col(f"b_{i}"),
                "n_outliers": F.col(f"o_{i}"),
            }
        )
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "variable string, q25 double, q50 double, q75 double, whisker_low double, whisker_high double, n_outliers bigint"
        )
    return rows_from_wide(df.agg(*aggregates), rows)

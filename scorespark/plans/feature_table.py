"""The whole feature table: date parts, complete rows, customer aggregates, scaling, codes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.functions.columns import as_number, categorical_columns, numeric_columns
from scorespark.operators import features
from scorespark.operators.encoding import LabelEncoder
from scorespark.operators.joins import attach
from scorespark.operators.scaling import Scaler
from scorespark.schema import ID_COLUMNS
from scorespark.session import materialize


@dataclass(frozen=True)
class FeatureTable:
    rows: DataFrame
    scaler: Scaler
    encoder: LabelEncoder


def build_feature_table(
    transactions: DataFrame,
    *,
    scale: Sequence[str] | None = None,
    encode: Sequence[str] | None = None,
    key: str = "customer_id",
) -> FeatureTable:
    """Features with the fitted scaler and encoder; rows of transactions are never stored.

    Rows are dropped before the customer aggregates, so a customer with one
    transaction keeps an empty deviation.  One scan makes a row per customer: its
    aggregates, and count, mean and variance of every number.  Mean and deviation
    over all rows follow from those: a column of the transactions from the
    customers' moments, a column of the customers from their number of rows.
    """
    complete = features.drop_incomplete(features.add_date_parts(transactions))
    aggregates = features.customer_aggregates(complete.limit(0), key=key).columns
    joined = [c for c in aggregates if c != key]
    scale = list(scale if scale is not None else [*numeric_columns(complete), *joined])
    encode = list(encode if encode is not None else categorical_columns(complete, exclude=ID_COLUMNS))
    own = [c for c in scale if c not in joined]
    moments = [f(as_number(c)).alias(f"{p}_{i}") for i, c in enumerate(own) for p, f in (("_n", F.count), ("_m", F.avg), ("_v", F.var_pop))]
    customers = materialize(complete.groupBy(key).agg(*features.amount_measures(), *moments, F.count(F.lit(1)).alias("_rows")), "customers")
    scaler = Scaler({**_pooled(customers, own), **Scaler.fit(customers, [c for c in scale if c in joined], weight="_rows").parameters})
    encoder = LabelEncoder.fit(complete, encode)
    # Ids other than the key become numbers before the join, whose shuffle then carries no texts for them.
    early = [c for c in ID_COLUMNS if c != key and c not in scale]
    rows = attach(features.parse_id_columns(complete, columns=early), customers.select(*aggregates), key, cut=False)
    late = [c for c in ID_COLUMNS if c not in early]
    return FeatureTable(encoder.transform(features.parse_id_columns(scaler.transform(rows), columns=late), encode), scaler, encoder)


def _pooled(groups: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population deviation over all rows from count, mean and variance of each group."""
    if not columns:
        return {}
    places = range(len(columns))
    means = groups.agg(*[F.try_divide(F.sum(F.col(f"_n_{i}") * F.col(f"_m_{i}")), F.sum(f"_n_{i}")) for i in places]).first()
    spread = lambda i: F.col(f"_n_{i}") * (F.col(f"_v_{i}") + (F.col(f"_m_{i}") - F.lit(means[i])) ** 2)
    deviations = groups.agg(*[F.sqrt(F.try_divide(F.sum(spread(i)), F.sum(f"_n_{i}"))) for i in places]).first()
    return {c: (means[i], deviations[i]) for i, c in enumerate(columns)}

"""Recency, frequency, monetary value and stability per customer, scores and labels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.functions.columns import as_number

# Weights of the four scores, and the share of customers up to the label's boundary.
DEFAULT_WEIGHTS = (0.1, 0.2, 0.5, 0.2)
LABEL_QUANTILE = 0.55

# (measure, score, does a high measure mean a high score)
MEASURES = (
    ("recency", "recency_score", False),
    ("frequency", "frequency_score", True),
    ("monetary", "monetary_score", True),
    ("std_deviation", "std_score", False),
)


def _moment(as_of: str | dt.datetime | Column | None) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if as_of is None:
        as_of = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(str(as_of)).cast("timestamp_ntz")


def recency_days(latest: Column, as_of: str | dt.datetime | Column | None = None) -> Column:
    """Whole days from ``latest`` to ``as_of`` (now, in UTC, if not given), rounded down."""
    # Wall-clock difference: unlike timestampdiff it does not depend on the session's time zone.
    gap = _moment(as_of) - latest.cast("timestamp_ntz")
    days = F.extract(F.lit("DAY"), gap)  # cut towards zero
    return (days - F.when(gap < F.make_dt_interval(days=days), 1).otherwise(0)).cast("bigint")


def rfms_measures(
    *, as_of=None, ts: str = "txn_ts", transaction: str = "transaction_id", value: str = "value"
) -> list[Column]:
    """The four aggregates, to be used in a ``groupBy(...).agg``."""
    return [
        recency_days(F.max(ts), as_of).alias("recency"),
        F.count(transaction).alias("frequency"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("monetary"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std_deviation"),
    ]


def customer_rfms(transactions: DataFrame, *, key: str = "customer_id", **options) -> DataFrame:
    """One row per customer.  Partial aggregation precedes the only shuffle, so a
    customer with most of the rows costs one small record per task."""
    return transactions.where(F.col(key).isNotNull()).groupBy(key).agg(*rfms_measures(**options))


def equal_width_score(x: Column, low: Column, high: Column, *, ascending: bool = True, bins: int = 5) -> Column:
    """Score 1..bins over right-closed intervals of equal width; one value only scores the middle."""
    step = (high - low) / F.lit(bins)
    above = sum((F.when(x > low + F.lit(float(i)) * step, 1).otherwise(0) for i in range(1, bins)), F.lit(1))
    score = F.when(x.isNull(), F.lit(None).cast("int")).when(low == high, (bins + 1) // 2).otherwise(above)
    return score if ascending else F.lit(bins + 1) - score


def _quantile_score(x: Column, edges: Column, *, ascending: bool, bins: int = 5) -> Column:
    above = sum((F.when(x > F.get(edges, F.lit(i)), 1).otherwise(0) for i in range(1, bins)), F.lit(1))
    score = F.when(x.isNotNull(), above)
    return score if ascending else F.lit(bins + 1) - score


def score_rfms(
    rfms: DataFrame, *, weights: Sequence[float] = DEFAULT_WEIGHTS, method: str = "equal_width"
) -> DataFrame:
    """Add the four 1..5 scores and their weighted sum.

    The bounds come from a scalar subquery over ``rfms``; Spark reuses the
    shuffle of the customer aggregate for it.  The sum is rounded to ten places
    because equal sums of weights can differ in their last bit.

    ``method="quantile"`` scores by quintile instead; its edges are exact and
    are found before the plan is returned.
    """
    scores = {}
    source = rfms
    if method == "equal_width":
        bounds = rfms.agg(
            F.struct(
                *[f(as_number(m)).alias(f"{m}_{f.__name__}") for m, _, _ in MEASURES for f in (F.min, F.max)]
            ).alias("b")
        ).scalar()
        # Named once and then read: every mention of a subquery is planned on its own.
        source = rfms.withColumn("_bounds", bounds)
        for measure, score, ascending in MEASURES:
            low, high = F.col(f"_bounds.{measure}_min"), F.col(f"_bounds.{measure}_max")
            scores[score] = equal_width_score(as_number(measure), low, high, ascending=ascending)
    elif method == "quantile":
        from scorespark.functions.quantiles import exact_quantiles

        edges = exact_quantiles(rfms, [m for m, _, _ in MEASURES], [0, 0.2, 0.4, 0.6, 0.8, 1])
        for measure, score, ascending in MEASURES:
            literal = F.array(*[F.lit(e).cast("double") for e in edges[measure]])
            scores[score] = _quantile_score(as_number(measure), literal, ascending=ascending)
    else:
        raise ValueError(f"unknown scoring method {method!r}")
    scored = source.withColumns({name: s.cast("double") for name, s in scores.items()}).drop("_bounds")
    total = sum((F.col(s) * F.lit(float(w)) for (_, s, _), w in zip(MEASURES, weights)), F.lit(0.0))
    return scored.withColumn("rfms_score", F.round(total, 10))


def label_boundary(scored: DataFrame, *, score_column: str = "rfms_score", q: float = LABEL_QUANTILE) -> DataFrame:
    """One row, one column ``boundary``.

    ``percentile`` keeps distinct values; a score of four parts from 1 to 5 has
    at most 625 of them however many customers there are.
    """
    return scored.agg(F.percentile(score_column, F.lit(q)).alias("boundary"))


def label_scores(
    scored: DataFrame,
    *,
    score_column: str = "rfms_score",
    q: float = LABEL_QUANTILE,
    boundary: float | None = None,
    strict: bool = False,
) -> DataFrame:
    """Add ``risk_label``: 'Bad' up to the quantile of the score, 'Good' above.

    Give ``boundary`` (for instance from ``exact_quantiles``) for a column with
    very many distinct values.  ``strict`` fails the job if the boundary equals
    the lowest or highest score, in which case one of the two intervals is empty.
    """
    score = F.col(score_column)
    cut = F.lit(float(boundary)) if boundary is not None else label_boundary(scored, score_column=score_column, q=q).scalar()
    label = F.when(score <= cut, "Bad").when(score.isNotNull(), "Good")
    if strict:
        ends = scored.agg(F.array(F.min(score_column), F.max(score_column))).scalar()
        problem = F.raise_error(F.lit("score boundary leaves one label empty")).cast("string")
        label = F.when(F.array_contains(ends, cut), problem).otherwise(label)
    return scored.withColumn("risk_label", label)


def risk_labels(transactions: DataFrame, *, as_of=None, weights: Sequence[float] = DEFAULT_WEIGHTS, **options) -> DataFrame:
    """Transactions to labelled customers in one plan."""
    rfms = customer_rfms(transactions, as_of=as_of, **options)
    return label_scores(score_rfms(rfms, weights=weights))

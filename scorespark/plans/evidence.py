"""Transactions to weight of evidence and information value of all columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.functions.columns import numeric_columns
from scorespark.operators import woe
from scorespark.operators.binning import QuantileBins, SegmentBins
from scorespark.plans.training import label_transactions
from scorespark.session import materialize

# Columns that identify rows rather than describe them.
NOT_BINNED = ("transaction_id", "batch_id", "account_id", "subscription_id", "customer_id", "txn_ts")


@dataclass
class Evidence:
    """Labelled rows, stored, and the binned tables over them; counts are per transaction.

    The numeric and the categorical table are each made when first asked for.
    """

    rows: DataFrame
    numeric_names: list[str]
    ignore: Sequence[str] = NOT_BINNED
    n_bins: int = 5
    good: str = "Good"
    bad: str = "Bad"

    @cached_property
    def bins(self) -> QuantileBins:
        return QuantileBins.fit(self.rows, self.numeric_names, n_bins=self.n_bins, cut=False)

    @cached_property
    def encoder(self) -> woe.EvidenceEncoder:
        """Replaces every variable by its evidence."""
        return woe.EvidenceEncoder.fit(self.numeric, self.categorical, self.bins)

    @cached_property
    def numeric(self) -> DataFrame:
        return woe.woe_table(woe.numeric_counts(self.rows, self.bins, good=self.good, bad=self.bad))

    @cached_property
    def categorical(self) -> DataFrame:
        return woe.woe_table(woe.categorical_counts(self.rows, ignore=self.ignore, good=self.good, bad=self.bad))


def labelled_rows(
    transactions: DataFrame,
    *,
    as_of=None,
    columns: Sequence[str] | None = None,
    scores: DataFrame | None = None,
    number: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Labelled transactions, stored once because edges and counts each read them.

    Without ``columns`` everything but the identifying columns is stored.
    ``number`` names a further column, a number of its own for every stored row.
    ``path`` is where they are stored, for instance to be read as a stream as well.
    """
    labelled = label_transactions(transactions, as_of=as_of, scores=scores)
    keep = columns if columns is not None else [c for c in labelled.columns if c not in NOT_BINNED]
    numbered = [F.monotonically_increasing_id().alias(number)] if number else []
    return materialize(labelled.select(*keep, *numbered), "labelled", path)


def build_evidence(
    labelled: DataFrame, *, ignore: Sequence[str] = NOT_BINNED, n_bins: int = 5, good: str = "Good", bad: str = "Bad"
) -> Evidence:
    """Nothing runs until a table is asked for."""
    return Evidence(labelled, numeric_columns(labelled, ignore), ignore, n_bins, good, bad)


def segment_evidence(
    labelled: DataFrame, segment: str, *, ignore: Sequence[str] = NOT_BINNED, n_bins: int = 5, good: str = "Good", bad: str = "Bad"
) -> DataFrame:
    """Evidence of all variables in each segment, with the segment's own edges; ``information_value(..., by=[segment])`` sums it up."""
    names = numeric_columns(labelled, [*ignore, segment])
    bins = SegmentBins.fit(labelled, names, segment=segment, n_bins=n_bins, cut=False)
    numeric = woe.numeric_counts(labelled, bins, good=good, bad=bad)
    categorical = woe.categorical_counts(labelled, ignore=[*ignore, segment], by=[segment], good=good, bad=bad)
    return woe.woe_table(numeric.unionByName(categorical), by=[segment])


def fit_scorecard(e: Evidence, *, label: str = "risk_label", c: float = 1.0) -> PipelineModel:
    """Logistic regression on the evidence of all variables, from row to label, as one model to save.

    Rows with equal evidence are one weighted row.  Values outside every bin
    count as evidence 0.
    """
    encoder = e.encoder
    filled = SQLTransformer(statement="SELECT *, " + ", ".join(f"coalesce(`{o}`, 0.0D) AS `_x_{o}`" for o in encoder.outputs) + " FROM __THIS__")
    inputs = [f"_x_{o}" for o in encoder.outputs]
    vector = VectorAssembler(inputCols=inputs, outputCol="evidence")
    steps = PipelineModel([encoder.stage(), filled, vector])
    known = e.rows.where(F.col(label).isin(e.good, e.bad))
    rows = PipelineModel([encoder.stage(), filled]).transform(known).withColumn("_y", F.when(F.col(label) == e.good, 1.0).otherwise(0.0))
    points = materialize(rows.groupBy(*inputs, "_y").agg(F.count(F.lit(1)).cast("double").alias("_n")), "evidence-points")
    total = points.agg(F.sum("_n")).first()[0]
    learner = LogisticRegression(
        featuresCol="evidence", labelCol="_y", weightCol="_n", regParam=1.0 / (c * total), standardization=False, probabilityCol="_p", rawPredictionCol="_raw"
    )
    model = learner.fit(vector.transform(points))
    outcome = SQLTransformer(statement=f"SELECT *, CASE WHEN prediction = 1 THEN '{e.good}' ELSE '{e.bad}' END AS predicted_label FROM __THIS__")
    return PipelineModel([*steps.stages, model, outcome])

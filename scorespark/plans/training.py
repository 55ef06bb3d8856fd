"""Transactions to labelled model rows, and to a stored scoring model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from scorespark.operators import features, models
from scorespark.operators.joins import attach
from scorespark.operators.rfms import risk_labels
from scorespark.schema import MODEL_FEATURES
from scorespark.session import materialize

SCORES = ("recency_score", "frequency_score", "monetary_score", "std_score", "rfms_score", "risk_label")


def stored_scores(transactions: DataFrame, *, as_of=None, key: str = "customer_id") -> DataFrame:
    """Scores and label of every customer, stored for several uses."""
    return materialize(risk_labels(transactions, as_of=as_of, key=key).select(key, *SCORES), "scores")


def label_transactions(transactions: DataFrame, *, as_of=None, key: str = "customer_id", scores: DataFrame | None = None) -> DataFrame:
    """Transactions with the scores and the label of their customer, from ``stored_scores`` if given."""
    scores = scores if scores is not None else stored_scores(transactions, as_of=as_of, key=key)
    return attach(transactions, scores, key, cut=False)


def model_rows(labelled: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """The four model features and the label as 0/1, with columns to split by."""
    rows = features.encode_label(labelled.where("risk_label IS NOT NULL"))
    return rows.select(*keep, *MODEL_FEATURES, "label")


def training_set(transactions: DataFrame, *, as_of=None, by: Sequence[str] = ("transaction_id",), **options) -> models.TrainingSet:
    """``by`` decides what the split keeps together; give the customer column to keep customers whole."""
    rows = model_rows(label_transactions(transactions, as_of=as_of), keep=by)
    return models.TrainingSet.build(rows, by=by, **options)


def fit_scoring_model(data: models.TrainingSet, *, name: str = models.TREE, **settings) -> PipelineModel:
    """Scoring model of one learner with given settings."""
    (trained,) = models.train_models(data, {name: settings})
    return models.scoring_model(data, trained)

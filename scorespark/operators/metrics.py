"""Quality of a binary classification."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def roc_auc(df: DataFrame, *, label: str = "label", probability: str = "probability_good", weight: str | None = None) -> float:
    """Exact area under the curve, ties counted half; Spark sorts the distinct scores in parallel."""
    names = [label, probability, *([weight] if weight else [])]
    # Equal scores are merged before the sort.
    n = F.sum(weight) if weight else F.count(F.lit(1)).cast("double")
    points = (
        df.select(*names)
        .groupBy(F.col(label).cast("double").alias("y"), F.col(probability).cast("double").alias("p"))
        .agg(n.cast("double").alias("w"))
    )
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="p", labelCol="y", weightCol="w", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(points)


def classification_metrics(
    df: DataFrame,
    *,
    label: str = "label",
    prediction: str = "prediction",
    probability: str = "probability_good",
    weight: str | None = None,
) -> DataFrame:
    """One row of accuracy, precision, recall, F1 (class 1) and ROC AUC; 0 where undefined."""
    w = F.col(weight) if weight else F.lit(1.0)
    y, z = F.col(label) == 1, F.col(prediction) == 1

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, w)), F.lit(0.0))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    confusion = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).agg(
        total(y & z).alias("tp"), total(~y & z).alias("fp"), total(y & ~z).alias("fn"), total(~y & ~z).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion.select(
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.lit(roc_auc(df, label=label, probability=probability, weight=weight)).alias("roc_auc"),
    )

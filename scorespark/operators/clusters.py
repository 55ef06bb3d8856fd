"""K-Means alternatives to the quantile label.

Scores take few distinct values, so clusters are fitted on distinct score rows
weighted by the customers that share them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.operators.rfms import label_scores
from scorespark.operators.scaling import Scaler
from scorespark.session import materialize

SEED = 42
STARTS = 5
POINTS_PER_PARTITION = 20_000


def fit_clusters(df: DataFrame, columns: Sequence[str], *, k: int = 2, seed: int = SEED, starts: int = STARTS) -> KMeansModel:
    """The best by cost of several runs, each from its own start and until its centres rest: one run may end beside the best clusters."""
    points = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    stored = materialize(points, "points")
    parts = max(1, -(-stored.count() // POINTS_PER_PARTITION))
    vectors = _vectors(stored.repartition(parts, *columns), columns).select("features", "weight").persist()
    try:
        models = [KMeans(k=k, seed=seed + i, weightCol="weight", maxIter=100, tol=1e-9).fit(vectors) for i in range(starts)]
        return min(models, key=lambda m: m.summary.trainingCost)
    finally:
        vectors.unpersist()


def _vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip").transform(df)


def cluster_labels(
    scored: DataFrame, columns: Sequence[str] = ("rfms_score", "monetary_score"), *, seed: int = SEED, out: str = "cluster_label"
) -> DataFrame:
    """Add 'Good'/'Bad' by a two-cluster model; the cluster with the higher first centre is good."""
    model = fit_clusters(scored, columns, seed=seed)
    centres = [float(c[0]) for c in model.clusterCenters()]
    good = max(range(len(centres)), key=lambda i: centres[i])
    assigned = model.transform(_vectors(scored, columns))
    label = F.when(F.col("prediction") == good, "Good").otherwise("Bad")
    return assigned.withColumn(out, label).drop("features", "prediction")


def cluster_boundary(scored: DataFrame, *, score: str = "rfms_score", seed: int = SEED) -> tuple[float, float, float]:
    """Lower centre, upper centre and their middle, from the score alone."""
    centres = sorted(float(c[0]) for c in fit_clusters(scored, [score], seed=seed).clusterCenters())
    return centres[0], centres[-1], (centres[0] + centres[-1]) / 2


def label_method_comparison(scored: DataFrame, *, seed: int = SEED) -> DataFrame:
    """(method, label, n) for two-feature clusters, score clusters and the quantile."""
    stored = materialize(scored, "scores")
    two = cluster_labels(stored, ("rfms_score", "monetary_score"), seed=seed, out="kmeans_2d")
    one = cluster_labels(two, ("rfms_score",), seed=seed, out="kmeans_1d")
    every = label_scores(one).withColumnRenamed("risk_label", "quantile")
    long = every.unpivot([], ["kmeans_2d", "kmeans_1d", "quantile"], "method", "label")
    return long.groupBy("method", "label").agg(F.count(F.lit(1)).alias("n"))


def high_risk_customers(rfms: DataFrame, *, k: int = 3, seed: int = SEED) -> DataFrame:
    """Add ``is_high_risk``: member of the cluster with least frequency and value.

    Recency, frequency and value are standardised first.
    """
    names = ["recency", "frequency", "monetary"]
    stored = materialize(rfms, "rfms")
    scaler = Scaler.fit(stored, names)
    scaled = scaler.transform(stored.withColumns({f"_{c}": F.col(c) for c in names}))
    model = fit_clusters(scaled, names, k=k, seed=seed)
    centres = [c[1] + c[2] for c in model.clusterCenters()]
    least = min(range(len(centres)), key=lambda i: centres[i])
    assigned = model.transform(_vectors(scaled, names))
    flagged = assigned.withColumn("is_high_risk", (F.col("prediction") == least).cast("int"))
    return flagged.drop(*names, "features", "prediction").withColumnsRenamed({f"_{c}": c for c in names})

"""Answers that must not depend on how many rows or values there are."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorespark.functions.columns import parse_id
from scorespark.functions.quantiles import exact_quantiles
from scorespark.operators import models
from scorespark.operators.binning import QuantileBins
from scorespark.operators.distributions import density_curve
from scorespark.operators.encoding import LabelEncoder

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("kind", ["infinities", "mostly_nan", "only_infinities", "both_ends", "nan_and_null"])
def test_quantiles_agree_on_odd_numbers(spark, kind):
    rng = np.random.default_rng(3)
    plain = rng.normal(size=2000)
    values = {
        "infinities": np.where(rng.random(2000) < 0.15, np.inf, plain),
        "mostly_nan": np.where(rng.random(2000) < 0.9, np.nan, plain),
        "only_infinities": np.full(300, -np.inf),
        "both_ends": np.where(rng.random(2000) < 0.3, np.where(rng.random(2000) < 0.5, np.inf, -np.inf), plain),
        "nan_and_null": [None if k % 3 == 0 else math.nan if k % 3 == 1 else float(k) for k in range(900)],
    }[kind]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(3)
    answers = [exact_quantiles(df, ["x"], PROBS, small_rows=n)["x"] for n in (1, 100, 500_000)]
    clean = np.sort([v for v in values if v is not None and not math.isnan(v)])
    at = [(len(clean) - 1) * p for p in PROBS]
    expected = [clean[math.floor(a)] if clean[math.floor(a)] == clean[math.ceil(a)] else (math.ceil(a) - a) * clean[math.floor(a)] + (a - math.floor(a)) * clean[math.ceil(a)] for a in at]
    for got in answers:
        assert np.allclose(got, expected, rtol=1e-12, equal_nan=True)


def test_tree_splits_between_any_two_of_many_scores(spark):
    rows = [(round(1 + k / 10, 1), 3, "5", f"c{k % 40}", int(1 + k / 10 > 2.0)) for k in range(41) for _ in range(6)]
    df = spark.createDataFrame(rows, "rfms_score double, recency_score int, pricing_strategy string, product_category string, label int")
    df = df.withColumn("row", F.monotonically_increasing_id())
    df = df.select(*models.MODEL_FEATURES, "label", "row")
    data = models.TrainingSet.build(df, by=["row"])
    assert data.bins >= 40
    (tree,) = models.train_models(data, {models.TREE: {"max_depth": None}})
    wrong = tree.model.transform(data.train.union(data.test)).where("prediction <> label")
    assert wrong.count() == 0


def test_labels_have_no_limit(spark):
    encoder = LabelEncoder.fit(spark.range(12_000).selectExpr("concat('v', id) AS v"), ["v"])
    assert encoder.labels("v") == sorted(f"v{k}" for k in range(12_000))


def test_density_of_a_long_tail_equals_the_sum_over_rows(spark):
    x = np.random.default_rng(1).lognormal(0, 2, 20_000)
    out = density_curve(spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double"), "x").orderBy("point").collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    expected = [np.exp(-0.5 * ((r.x - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi)) for r in out]
    assert len(out) == 50 and np.allclose([r.density for r in out], expected, rtol=1e-5, atol=1e-16)
    assert density_curve(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x").count() == 0


def test_narrow_bins_read_differently(spark):
    bins = QuantileBins({"x": [0.00001, 0.00002, 0.5], "y": [1.0, 2.0]})
    labels = [r["label"] for r in bins.table(spark).orderBy("variable", "bin_id").collect()]
    assert labels == ["(0.00001, 0.00002]", "(0.00002, 0.50000]", "(1.000, 2.000]"]


def test_strict_ids_fail_on_other_text(spark):
    df = spark.createDataFrame([("a_5",), (None,)], "c string")
    assert [r[0] for r in df.select(parse_id("c", strict=True)).collect()] == [5, None]
    with pytest.raises(Exception, match="not an id"):
        df.union(spark.createDataFrame([("b",)], "c string")).select(parse_id("c", strict=True)).collect()

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scorespark.functions.quantiles import exact_quantiles, quantile_table
from scorespark.functions.ordering import running_totals
from scorespark.operators.binning import QuantileBins
from scorespark.operators.rfms import score_rfms
from pyspark.sql import functions as F

PROBS = [0.0, 0.2, 0.25, 0.5, 0.55, 0.999, 1.0]


def frame(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double").repartition(3)


@pytest.mark.parametrize("small", [500_000, 40, 3])
@pytest.mark.parametrize(
    "kind", ["spread", "heavy_ties", "two_values", "constant", "one_hot_value", "with_nulls"]
)
def test_search_equals_numpy(spark, kind, small):
    rng = np.random.default_rng(7)
    values = {
        "spread": rng.lognormal(3, 2, 5000),
        "heavy_ties": rng.integers(0, 6, 5000),
        "two_values": np.repeat([1.0, 2.0], 2500),
        "constant": np.full(500, 7.0),
        "one_hot_value": np.where(rng.random(5000) < 0.34, 5.0, rng.normal(5, 1, 5000)),
        "with_nulls": [None if i % 7 == 0 else float(i % 311) for i in range(4000)],
    }[kind]
    got = exact_quantiles(frame(spark, values), ["x"], PROBS, small_rows=small)["x"]
    clean = np.array([v for v in values if v is not None], dtype=float)
    assert np.allclose(got, np.quantile(clean, PROBS), rtol=1e-12)


def test_empty_column(spark):
    assert exact_quantiles(frame(spark, [None, None]), ["x"], [0.5]) == {"x": [None]}


def test_approximate_table(spark):
    rows = quantile_table(frame(spark, range(1001)), ["x"], [0.5], method="approx").collect()
    assert abs(rows[0]["quantile"] - 500) <= 1


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-20, 20), min_size=1, max_size=40))
def test_quintile_bins_equal_pandas(spark, values):
    expected = pd.qcut(pd.Series(values, dtype=float), q=5, duplicates="drop")
    df = frame(spark, values)
    bins = QuantileBins.fit(df, ["x"])
    got = df.select("x", bins.assign("x").alias("b")).toPandas().groupby("x", dropna=False).b.first()
    codes = pd.Series(expected.cat.codes.values, index=np.array(values, dtype=float)).groupby(level=0).first()
    for x, code in codes.items():
        b = got[x]
        assert (b is None or math.isnan(b)) if code < 0 else b == code + 1


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(0, 1000), min_size=1, max_size=30))
def test_equal_width_scores_equal_pandas(spark, values):
    s = pd.Series(values, dtype=float)
    up = pd.cut(s, bins=5, labels=[1, 2, 3, 4, 5]).astype(int)
    down = pd.cut(s, bins=5, labels=[5, 4, 3, 2, 1]).astype(int)
    df = spark.createDataFrame(
        [(i, int(v), int(v), float(v), float(v)) for i, v in enumerate(values)],
        "customer_id int, recency bigint, frequency bigint, monetary double, std_deviation double",
    )
    got = score_rfms(df).orderBy("customer_id").toPandas()
    assert list(got.monetary_score) == list(up) and list(got.frequency_score) == list(up)
    assert list(got.recency_score) == list(down) and list(got.std_score) == list(down)


def test_cut_edges(spark):
    values = [1, 1, 1, 2, 3, 4, 5, 9, 10]
    df = frame(spark, values)
    bins = QuantileBins.fit(df, ["x"])
    assert np.allclose(bins.edges["x"], [1, 2.2, 3.8, 6.6, 10])
    got = df.select("x", bins.assign("x").alias("b")).orderBy("x").toPandas()
    assert [b - 1 for b in got.b] == [0, 0, 0, 0, 1, 2, 2, 3, 3]


@pytest.mark.parametrize("per_range", [1000, 7])
def test_running_totals(spark, per_range):
    df = spark.range(100).select((F.col("id") * 37 % 101).alias("k"), (F.col("id") % 5 + 1).alias("w"))
    got = running_totals(df, ["k"], F.col("w"), "upto", rows_per_range=per_range).toPandas().sort_values("k")
    assert list(got.upto) == list(got.w.cumsum())

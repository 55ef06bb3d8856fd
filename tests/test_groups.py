import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorespark.functions import quantiles
from scorespark.operators import woe
from scorespark.operators.binning import QuantileBins, SegmentBins
from scorespark.plans import evidence

PROBS = [0.0, 0.2, 0.5, 0.55, 0.999, 1.0]


@pytest.fixture(scope="module")
def grouped(spark):
    """Groups of different sizes and spreads, one of them empty of values, rows without a group, missing values, both zeros."""
    rng = np.random.default_rng(3)
    rows = [("a", float(x), float(i % 4)) for i, x in enumerate(rng.lognormal(3, 2, 1500))]
    rows += [("b", float(x), 7.0) for x in rng.normal(-5, 1, 900)] + [("b", math.inf, None), ("b", -math.inf, None), ("b", math.nan, math.nan)]
    rows += [("c", None, 1.0), ("c", None, -0.0), ("c", None, 0.0)] + [(None, 1e9, -1e9)] * 50 + [("d", -0.0, 2.0), ("d", 0.0, 3.0)]
    return spark.createDataFrame(rows, "s string, x double, y double").repartition(5).cache(), rows


@pytest.mark.parametrize("small", [500_000, 40])
def test_quantiles_by_group_are_those_of_each_group(grouped, small):
    df, rows = grouped
    found = quantiles.grouped_quantiles(df, ["x", "y"], PROBS, by="s", groups=["a", "b", "c", "d"], small_rows=small, cut=False)
    for g in "abcd":
        for k, c in ((1, "x"), (2, "y")):
            own = sorted(r[k] for r in rows if r[0] == g and r[k] is not None and not math.isnan(r[k]))
            if not own:
                assert found[g][c] == [None] * len(PROBS)
                continue
            assert found[g][c][0] == own[0] and found[g][c][-1] == own[-1]
            if g != "b" or c != "x":
                assert np.allclose(found[g][c], np.quantile(own, PROBS), rtol=1e-12)
            else:  # infinities at both ends
                assert np.allclose(found[g][c][1:4], np.quantile(own, PROBS[1:4]), rtol=1e-9)


def test_work_of_a_search_does_not_grow_with_the_segments(grouped, monkeypatch):
    """A value is sketched for its own segment only: a column has one sketch, however many segments there are."""
    df, _ = grouped
    made, sketch = [], F.kll_sketch_agg_double
    monkeypatch.setattr(F, "kll_sketch_agg_double", lambda *a: made.append(a) or sketch(*a))
    monkeypatch.setattr(quantiles.grouped_quantiles, "__kwdefaults__", {**quantiles.grouped_quantiles.__kwdefaults__, "small_rows": 900})
    SegmentBins.fit(df, ["x"], segment="s")
    assert len(made) == 1


def test_columns_of_few_values_are_neither_sketched_nor_narrowed(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: pytest.fail("searched"))
    df = spark.range(4000).select((F.col("id") % 5).alias("few"), F.lit(256).alias("one"), F.when(F.col("id") % 2 == 0, 1.5).alias("null"))
    found = quantiles.exact_quantiles(df, ["few", "one", "null"], [0.0, 0.5, 1.0], small_rows=10, cut=False)
    assert found == {"few": [0.0, 2.0, 4.0], "one": [256.0] * 3, "null": [1.5] * 3}


def test_segment_bins_and_counts_agree_with_each_segment_alone(grouped):
    df, _ = grouped
    df = df.withColumn("risk_label", F.when(F.col("y") > 1, "Good").when(F.col("y") <= 1, "Bad"))
    bins = SegmentBins.fit(df, ["x", "y"], segment="s")
    both = {(r["s"], r["variable"], r["bin_id"]): (r["good"], r["bad"], r["total"]) for r in woe.numeric_counts(df, bins).collect()}
    alone = {}
    for s in "abcd":
        part = df.where(F.col("s") == s)
        own = QuantileBins.fit(part, ["x", "y"])
        assert bins.edges[s] == own.edges
        if own.binned:
            alone |= {(s, r["variable"], r["bin_id"]): (r["good"], r["bad"], r["total"]) for r in woe.numeric_counts(part, own).collect()}
    assert both == alone


def test_labelled_rows_are_numbered_and_stored_where_asked(spark, tmp_path):
    scores = spark.createDataFrame([("c1", 1.0, "Good")], "customer_id string, rfms_score double, risk_label string")
    txns = spark.range(100).select(F.lit("c1").alias("customer_id"), F.col("id").alias("amount")).repartition(4)
    rows = evidence.labelled_rows(txns, scores=scores, number="_row", path=str(tmp_path / "rows"))
    assert rows.columns == ["amount", "rfms_score", "risk_label", "_row"] and rows.select("_row").distinct().count() == 100
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 100
    assert evidence.build_evidence(rows, ignore=[*evidence.NOT_BINNED, "_row"]).numeric_names == ["amount", "rfms_score"]


def test_evidence_is_rounded_by_bin_not_by_row(spark, folder):
    from checks.queries import QUERIES

    plan = QUERIES["woe_transform"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan

"""Nested ensembles, stratified parts, resampling, synthetic points, evidence as a stage, versions."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from scorespark.operators import ensembles, models, smote, split
from scorespark.operators.binning import QuantileBins, SegmentBins
from scorespark.operators.encoding import LabelEncoder
from scorespark.operators.neighbours import nearest_points, search
from scorespark.operators.scaling import Scaler
from scorespark.operators.woe import EvidenceEncoder
from scorespark.session import new_path
from scorespark.sources.artefacts import Artefacts


@pytest.fixture(scope="module")
def points(spark):
    """Noisy weighted points that no small tree tells apart."""
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(400, 3)), 2)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.7, 400) > 0).astype(int)
    n = rng.integers(1, 30, 400)
    rows = [(v.tolist(), int(a), int(b), float(b)) for v, a, b in zip(x, y, n)]
    df = spark.createDataFrame(rows, "x array<double>, label int, n bigint, weight double")
    return df.withColumn("features", array_to_vector("x")).coalesce(1).cache()


def accuracy(model, points):
    row = model.transform(points).agg(F.sum(F.when(F.col("prediction") == F.col("label"), F.col("weight")).otherwise(0.0)) / F.sum("weight"))
    return row.first()[0]


def test_trees_cut_at_a_depth_are_those_trained_to_it(spark, points):
    model = models.classifier(models.TREE, bins=400, max_depth=None).fit(points)
    depths = [1, 2, 3, 5, 8, models.UNLIMITED_DEPTH]
    got = ensembles.accuracies(ensembles.Trees.of(spark, model), points, [ensembles.Size(1, d) for d in depths])
    want = [accuracy(models.classifier(models.TREE, bins=400, max_depth=d).fit(points), points) for d in depths]
    assert np.allclose(got, want) and len(set(np.round(got, 6))) > 3


def test_first_rounds_of_boosting_are_a_shorter_boosting(spark, points):
    model = models.classifier(models.BOOSTING, bins=400, n_estimators=12).fit(points)
    got = ensembles.accuracies(ensembles.Trees.of(spark, model), points, [ensembles.Size(k, models.UNLIMITED_DEPTH) for k in (1, 4, 12)])
    want = [accuracy(models.classifier(models.BOOSTING, bins=400, n_estimators=k).fit(points), points) for k in (1, 4, 12)]
    assert np.allclose(got, want)


def test_forest_nodes_predict_what_the_forest_predicts(spark, points):
    model = models.fit(models.FOREST, points, rows=400, bins=400, n_estimators=15, max_depth=6)
    got = ensembles.accuracies(ensembles.Trees.of(spark, model), points, [ensembles.Size(15, 6), ensembles.Size(15, 1)])
    assert np.isclose(got[0], accuracy(model, points)) and got[1] < got[0]


def test_no_points_have_no_accuracy(spark, points):
    model = models.classifier(models.TREE, bins=400, max_depth=2).fit(points)
    assert ensembles.accuracies(ensembles.Trees.of(spark, model), points.limit(0), [ensembles.Size(1, 2)]) == [0.0]


def test_ten_fits_hold_27_settings():
    fits = [f for name, values in models.GRID.items() for f in models.nested_fits(name, values)]
    assert len(fits) == 10 and sum(len(inside) for _, inside in fits) == 27
    (largest, _), = models.nested_fits(models.FOREST, models.GRID[models.FOREST])
    assert largest == {"n_estimators": 200, "max_depth": None}


@pytest.mark.parametrize(("few", "many"), [(3, 1), (997, 4003), (20, 50)])
def test_parts_and_folds_have_equal_shares_of_each_label(spark, few, many):
    rows = spark.range(few + many).select("id", (F.col("id") < few).cast("int").alias("label"))
    rows = rows.union(spark.range(3).select("id", F.lit(None).cast("int")))
    out = split.stratified_parts(rows, ["id"], folds=5).groupBy("label", "part", "fold").count().collect()
    for label, total in ((1, few), (0, many)):
        own = {(r["part"], r["fold"]): r["count"] for r in out if r["label"] == label}
        assert sum(own.values()) == total
        assert abs(own.get(("test", None), 0) - 0.3 * total) <= 1
        folds = [own.get(("train", k), 0) for k in range(5)]
        assert max(folds) - min(folds) <= 1
    assert [(r["part"], r["fold"], r["count"]) for r in out if r["label"] is None] == [("train", None, 3)]


def test_rows_that_agree_stay_together(spark):
    rows = spark.range(2000).select((F.col("id") % 90).alias("customer"), (F.col("id") % 2).cast("int").alias("label"))
    out = split.stratified_parts(rows, ["customer"]).groupBy("label", "customer").agg(F.count_distinct(F.struct("part", F.coalesce("fold", F.lit(-1)))).alias("places"))
    assert {r["places"] for r in out.collect()} == {1}


def test_a_forest_of_points_is_a_forest_of_rows(spark):
    """A point of 9,000 in 10,000 rows, and few others with the other label close by."""
    spots = [(0.0, 0, 9000), (0.1, 1, 300), (0.2, 0, 100), (0.3, 1, 600)]
    merged = spark.createDataFrame([([v, -v], y, n, float(n)) for v, y, n in spots], "x array<double>, label int, n bigint, weight double")
    merged = merged.withColumn("features", array_to_vector("x"))
    rows = merged.withColumn("k", F.explode(F.expr("sequence(1L, n)"))).withColumns({"n": F.lit(1).cast("bigint"), "weight": F.lit(1.0)}).drop("k")
    parts = models.bootstrap_points(merged)
    assert parts.count() == 10_000 and parts.agg(F.sum("weight"), F.sum("n")).first() == (10_000.0, 10_000)
    settings = {"rows": 10_000, "bins": 32, "n_estimators": 40, "max_depth": 2}
    shares = []
    for table in (merged, rows):
        model = models.fit(models.FOREST, table, **settings)
        found = model.transform(merged).collect()
        shares.append({tuple(r["x"]): r["probability"][1] for r in found})
    assert all(abs(shares[0][k] - shares[1][k]) < 0.02 for k in shares[0])
    coarse = models.bootstrap_points(merged, units=100)
    assert 100 <= coarse.count() <= 104 and coarse.agg(F.sum("weight")).first()[0] == pytest.approx(10_000)


def test_synthetic_points_balance_every_fold_from_its_own_points(spark):
    rng = np.random.default_rng(7)
    rows = []
    for fold in range(3):
        rows += [(float(10 * fold + a), float(b), 0, fold, 3) for a, b in rng.normal(0, 1, (60, 2))]
        rows += [(float(10 * fold + a), float(b), 1, fold, int(n)) for (a, b), n in zip(rng.normal(0, 1, (20, 2)), rng.integers(1, 9, 20))]
    df = spark.createDataFrame(rows, "a double, b double, label int, fold int, n bigint")
    made = smote.synthetic_points(df, ["a", "b"]).toPandas()
    assert set(made.label) == {1}
    for fold in range(3):
        there = sum(r[4] for r in rows if r[2] == 1 and r[3] == fold)
        own = made[made.fold == fold]
        assert own.n.sum() == 180 - there
        line = [r[0] for r in rows if r[2] == 1 and r[3] == fold]
        assert own.a.min() >= min(line) and own.a.max() <= max(line)
    again = smote.synthetic_points(df, ["a", "b"]).toPandas()
    assert sorted(map(tuple, made.values)) == sorted(map(tuple, again.values))


def test_training_set_with_synthetic_rows(spark):
    rows = spark.range(3000).selectExpr(
        "id", "cast(id % 37 AS double) AS rfms_score", "cast(id % 5 AS double) AS recency_score", "cast(id % 3 AS string) AS pricing_strategy",
        "concat('c', id % 4) AS product_category", "cast(id % 37 > 25 AS int) AS label",
    )
    data = models.TrainingSet.build(rows, by=["id"], balance="synthetic")
    sums = {(r["label"], r["fold"]): r["n"] for r in data.train.groupBy("label", "fold").agg(F.sum("n").alias("n")).collect()}
    assert all(sums[0, k] == sums[1, k] for k in range(5))
    assert data.test.agg(F.sum("n")).first()[0] == pytest.approx(900, abs=2) and data.test.where("rfms_score IS NULL").count() == 0
    with pytest.raises(ValueError, match="balance"):
        models.TrainingSet.build(rows, by=["id"], balance="other")


def test_search_in_small_boxes_equals_comparing_all():
    rng = np.random.default_rng(3)
    points = np.unique(np.vstack([rng.normal(0, 1, (300, 3)), rng.integers(0, 3, (100, 3))]).round(2), axis=0)
    asking = points[::7]
    i, j, d = search(asking, points, 4, leaf=9)
    for a in range(len(asking)):
        far = np.sqrt(((points - asking[a]) ** 2).sum(1))
        assert np.allclose(d[i == a], np.sort(far[far > 0])[:4]) and np.allclose(far[j[i == a]], d[i == a])
    assert len(search(asking[:0], points, 4)[0]) == 0 and len(search(asking, points[:0], 4)[0]) == 0


@pytest.mark.parametrize("limits", [{"chunk": 30}, {"chunk": 30, "most_boxes": 3, "asking": 7}, {"chunk": 25, "most_boxes": 1}])
def test_neighbours_across_boxes_and_chunks(spark, limits):
    rng = np.random.default_rng(4)
    points = np.unique(np.vstack([rng.normal(0, 1, (150, 2)), rng.normal(5, 0.1, (100, 2))]).round(3), axis=0)
    df = spark.createDataFrame([(*map(float, p), 1) for p in points], "a double, b double, n bigint")
    out = nearest_points(df, ["a", "b"], k=3, leaf=8, **limits).collect()
    got = {}
    for r in out:
        got.setdefault((r["a"], r["b"]), []).append(r["_found"]["d"])
    assert len(got) == len(points)
    for p in points:
        far = np.sqrt(((points - p) ** 2).sum(1))
        assert np.allclose(sorted(got[tuple(p)]), np.sort(far[far > 0])[:3])


def test_segment_bins_are_the_bins_of_each_segment(spark):
    rng = np.random.default_rng(5)
    rows = [(s, float(x), int(y)) for s, scale in (("a", 1), ("b", 100), ("it's", 7)) for x, y in zip(rng.normal(0, scale, 200), rng.integers(0, 3, 200))]
    df = spark.createDataFrame([*rows, (None, 1.0, 1), ("c", None, 4)], "s string, x double, y int")
    bins = SegmentBins.fit(df, ["x", "y"], segment="s")
    for s in ("a", "b", "it's"):
        own = df.where(F.col("s") == s)
        assert bins.edges[s] == QuantileBins.fit(own, ["x", "y"]).edges
        assert [tuple(r) for r in own.select(bins.assign("x")).collect()] == [tuple(r) for r in own.select(QuantileBins(bins.edges[s]).assign("x")).collect()]
    assert bins.edges["c"]["x"] == [] and {r[0] for r in df.where("s IS NULL OR s = 'c'").select(bins.assign("x")).collect()} == {None}
    with pytest.raises(ValueError, match="more than 2"):
        SegmentBins.fit(df, ["x"], segment="s", most=2)


def test_evidence_as_a_saved_stage(spark):
    encoder = EvidenceEncoder({"x": [0.0, 1.0, 2.5]}, {"x": {1: 0.1, 2: -0.2}}, {"t": {"it's": 1.5, "a\\b": 2.5}})
    df = spark.createDataFrame([(0.0, "it's"), (1.0, "a\\b"), (1.5, "?"), (2.6, None), (-1.0, None), (None, None)], "x double, t string")
    want = [(0.1, 1.5), (0.1, 2.5), (-0.2, None), (None, None), (None, None), (None, None)]
    assert [(r["x_woe"], r["t_woe"]) for r in encoder.transform(df).collect()] == want
    path = new_path(spark, "stage")
    PipelineModel([encoder.stage()]).write().save(path)
    assert [(r["x_woe"], r["t_woe"]) for r in PipelineModel.load(path).transform(df).collect()] == want


def test_versions_of_artefacts(spark):
    path = new_path(spark, "artefacts")
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b")], "x double, t string")
    encoder = LabelEncoder.fit(df, ["t"])
    names = []
    for depth in (1, 2):
        saved = Artefacts(Scaler.fit(df, ["x"]), encoder, PipelineModel([]), QuantileBins.fit(df, ["x"]) if depth == 2 else None, {"max_depth": depth})
        names.append(saved.save(spark, path))
    assert [v["version"] for v in Artefacts.versions(spark, path)] == names
    assert Artefacts.load(spark, path).settings == {"max_depth": 2} and Artefacts.load(spark, path).bins.edges["x"][0] == 1.0
    first = Artefacts.load(spark, path, names[0])
    assert first.settings == {"max_depth": 1} and first.bins is None and first.scaler.parameters == {"x": (2.0, 1.0)}
    with pytest.raises(RuntimeError, match="no version"):
        Artefacts.load(spark, path, "unknown")
    # What an interrupted save leaves is not seen.
    encoder.dictionary.write.parquet(f"{path}/versions/half/encoder")
    assert len(Artefacts.versions(spark, path)) == 2


def test_interactions_are_sparse(spark):
    from scorespark.operators.features import interaction_vectors

    df = spark.createDataFrame([(1, "b", 2.5), (2, "a", -1.0), (3, None, 4.0), (4, "b", None)], "id long, kind string, x double")
    out = interaction_vectors(df, LabelEncoder.fit(df, ["kind"]), category="kind", number="x").orderBy("id").collect()
    assert [r["interaction"] and tuple(r["interaction"]) for r in out] == [(2, 1, 2.5), (2, 0, -1.0), None, None]
    assert [r["kind"] for r in out] == ["b", "a", None, "b"]


def test_feature_table_moments_equal_those_over_rows(spark, folder):
    from scorespark.operators import features
    from scorespark.plans.feature_table import build_feature_table
    from scorespark.sources.views import transactions

    rows = transactions(spark, folder)
    made = build_feature_table(rows)
    joined = features.with_customer_aggregates(features.drop_incomplete(features.add_date_parts(rows)))
    want = Scaler.fit(joined, list(made.scaler.parameters)).parameters
    for c, (mean, std) in made.scaler.parameters.items():
        assert mean == pytest.approx(want[c][0], rel=1e-9) and std == pytest.approx(want[c][1], rel=1e-9, abs=1e-9)
    assert made.rows.count() == joined.count()

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorespark.functions.columns import hash_fraction
from scorespark.operators import clusters, models, smote
from scorespark.plans import training
from scorespark.schema import SCORING_REQUEST
from scorespark.session import new_path
from scorespark.sources.views import transactions
from scorespark.streaming.scoring import read_requests, score_requests, score_stream

BY = ("transaction_id", "txn_ts", "product_id", "value")


@pytest.fixture(scope="module")
def data(spark, folder):
    return training.training_set(transactions(spark, folder), as_of="2002-01-01 00:00:00", by=BY)


@pytest.fixture(scope="module")
def model(data):
    return training.fit_scoring_model(data, max_depth=5)


@pytest.fixture(scope="module")
def requests(spark, folder):
    rows = training.label_transactions(transactions(spark, folder), as_of="2002-01-01 00:00:00")
    known = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCORING_REQUEST.fields]).distinct()
    odd = spark.createDataFrame([(2.0, 3.0, "1", "never seen"), (2.0, 3.0, "x", "PROMO"), (None, 3.0, "1", "PROMO")], SCORING_REQUEST)
    return known.union(odd)


def test_parts_cover_all_rows(data, spark, folder):
    n = data.train.unionByName(data.test).agg(F.sum("n")).first()[0]
    assert n == transactions(spark, folder).count()
    weights = data.train.groupBy("label").agg(F.sum("weight")).collect()
    assert abs(weights[0][1] - weights[1][1]) < 1e-6 * weights[0][1]


def test_vectors_are_standardised(data):
    rows = data.train.select("features", "n").collect()
    x = np.array([r["features"].toArray() for r in rows])
    w = np.array([r["n"] for r in rows])
    for i in range(3):
        mean = np.average(x[:, i], weights=w)
        assert abs(mean) < 1e-9 and abs(np.average((x[:, i] - mean) ** 2, weights=w) - 1) < 1e-9


def test_all_learners(data):
    table = models.evaluate(data, models.train_models(data, {models.LOGISTIC: {"C": 100}, models.FOREST: {"n_estimators": 5, "max_depth": 5}, models.TREE: {"max_depth": 5}, models.BOOSTING: {"n_estimators": 3}}))
    rows = {r["model"]: r for r in table.collect()}
    assert set(rows) == set(models.GRID)
    for r in rows.values():
        assert all(0.0 <= r[m] <= 1.0 for m in ("accuracy", "precision", "recall", "f1", "roc_auc"))
        assert r["roc_auc"] > 0.9


def test_grid_search_picks_best(data):
    grid = {models.TREE: {"max_depth": [1, 5]}, models.LOGISTIC: {"C": [0.01]}}
    best, tried = models.grid_search(data, grid, folds=5)
    assert len(tried) == 3 and len(best) == 2
    chosen = models.best_model(best)
    assert chosen.cv_accuracy == max(a for _, _, a in tried)


def test_grid_covers_27_settings():
    sizes = [np.prod([len(v) for v in g.values()]) for g in models.GRID.values()]
    assert sorted(sizes) == [4, 5, 9, 9]


def test_bad_requests_are_flagged(model, requests):
    got = score_requests(requests, model).where("_error is not null").collect()
    assert sorted(r["_error"] for r in got) == ["missing or malformed number"] * 2 + ["unknown product_category"]
    assert all(r["risk_label"] is None for r in got)


def test_stream_equals_batch(spark, model, requests):
    folder, out = new_path(spark, "requests"), new_path(spark, "scored")
    requests.repartition(3).write.json(folder)
    stream = read_requests(spark, folder, files_per_trigger=1)
    score_stream(stream, model, path=out, checkpoint=new_path(spark, "progress"), until_done=True).awaitTermination()
    batch = sorted(map(str, score_requests(requests, model).collect()))
    assert sorted(map(str, spark.read.parquet(out).select(*requests.columns, "risk_label", "_error").collect())) == batch


def test_artefacts_missing(spark, tmp_path):
    from scorespark.sources.artefacts import Artefacts

    with pytest.raises(RuntimeError, match="cannot load"):
        Artefacts.load(spark, str(tmp_path))


def brute_neighbours(points, counts, i, k):
    d = np.sqrt(((points - points[i]) ** 2).sum(axis=1))
    others = sorted((d[j], counts[j]) for j in range(len(points)) if j != i)
    need, out = k + 1 - counts[i], []
    for dist, n in others:
        if need <= 0:
            break
        out += [dist] * min(n, need)
        need -= n
    return out


@pytest.mark.parametrize("leaf", [1_000, 40, 4])
def test_neighbours_equal_brute_force(spark, leaf):
    rng = np.random.default_rng(3)
    raw = np.vstack([rng.normal(0, 1, (120, 3)), rng.integers(0, 3, (200, 3)), rng.normal(8, 0.1, (30, 3))]).round(3)
    points, counts = np.unique(raw, axis=0, return_counts=True)
    df = spark.createDataFrame(
        [(*map(float, p), int(n)) for p, n in zip(points, counts)], "a double, b double, c double, n bigint"
    )
    got = smote.nearest_neighbours(df, ["a", "b", "c"], k=5, leaf=leaf).collect()
    at = {tuple(p): i for i, p in enumerate(points)}
    assert {(r["a"], r["b"], r["c"]) for r in got} == {tuple(p) for p, n in zip(points, counts) if n <= 5}
    for r in got:
        i = at[(r["a"], r["b"], r["c"])]
        need, found = 6 - counts[i], []
        for x in r["near"]:
            found += [x["d"]] * min(x["n"], need)
            need -= x["n"]
        assert np.allclose(found, brute_neighbours(points, counts, i, 5))


def test_neighbours_with_clashing_names(spark):
    df = spark.createDataFrame([(float(i), float(i * i), 1) for i in range(30)], "d double, leaf double, n bigint")
    got = {r["d"]: [x["point"]["d"] for x in r["near"]] for r in smote.nearest_neighbours(df, ["d", "leaf"], k=2, leaf=5).collect()}
    assert got[0.0] == [1.0, 2.0] and got[10.0] == [9.0, 11.0] and len(got) == 30


def test_neighbours_of_one_point_and_of_none(spark):
    one = spark.createDataFrame([(1.0, 2.0, 1)], "a double, b double, n bigint")
    assert [r["near"] for r in smote.nearest_neighbours(one, ["a", "b"]).collect()] == [[]]
    assert smote.nearest_neighbours(one.limit(0), ["a", "b"]).count() == 0


def test_synthetic_rows_balance_the_classes(spark):
    rng = np.random.default_rng(5)
    rows = [(float(x), float(y), 0) for x, y in rng.integers(0, 4, (150, 2))]
    rows += [(float(x), float(y), 1) for x, y in rng.normal(10, 1, (47, 2))]
    rows += [(20.0, 20.0, 1)] * 30
    df = spark.createDataFrame(rows, "a double, b double, label int")
    made = smote.synthetic_rows(df, ["a", "b"]).toPandas()
    assert len(made) == 150 - 77 and set(made.label) == {1}
    assert made.a.min() > 5 and made.b.min() > 5
    assert abs(((made.a == 20) & (made.b == 20)).sum() - 73 * 30 / 77) <= 1
    again = smote.synthetic_rows(df, ["a", "b"]).toPandas()
    assert sorted(map(tuple, made.values)) == sorted(map(tuple, again.values))


def test_synthetic_rows_of_a_hot_point(spark):
    df = spark.range(40).select(F.lit(1.0).alias("a"), F.lit(1).alias("label"))
    big = spark.range(300_000).select(F.lit(2.0).alias("a"), F.lit(0).alias("label"))
    made = smote.synthetic_rows(df.union(big), ["a"])
    assert made.count() == 300_000 - 40 and made.select("a").distinct().collect()[0][0] == 1.0


def test_hash_fraction_is_uniform(spark):
    row = spark.range(20_000).agg(F.avg(hash_fraction("id")), F.min(hash_fraction("id")), F.max(hash_fraction("id"))).first()
    assert abs(row[0] - 0.5) < 0.01 and row[1] >= 0 and row[2] < 1


def test_cluster_boundary(spark):
    df = spark.createDataFrame([(1.0,)] * 30 + [(3.0,)] * 10, "rfms_score double")
    assert clusters.cluster_boundary(df) == (1.0, 3.0, 2.0)


def test_high_risk_is_least_active(spark):
    rows = [(f"a{i}", 10, 1, 5.0 + i % 3) for i in range(20)] + [(f"b{i}", 1, 50, 5000.0 + i) for i in range(20)] + [(f"c{i}", 5, 20, 2000.0 + i) for i in range(20)]
    df = spark.createDataFrame(rows, "customer_id string, recency bigint, frequency bigint, monetary double")
    got = clusters.high_risk_customers(df).where("is_high_risk = 1")
    assert {r["customer_id"][0] for r in got.collect()} == {"a"} and got.count() == 20


def test_queries_search_every_setting(spark, folder, monkeypatch):
    from checks import queries

    grids = []

    def searched(data, grid=models.GRID, **settings):
        grids.append(grid)
        raise StopIteration

    monkeypatch.setattr(queries.models, "grid_search", searched)
    monkeypatch.setattr(queries, "model_set", lambda spark, sf: None)
    for name in ("grid_search", "best_model"):
        with pytest.raises(StopIteration):
            queries.QUERIES[name](spark, folder)
    assert grids == [models.GRID, models.GRID]

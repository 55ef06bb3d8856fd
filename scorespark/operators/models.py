"""Four classifiers over the scoring features: training, grid search, choice.

Model features have few distinct combinations, and all four learners accept row
weights.  Equal rows are therefore merged into one weighted row before training;
the training set then hardly grows with the number of transactions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.base import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.operators import ensembles, split
from scorespark.operators.encoding import LabelEncoder
from scorespark.operators.metrics import classification_metrics
from scorespark.operators.scaling import Scaler
from scorespark.operators.smote import synthetic_points
from scorespark.schema import MODEL_FEATURES
from scorespark.session import materialize

LEAST_BINS = 32
UNLIMITED_DEPTH = 30  # the deepest tree the learners allow
POINTS_PER_PARTITION = 20_000
BOOTSTRAP_UNITS = 20_000
LOGISTIC, FOREST, TREE, BOOSTING = "logistic_regression", "random_forest", "decision_tree", "gradient_boosting"

# The hyperparameter grid (None: depth not limited).
GRID = {
    LOGISTIC: {"C": [0.01, 0.1, 1, 10, 100]},
    FOREST: {"n_estimators": [50, 100, 200], "max_depth": [None, 5, 10]},
    TREE: {"max_depth": [3, 5, 7, None]},
    BOOSTING: {"learning_rate": [0.01, 0.1, 0.2], "n_estimators": [50, 100, 200]},
}


def training_points(df: DataFrame, *, features: Sequence[str] = MODEL_FEATURES, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Distinct feature rows per label (and per column of ``by``) with the number of rows behind them."""
    return df.groupBy(*features, label, *by).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Preparation:
    """Fitted steps from a scoring request to a feature vector, shared by training and scoring."""

    model: PipelineModel
    categories: list[str]

    @classmethod
    def fit(cls, points: DataFrame) -> Preparation:
        """Scale the three numeric features, number the product category.

        Each of ``points`` stands for ``n`` rows.
        """
        numbers = points.withColumns({c: F.expr(f"try_cast({c} AS DOUBLE)") for c in MODEL_FEATURES[:3]})
        scaler = Scaler.fit(numbers, MODEL_FEATURES[:3], weight="n")
        categories = LabelEncoder.fit(points, [MODEL_FEATURES[3]]).labels(MODEL_FEATURES[3])
        return cls(_preparation(scaler, categories), categories)


def _preparation(scaler: Scaler, categories: list[str]) -> PipelineModel:
    scaled = ", ".join(
        f"(try_cast({c} AS DOUBLE) - {mean!r}) / {(std or 1.0)!r} AS _x_{c}" for c, (mean, std) in scaler.parameters.items()
    )
    category = MODEL_FEATURES[3]
    steps = [
        SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"),
        StringIndexerModel.from_labels(categories, category, f"_i_{category}", handleInvalid="keep"),
        # Plain number from here on, as the code is used as a quantity.
        SQLTransformer(statement=f"SELECT *, _i_{category} + 0.0D AS _x_{category} FROM __THIS__"),
        VectorAssembler(
            inputCols=[f"_x_{c}" for c in MODEL_FEATURES], outputCol="features", handleInvalid="keep"
        ),
    ]
    return PipelineModel(steps)


def most_values(points: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> int:
    """The largest number of different values that a feature has in ``points``."""
    row = points.agg(*[F.count_distinct(c) for c in features]).first()
    return max(v or 0 for v in row)


def classifier(name: str, *, rows: float = 1.0, bins: int = LEAST_BINS, seed: int = split.SEED, **settings):
    """A learner with the given settings.

    ``rows`` is the total weight: the logistic penalty is stated per row.  With
    ``bins`` at least the values of a feature, trees may split between any two of
    them.  The forest draws with replacement from the points it is given; see
    ``bootstrap_points``.
    """
    columns = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    depth = settings.get("max_depth")
    depth = UNLIMITED_DEPTH if depth is None else depth
    if name == LOGISTIC:
        return LogisticRegression(
            regParam=1.0 / (settings.get("C", 1.0) * rows), elasticNetParam=0.0, standardization=False, **columns
        )
    if name == FOREST:
        return RandomForestClassifier(
            numTrees=settings.get("n_estimators", 100), maxDepth=depth, maxBins=bins, bootstrap=True, seed=seed, **columns
        )
    if name == TREE:
        return DecisionTreeClassifier(maxDepth=depth, maxBins=bins, seed=seed, **columns)
    if name == BOOSTING:
        return GBTClassifier(
            maxIter=settings.get("n_estimators", 100),
            stepSize=settings.get("learning_rate", 0.1),
            maxDepth=settings.get("max_depth", 3),
            maxBins=bins,
            seed=seed,
            **columns,
        )
    raise ValueError(f"unknown learner {name!r}")


def bootstrap_points(points: DataFrame, *, units: int = BOOTSTRAP_UNITS) -> DataFrame:
    """Points cut into parts that a forest can draw one by one.

    A forest draws every part about once, so a part must not stand for many
    rows: a point of 9,000 of 10,000 rows would be in a tree or not, as a whole.
    Up to ``units`` rows every part is one row, and trees are drawn as from the
    rows themselves; beyond, parts are as many rows as keep their number near
    ``units``, so the work does not grow with the rows behind the points.
    """
    rows = points.agg(F.sum("n")).scalar()
    unit = F.greatest(F.lit(1).cast("bigint"), F.ceil(rows / F.lit(units))).cast("bigint")
    cut = points.withColumn("_unit", unit).withColumn("_part", F.explode(F.expr("sequence(0L, (n - 1) div _unit)")))
    size = F.least(F.col("_unit"), F.col("n") - F.col("_part") * F.col("_unit"))
    return cut.withColumns({"weight": F.col("weight") * size / F.col("n"), "n": size}).drop("_unit", "_part")


def fit(name: str, points: DataFrame, *, rows: float, bins: int, **settings) -> Model:
    """A learner with the given settings, fitted to weighted points."""
    given = bootstrap_points(points) if name == FOREST else points
    return classifier(name, rows=rows, bins=bins, **settings).fit(given)


# Settings whose smaller values are scored inside the model with the largest ones.
NESTED = {LOGISTIC: (), FOREST: ("n_estimators", "max_depth"), TREE: ("max_depth",), BOOSTING: ("n_estimators",)}


def _depth(settings: Mapping) -> int:
    return UNLIMITED_DEPTH if settings.get("max_depth") is None else settings["max_depth"]


def nested_fits(name: str, values: Mapping[str, Sequence]) -> list[tuple[dict, list[dict]]]:
    """Settings to fit, each with the settings that the fitted model can be scored for."""
    groups: dict[tuple, list[dict]] = {}
    for chosen in product(*values.values()):
        settings = dict(zip(values, chosen, strict=True))
        groups.setdefault(tuple((k, v) for k, v in settings.items() if k not in NESTED[name]), []).append(settings)
    fits = []
    for inside in groups.values():
        largest = dict(inside[0])
        if "max_depth" in largest and "max_depth" in NESTED[name]:
            largest["max_depth"] = None if any(s["max_depth"] is None for s in inside) else max(s["max_depth"] for s in inside)
        if "n_estimators" in largest:
            largest["n_estimators"] = max(s["n_estimators"] for s in inside)
        fits.append((largest, inside))
    return fits


BALANCES = ("weights", "synthetic", "none")


def _synthetic_points(train: DataFrame) -> DataFrame:
    """Weighted points that bring the smaller class of each fold to the size of the larger, on scaled features."""
    scaled = [f"_x_{c}" for c in MODEL_FEATURES]
    made = synthetic_points(train, scaled, by="fold")
    weighted = made.select("label", F.lit("train").alias("part"), "fold", "n", F.col("n").cast("double").alias("weight"), *scaled)
    return VectorAssembler(inputCols=scaled, outputCol="features").transform(weighted).drop(*scaled)


@dataclass(frozen=True)
class TrainingSet:
    """Weighted training and test points with feature vectors, and the steps that made them."""

    train: DataFrame
    test: DataFrame
    preparation: Preparation
    rows: float
    bins: int

    @classmethod
    def build(cls, labelled: DataFrame, *, by: Sequence[str], test_share: float = split.TEST_SHARE, folds: int = 5, seed: int = split.SEED, balance: str = "weights") -> TrainingSet:
        """Split by a hash of ``by`` within each label, merge equal rows, fit the preparation on the training part.

        ``labelled`` holds the four features and ``label`` (0/1).  ``balance``:
        'weights' lets both classes of the training part weigh the same,
        'synthetic' adds points between neighbours of the smaller class, in each
        fold of the training part on its own, and 'none' leaves rows as they are.
        """
        if balance not in BALANCES:
            raise ValueError(f"balance must be one of {BALANCES}, not {balance!r}")
        rows = materialize(labelled.select(*MODEL_FEATURES, "label", *[c for c in by if c not in (*MODEL_FEATURES, "label")]), "model-rows")
        marked = split.stratified_parts(rows, by, test_share=test_share, folds=folds, seed=seed, cut=False)
        points = materialize(training_points(marked, by=("part", "fold")), "points")
        train = points.where(F.col("part") == "train")
        preparation = Preparation.fit(train)
        weights = {r["label"]: r["weight"] for r in split.class_weights(train, count="n").collect()} if balance == "weights" else {}
        weight = F.col("n") * F.coalesce(
            *[F.when(F.col("label") == y, F.lit(float(w))) for y, w in weights.items()], F.lit(1.0)
        )
        ready = preparation.model.transform(points.withColumn("weight", weight))
        kept = [*MODEL_FEATURES, "label", "part", "fold", "n", "weight", "features"]
        if balance == "synthetic":
            ready = materialize(ready, "scaled")
            ready = ready.select(*kept).unionByName(_synthetic_points(ready.where("part = 'train'")), allowMissingColumns=True)
        ready = materialize(ready.select(*kept), "vectors")
        train = ready.where(F.col("part") == "train")
        return cls(train, ready.where(F.col("part") == "test"), preparation, train.agg(F.sum("weight")).first()[0], max(LEAST_BINS, most_values(train)))


@dataclass(frozen=True)
class Trained:
    name: str
    model: Model | None
    settings: dict
    cv_accuracy: float | None = None


def _at_once(spark: SparkSession, tasks: Sequence[Callable], parallelism: int) -> list:
    """Results of functions that each run Spark jobs, some at a time; the jobs keep the properties of the calling thread."""
    with ThreadPoolExecutor(parallelism) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]]


def _few_partitions(points: DataFrame) -> DataFrame:
    """Merged points in as few partitions as they fill: a fit runs hundreds of small jobs over them."""
    return points.repartition(max(1, -(-points.count() // POINTS_PER_PARTITION)))


def train_models(data: TrainingSet, settings: Mapping[str, Mapping] | None = None, *, parallelism: int = 4) -> list[Trained]:
    """One model per learner with given settings (defaults if none)."""
    settings = settings or {name: {} for name in GRID}
    train = _few_partitions(data.train).persist()
    try:
        tasks = [lambda n=name, c=chosen: Trained(n, fit(n, train, rows=data.rows, bins=data.bins, **c), dict(c)) for name, chosen in settings.items()]
        return _at_once(train.sparkSession, tasks, parallelism)
    finally:
        train.unpersist()


def _scores(name: str, model: Model, inside: Sequence[Mapping], points: DataFrame) -> list[float]:
    """Accuracy of the model at each of the settings ``inside`` it."""
    if name == LOGISTIC:
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", weightCol="weight", metricName="accuracy")
        return [evaluator.evaluate(model.transform(points))]
    trees = ensembles.Trees.of(points.sparkSession, model)
    sizes = [ensembles.Size(len(trees.weights) if name == TREE else s.get("n_estimators", len(trees.weights)), _depth(s) if name != BOOSTING else UNLIMITED_DEPTH) for s in inside]
    return ensembles.accuracies(trees, points, sizes)


def _text(settings: Mapping) -> str:
    return ", ".join(f"{k}={v!r}" for k, v in sorted(settings.items()))


def grid_search(
    data: TrainingSet,
    grid: Mapping[str, Mapping[str, Sequence]] = GRID,
    *,
    folds: int = 5,
    parallelism: int = 8,
    refit: str = "each",
) -> tuple[list[Trained], list[tuple[str, str, float]]]:
    """Cross-validated search per learner, by accuracy.

    Returns the best model of every learner and (learner, settings, mean
    accuracy) of every setting tried.  Settings that differ in their number of
    trees, or in the depth of trees that do not build on each other, share one
    fit a fold.  ``refit``: fit 'each' best model to all training points, only
    that of the 'best' learner, or 'none'.
    """
    train = _few_partitions(data.train).persist()
    try:
        fits = [(name, largest, inside) for name, values in grid.items() for largest, inside in nested_fits(name, values)]
        # The longest sequences of jobs first.
        fits.sort(key=lambda f: list(GRID).index(f[0]), reverse=True)

        def scored(name: str, largest: Mapping, inside: Sequence[Mapping], fold: int) -> list[float]:
            model = fit(name, train.where(F.col("fold") != fold), rows=data.rows * (folds - 1) / folds, bins=data.bins, **largest)
            return _scores(name, model, inside, train.where(F.col("fold") == fold))

        tasks = [lambda f=f, k=k: scored(*f, k) for f in fits for k in range(folds)]
        results = _at_once(train.sparkSession, tasks, parallelism)
        tried: list[tuple[str, dict, float]] = []
        for i, (name, _, inside) in enumerate(fits):
            own = results[i * folds : (i + 1) * folds]
            tried += [(name, dict(settings), round(sum(r[j] for r in own) / folds, 12)) for j, settings in enumerate(inside)]
        order = list(grid)
        tried.sort(key=lambda t: order.index(t[0]))
        tops = []
        for name in order:
            settings, accuracy = max(((s, a) for n, s, a in tried if n == name), key=lambda x: x[1])
            tops.append(Trained(name, None, settings, accuracy))
        wanted = {"each": order, "best": [best_model(tops).name], "none": []}[refit]
        again = [lambda t=t: fit(t.name, train, rows=data.rows, bins=data.bins, **t.settings) for t in tops if t.name in wanted]
        fitted = dict(zip(wanted, _at_once(train.sparkSession, again, parallelism), strict=True))
        best = [Trained(t.name, fitted.get(t.name), t.settings, t.cv_accuracy) for t in tops]
        return best, [(name, _text(settings), accuracy) for name, settings, accuracy in tried]
    finally:
        train.unpersist()


def best_model(candidates: Sequence[Trained]) -> Trained:
    """Highest cross-validated accuracy over all learners, ties by name."""
    return min(candidates, key=lambda t: (-(t.cv_accuracy or 0.0), t.name))


def evaluate(data: TrainingSet, trained: Sequence[Trained]) -> DataFrame:
    """Five metrics per model on the test part; every test row counts once."""
    tables = []
    for t in trained:
        scored = t.model.transform(data.test).withColumn("probability_good", vector_to_array("probability")[1])
        row = classification_metrics(scored.withColumn("n", F.col("n").cast("double")), weight="n")
        tables.append(row.select(F.lit(t.name).alias("model"), "*"))
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


def scoring_model(data: TrainingSet, chosen: Trained) -> PipelineModel:
    """One model from request to label: preparation, classifier, label and error text."""
    category, price = MODEL_FEATURES[3], MODEL_FEATURES[2]
    unknown = len(data.preparation.categories)
    error = (
        f"CASE WHEN rfms_score IS NULL OR recency_score IS NULL OR _x_{price} IS NULL THEN 'missing or malformed number' "
        f"WHEN {category} IS NULL OR _i_{category} = {unknown} THEN 'unknown {category}' END"
    )
    outcome = SQLTransformer(
        statement=(
            "SELECT *, CASE WHEN _error IS NOT NULL THEN NULL WHEN prediction = 1 THEN 'Good' ELSE 'Bad' END AS risk_label "
            f"FROM (SELECT *, {error} AS _error FROM __THIS__)"
        )
    )
    return PipelineModel([*data.preparation.model.stages, chosen.model, outcome])

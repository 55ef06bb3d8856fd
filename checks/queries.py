"""Registered queries: every operator on the given tables, whole and unsampled."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorespark.functions.columns import count_if
from scorespark.functions.quantiles import quantile_table
from scorespark.operators import (
    binning,
    clusters,
    distributions,
    drift,
    features,
    metrics,
    models,
    outliers,
    profile,
    rfms,
    smote,
    split,
    woe,
)
from scorespark.operators.encoding import LabelEncoder
from scorespark.operators.scaling import Scaler
from scorespark.plans import evidence, training
from scorespark.plans.feature_table import build_feature_table
from scorespark.schema import MODEL_FEATURES, SCORING_REQUEST, SOURCE_NAMES
from scorespark.session import materialize, materialize_by_key, new_path, shuffles_freed
from scorespark.sources import transactions as files
from scorespark.sources import views
from scorespark.sources.artefacts import Artefacts
from scorespark.streaming.scoring import score_requests, score_stream

AS_OF = "2002-01-01 00:00:00"
EVENTS_AS_OF = "2024-02-01 00:00:00"
PERIODS = "2000-01-01 00:00:00"
NUMBERS = ("country_code", "amount", "value", "pricing_strategy", "fraud_result")
ROW_ORDER = ("txn_ts", "transaction_id", "provider_id", "product_id", "product_category", "value", "amount", "account_id")
ROW_KEY = ("transaction_id", "txn_ts", "product_id", "provider_id", "value")

MODEL_COLUMNS = tuple(dict.fromkeys((*ROW_KEY, *MODEL_FEATURES, "risk_label")))

# What describes a transaction or its customer, and the label.
DESCRIBING = (
    *NUMBERS, "currency_code", "provider_id", "product_id", "product_category", "channel_id",
    "recency_score", "frequency_score", "monetary_score", "std_score", "rfms_score", "risk_label",
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    """Register under the function's name, less the underscore that avoids a module's name."""
    QUERIES[f.__name__.rstrip("_")] = f
    return f


# A mean of amounts in cents can lie exactly between two rounded numbers.  A shift
# far above float noise makes both engines round such a tie to the same side.
TIE_SHIFT = {"average_transaction": 1e-7}


def rounded(df: DataFrame, places: int = 6, **other: int) -> DataFrame:
    """Doubles rounded for comparison between engines that add in different orders."""
    doubles = [n for n, t in df.dtypes if t == "double"]
    return df.withColumns(
        {c: F.round(F.col(c) + TIE_SHIFT[c] if c in TIE_SHIFT else F.col(c), other.get(c, places)) for c in doubles}
    )


def tx(spark: SparkSession, sf: str) -> DataFrame:
    return views.transactions(spark, sf)


def ev(spark: SparkSession, sf: str) -> DataFrame:
    return views.event_transactions(spark, sf)


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return rfms.customer_rfms(tx(spark, sf), as_of=AS_OF)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return rfms.score_rfms(customers(spark, sf))


def labelled(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return evidence.labelled_rows(tx(spark, sf), as_of=AS_OF, columns=columns or None)


def model_set(spark: SparkSession, sf: str) -> models.TrainingSet:
    return training.training_set(tx(spark, sf), as_of=AS_OF, by=ROW_KEY)


# The search of a folder's models, made once a session: several queries ask for parts of it.
_SEARCHES: dict = {}


def searched(spark: SparkSession, sf: str) -> tuple[models.TrainingSet, list[models.Trained], list[tuple[str, str, float]], DataFrame]:
    """Training set, the best setting of every learner with the best one's model, all settings tried, and the labelled rows behind them, stored."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SEARCHES:
        rows = labelled(spark, sf, *MODEL_COLUMNS)
        data = models.TrainingSet.build(training.model_rows(rows, keep=ROW_KEY), by=ROW_KEY)
        _SEARCHES[key] = (data, *models.grid_search(data, refit="best"), rows)
    return _SEARCHES[key]


def requests_from(labelled_rows: DataFrame) -> DataFrame:
    return labelled_rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCORING_REQUEST.fields])


# ---- sources and sinks -----------------------------------------------------------------------


@query
def scan_transactions(spark, sf):
    path = new_path(spark, "csv")
    source = tx(spark, sf).withColumn("txn_ts", F.date_format("txn_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    named = source.withColumnsRenamed({ours: theirs for theirs, ours in SOURCE_NAMES.items()})
    files.write_table(named.select(*SOURCE_NAMES), path, fmt="csv")
    return files.read_transactions(spark, path)


@query
def first_rows(spark, sf):
    return files.first_rows(tx(spark, sf), *ROW_ORDER, n=5)


# Fixed value: rows whose features are joined and written at once, or a sixteenth of all if that is more.
FEATURE_ROWS = 8_000_000


@query
def write_features(spark, sf):
    path = new_path(spark, "features")
    with shuffles_freed(spark):
        # Whole rows cross a shuffle by customer and one by month: those of some customers are gone before the next ones' begin.
        for i, rows in enumerate(materialize_by_key(tx(spark, sf), "customer_id", "transactions", part_rows=FEATURE_ROWS)):
            joined = features.with_customer_aggregates(rows)
            # The parts follow from the time: they are added behind the join's shuffle, and put before the aggregates.
            aggregates = features.customer_aggregates(rows).columns[1:]
            dated = features.add_date_parts(joined)
            table = dated.select(*[c for c in dated.columns if c not in aggregates], *aggregates)
            files.write_table(table, path, partition_by=("year", "month"), mode="append" if i else "overwrite", compression="zstd")
    # Folder values are given their type here rather than guessed from the folder names.
    stored = spark.read.schema(table.schema).parquet(path)
    return rounded(stored, 4)


@query
def artefact_roundtrip(spark, sf):
    path = new_path(spark, "artefacts")
    texts = ("currency_code", "provider_id", "product_id", "product_category", "channel_id")
    rows = labelled(spark, sf, *dict.fromkeys((*MODEL_COLUMNS, *NUMBERS, *texts)))
    data = models.TrainingSet.build(training.model_rows(rows, keep=ROW_KEY), by=ROW_KEY)
    saved = Artefacts(
        Scaler.fit(rows, NUMBERS),
        LabelEncoder.fit(rows, texts),
        training.fit_scoring_model(data, max_depth=5),
        binning.QuantileBins.fit(rows, NUMBERS, cut=False),
    )
    saved.save(spark, path)
    loaded = Artefacts.load(spark, path)
    same = score_requests(requests_from(rows), loaded.model).groupBy("risk_label").count()
    scaler = loaded.scaler.table(spark)
    numbers = scaler.select(F.lit("scaler").alias("kind"), "variable", F.lit("mean").alias("item"), F.col("mean").alias("number"))
    spread = scaler.select(F.lit("scaler"), "variable", F.lit("deviation"), "std")
    codes = loaded.encoder.dictionary.select(F.lit("encoder"), "variable", "value", F.col("code").cast("double"))
    edges = [("bins", c, f"edge {i}", float(x)) for c, own in loaded.bins.edges.items() for i, x in enumerate(own)]
    edges = spark.createDataFrame(edges, "kind string, variable string, item string, number double")
    labels = same.select(F.lit("model"), F.lit("risk_label"), "risk_label", F.col("count").cast("double"))
    return rounded(numbers.union(spread).union(codes).union(edges).union(labels), 4)


# ---- projections and filters -----------------------------------------------------------------


@query
def parse_ts_lenient(spark, sf):
    text = F.when(F.col("product_category") == "error", "bad").otherwise(F.date_format("txn_ts", "yyyy-MM-dd HH:mm:ss"))
    rows = ev(spark, sf).select("transaction_id", text.alias("txn_ts"))
    return profile.parsed_moments(rows)


@query
def date_features(spark, sf):
    rows = features.add_date_parts(tx(spark, sf).select("transaction_id", "txn_ts"))
    return rows.select("transaction_id", "txn_ts", "hour", "day", "month", "year")


@query
def parse_ids(spark, sf):
    rows = features.parse_id_columns(tx(spark, sf))
    return rows.select("transaction_id", "batch_id", "account_id", "subscription_id", "customer_id", "provider_id", "product_id", "channel_id")


def with_gaps(spark, sf):
    """Events with missing categories and values."""
    return ev(spark, sf).withColumns(
        {
            "product_category": F.nullif("product_category", F.lit("error")),
            "value": F.when(F.col("value") >= 5, F.col("value")),
        }
    )


@query
def drop_missing(spark, sf):
    return features.drop_incomplete(with_gaps(spark, sf))


@query
def credit_debit_split(spark, sf):
    return rounded(features.direction_summary(ev(spark, sf)), 4)


@query
def customer_rows(spark, sf):
    return features.customer_rows(tx(spark, sf), "CustomerId_7")


@query
def encode_label(spark, sf):
    rows = rfms.risk_labels(tx(spark, sf), as_of=AS_OF)
    return features.encode_label(rows).select("customer_id", "label")


# ---- joins -----------------------------------------------------------------------------------


@query
def customer_aggregates_joined(spark, sf):
    return rounded(features.with_customer_aggregates(tx(spark, sf)), 4)


@query
def label_transactions(spark, sf):
    return training.label_transactions(tx(spark, sf), as_of=AS_OF)


# ---- aggregations ----------------------------------------------------------------------------


@query
def rfms_(spark, sf):
    return rounded(customers(spark, sf), 4)


@query
def customer_aggregates(spark, sf):
    return rounded(features.customer_aggregates(tx(spark, sf)), 4)


@query
def customer_profile(spark, sf):
    return rounded(features.customer_profile(ev(spark, sf), as_of=EVENTS_AS_OF), 4)


@query
def value_counts(spark, sf):
    return profile.value_counts(tx(spark, sf), "product_id")


@query
def distinct_values(spark, sf):
    return profile.distinct_values(with_gaps(spark, sf), "product_category")


@query
def cardinality(spark, sf):
    return profile.cardinality(tx(spark, sf))


@query
def describe_numeric(spark, sf):
    return rounded(profile.describe(tx(spark, sf)), 4)


@query
def overview(spark, sf):
    return profile.overview(tx(spark, sf))


@query
def hourly_counts(spark, sf):
    return profile.hourly_counts(ev(spark, sf))


@query
def weekday_counts(spark, sf):
    return profile.weekday_counts(tx(spark, sf))


@query
def daily_counts(spark, sf):
    return profile.daily_counts(tx(spark, sf))


@query
def quantiles(spark, sf):
    return rounded(quantile_table(tx(spark, sf), ["amount", "value"], [0.05, 0.25, 0.5, 0.55, 0.75, 0.95]))


@query
def correlation_long(spark, sf):
    return rounded(profile.correlation(features.add_date_parts(tx(spark, sf))))


@query
def missing_values(spark, sf):
    return rounded(profile.missing_values(with_gaps(spark, sf)))


@query
def outliers_value(spark, sf):
    return rounded(outliers.value_outliers(ev(spark, sf)))


@query
def outliers_amount_split(spark, sf):
    return rounded(outliers.amount_outliers(ev(spark, sf)))


@query
def top_outliers(spark, sf):
    return outliers.top_outliers(ev(spark, sf))


@query
def customer_accounts(spark, sf):
    return features.account_counts(features.customer_rows(tx(spark, sf), "CustomerId_7"))


@query
def account_samples(spark, sf):
    return features.account_samples(tx(spark, sf), order=ROW_ORDER)


@query
def top_categories(spark, sf):
    return profile.top_categories(tx(spark, sf))


@query
def top_customer_accounts(spark, sf):
    rows = tx(spark, sf)
    return features.account_counts(rows.where(F.col("customer_id") == features.top_customer(rows)))


# ---- scores and labels -----------------------------------------------------------------------


@query
def equal_width_scores(spark, sf):
    return scored(spark, sf).select("customer_id", "recency_score", "frequency_score", "monetary_score", "std_score")


@query
def rfms_scores(spark, sf):
    return scored(spark, sf).select("customer_id", "rfms_score")


@query
def quantile_scores(spark, sf):
    table = rfms.score_rfms(materialize(customers(spark, sf), "rfms"), method="quantile")
    return table.select("customer_id", "frequency_score", "monetary_score", "std_score")


@query
def risk_labels(spark, sf):
    return rounded(rfms.risk_labels(tx(spark, sf), as_of=AS_OF), 4, rfms_score=10)


@query
def risk_labels_events(spark, sf):
    rows = rfms.risk_labels(ev(spark, sf), as_of=EVENTS_AS_OF)
    return rows.select("customer_id", "recency_score", "frequency_score", "rfms_score", "risk_label")


@query
def label_boundary(spark, sf):
    return rounded(rfms.label_boundary(scored(spark, sf)), 8)


@query
def label_counts(spark, sf):
    return rfms.risk_labels(tx(spark, sf), as_of=AS_OF).groupBy("risk_label").agg(F.count(F.lit(1)).alias("n"))


# ---- bins, weight of evidence, information value ---------------------------------------------


@query
def quantile_bins(spark, sf):
    return rounded(binning.QuantileBins.fit(tx(spark, sf)).table(spark).drop("label"))


@query
def categorical_bin_columns(spark, sf):
    return binning.categorical_bin_columns(tx(spark, sf), ignore=evidence.NOT_BINNED)


def numeric_bins(spark, sf):
    rows = labelled(spark, sf)
    return rows, binning.QuantileBins.fit(rows, cut=False)


@query
def woe_counts_numeric(spark, sf):
    return rounded(woe.numeric_counts(*numeric_bins(spark, sf)).drop("label"))


@query
def woe_counts_categorical(spark, sf):
    table = woe.categorical_counts(labelled(spark, sf), ignore=evidence.NOT_BINNED)
    return table.select("variable", "bin_id", "label", "good", "bad")


@query
def woe_numeric(spark, sf):
    table = evidence.build_evidence(labelled(spark, sf)).numeric
    return rounded(table.select("variable", "bin_id", "good", "bad", "woe", "iv_part"))


@query
def woe_categorical(spark, sf):
    table = evidence.build_evidence(labelled(spark, sf)).categorical
    return rounded(table.select("variable", F.col("label").alias("bin"), "good", "bad", "woe", "iv_part"))


@query
def bad_rate(spark, sf):
    e = evidence.build_evidence(labelled(spark, sf))
    return rounded(e.numeric.unionByName(e.categorical).select("variable", "bin_id", "bad_rate"))


@query
def iv_numeric(spark, sf):
    e = evidence.build_evidence(labelled(spark, sf))
    return rounded(woe.information_value(e.numeric, variables=e.numeric_names))


@query
def iv_categorical(spark, sf):
    return rounded(woe.information_value(evidence.build_evidence(labelled(spark, sf)).categorical))


@query
def iv_strength(spark, sf):
    e = evidence.build_evidence(labelled(spark, sf))
    both = e.numeric.unionByName(e.categorical)
    return rounded(woe.iv_strength(woe.information_value(both)))


@query
def woe_report(spark, sf):
    return rounded(woe.woe_report(evidence.build_evidence(labelled(spark, sf)).numeric, "amount"))


@query
def woe_transform(spark, sf):
    """Every variable of every row replaced by its evidence, a row each."""
    rows = evidence.labelled_rows(tx(spark, sf), as_of=AS_OF, columns=[*DESCRIBING, "transaction_id"])
    e = evidence.build_evidence(rows)
    encoder = woe.EvidenceEncoder.fit(rounded(e.numeric), rounded(e.categorical), e.bins)  # a few bins are rounded, not every value
    replaced = encoder.transform(rows).select("transaction_id", *[F.col(o).alias(v) for v, o in zip(encoder.variables, encoder.outputs)])
    return replaced.unpivot(["transaction_id"], encoder.variables, "variable", "woe")


@query
def woe_by_segment(spark, sf):
    table = evidence.segment_evidence(labelled(spark, sf), "product_category")
    return rounded(table.select("product_category", "variable", "bin_id", "lower", "upper", "good", "bad", "bad_rate", "woe"))


@query
def iv_by_segment(spark, sf):
    table = evidence.segment_evidence(labelled(spark, sf), "product_category")
    return rounded(woe.information_value(table, by=["product_category"]))


@query
def scorecard_roundtrip(spark, sf):
    """A scorecard on the evidence of all variables, before saving, after loading, and over a stream: rows, and rows with equal answers."""
    path, arriving, out = (new_path(spark, n) for n in ("scorecard", "arriving", "scored"))
    rows = evidence.labelled_rows(tx(spark, sf), as_of=AS_OF, number="_row", path=arriving)
    e = evidence.build_evidence(rows, ignore=[*evidence.NOT_BINNED, "_row"])
    model = evidence.fit_scorecard(e)
    model.write().save(path)
    loaded = PipelineModel.load(path)
    stream = loaded.transform(spark.readStream.schema(rows.schema).parquet(arriving)).select("_row", "predicted_label")
    running = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", new_path(spark, "progress"))
    running.trigger(availableNow=True).start().awaitTermination()
    before = model.transform(rows).select("_row", F.col("predicted_label").alias("before"))
    after = spark.read.parquet(out).join(before, "_row")
    return after.agg(F.count(F.lit(1)).alias("n"), count_if(F.col("before") == F.col("predicted_label")).alias("n_equal"))


# ---- scaling and encoding --------------------------------------------------------------------


@query
def standardize(spark, sf):
    rows = tx(spark, sf).select("transaction_id", *NUMBERS)
    return rounded(Scaler.fit(rows).transform(rows))


@query
def scaler_params(spark, sf):
    return rounded(Scaler.fit(tx(spark, sf)).table(spark), 4)


@query
def label_encode(spark, sf):
    rows = tx(spark, sf).select("transaction_id", "product_id", "product_category", "channel_id")
    return LabelEncoder.fit(rows, ["product_id", "product_category", "channel_id"]).transform(rows)


@query
def label_encode_many(spark, sf):
    """Codes of columns with very many values, ranked in ranges."""
    rows = tx(spark, sf).select("transaction_id", "account_id")
    encoder = LabelEncoder.fit(rows, window_values=1_000)
    return encoder.transform(rows)


@query
def feature_table(spark, sf):
    return rounded(build_feature_table(tx(spark, sf)).rows, 4)


# ---- models ----------------------------------------------------------------------------------


@query
def stratified_split(spark, sf):
    rows = tx(spark, sf).select("transaction_id", "product_id", "value")
    return split.split_rows(rows, ["transaction_id", "product_id"])


@query
def exact_stratified_split(spark, sf):
    rows = rfms.risk_labels(tx(spark, sf), as_of=AS_OF).select("customer_id", "risk_label")
    stored = materialize(rows, "labels")
    return split.split_rows_exactly(stored, ["customer_id"], label="risk_label", labels=["Good", "Bad"])


@query
def class_weights(spark, sf):
    rows = features.encode_label(rfms.risk_labels(tx(spark, sf), as_of=AS_OF))
    return rounded(split.class_weights(rows))


@query
def smote_rows(spark, sf):
    rows = labelled(spark, sf, *MODEL_COLUMNS)
    coded = LabelEncoder.fit(rows, ["product_category"]).transform(rows)
    return smote.synthetic_rows(training.model_rows(coded), MODEL_FEATURES)


@query
def train_models(spark, sf):
    data = model_set(spark, sf)
    return models.evaluate(data, models.train_models(data))


@query
def grid_search(spark, sf):
    _, _, tried, _ = searched(spark, sf)
    return spark.createDataFrame(tried, "model string, settings string, accuracy double")


@query
def best_model(spark, sf):
    data, best, _, _ = searched(spark, sf)
    chosen = models.best_model(best)
    return models.evaluate(data, [chosen]).withColumn("cv_accuracy", F.lit(chosen.cv_accuracy))


@query
def winner_scoring(spark, sf):
    """The best model of the search as a stored version, loaded again, over all requests."""
    data, best, _, rows = searched(spark, sf)
    chosen = models.best_model(best)
    path = new_path(spark, "winner")
    Artefacts(
        Scaler.fit(rows, MODEL_FEATURES[:3]), LabelEncoder.fit(rows, MODEL_FEATURES[3:]), models.scoring_model(data, chosen), settings=chosen.settings
    ).save(spark, path)
    model = Artefacts.load(spark, path).model
    return score_requests(requests_from(rows), model).groupBy(*MODEL_FEATURES, "risk_label", "_error").agg(F.count(F.lit(1)).alias("n"))


@query
def training_parts(spark, sf):
    """Rows of each label in the test part and in every fold of the training part."""
    data = model_set(spark, sf)
    return data.train.unionByName(data.test).groupBy("label", "part", "fold").agg(F.sum("n").alias("n"))


@query
def synthetic_training(spark, sf):
    """Rows of each label in every fold after synthetic rows, and whether all lie within the range of their label's own rows."""
    data = training.training_set(tx(spark, sf), as_of=AS_OF, by=ROW_KEY, balance="synthetic")
    points = data.train.withColumn("x", vector_to_array("features"))
    place = range(len(MODEL_FEATURES))
    own = F.col("rfms_score").isNotNull()
    within = [(F.min(F.col("x")[i]) >= F.min(F.when(own, F.col("x")[i])) - 1e-9) & (F.max(F.col("x")[i]) <= F.max(F.when(own, F.col("x")[i])) + 1e-9) for i in place]
    return points.groupBy("label", "fold").agg(F.sum("n").alias("n"), functools.reduce(lambda a, b: a & b, within).alias("within"))


@query
def classification_metrics(spark, sf):
    rows = features.encode_label(labelled(spark, sf, "value", "risk_label"))
    judged = rows.select(
        "label",
        (F.col("value") / (F.col("value") + 50000.0)).alias("probability_good"),
        F.when(F.col("value") > 50000, 1).otherwise(0).alias("prediction"),
    )
    return rounded(metrics.classification_metrics(judged))


@query
def batch_scoring(spark, sf):
    rows = labelled(spark, sf, *MODEL_COLUMNS)
    data = models.TrainingSet.build(training.model_rows(rows, keep=ROW_KEY), by=ROW_KEY)
    model = training.fit_scoring_model(data, max_depth=5)
    return score_requests(requests_from(rows), model).groupBy(*MODEL_FEATURES, "risk_label", "_error").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_scoring(spark, sf):
    """New order lines as a stream, scored with their customer's stored scores."""
    scores = training.stored_scores(tx(spark, sf), as_of=AS_OF)
    rows = evidence.labelled_rows(tx(spark, sf), as_of=AS_OF, columns=MODEL_COLUMNS, scores=scores)
    data = models.TrainingSet.build(training.model_rows(rows, keep=ROW_KEY), by=ROW_KEY)
    model = training.fit_scoring_model(data, max_depth=5)
    known = scores.select("customer_id", "recency_score", "rfms_score")
    tables = {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in ("lineitem", "orders", "part")}
    arriving = spark.readStream.schema(tables["lineitem"].schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    stream = views.transactions_from(arriving, tables["orders"], tables["part"]).join(known, "customer_id", "left")
    path = new_path(spark, "scored")
    running = score_stream(requests_from(stream), model, path=path, checkpoint=new_path(spark, "progress"), until_done=True)
    running.awaitTermination()
    return spark.read.parquet(path).groupBy(*MODEL_FEATURES, "risk_label", "_error").agg(F.count(F.lit(1)).alias("n"))


@query
def kmeans_2d(spark, sf):
    rows = clusters.cluster_labels(materialize(scored(spark, sf), "scores"))
    return rows.select("customer_id", "rfms_score", "monetary_score", "cluster_label")


@query
def kmeans_1d_boundary(spark, sf):
    row = clusters.cluster_boundary(scored(spark, sf))
    return rounded(spark.createDataFrame([row], "lower_centre double, upper_centre double, boundary double"))


@query
def label_method_comparison(spark, sf):
    return clusters.label_method_comparison(scored(spark, sf))


@query
def high_risk_cluster(spark, sf):
    return clusters.high_risk_customers(customers(spark, sf)).select("customer_id", "recency", "frequency", "monetary", "is_high_risk")


# ---- distributions ---------------------------------------------------------------------------


@query
def histogram_linear(spark, sf):
    return rounded(distributions.histogram(tx(spark, sf), columns=NUMBERS))


@query
def histogram_log(spark, sf):
    return rounded(distributions.log_histogram(ev(spark, sf)))


@query
def histogram_credit_debit(spark, sf):
    return rounded(distributions.credit_debit_histogram(ev(spark, sf)))


@query
def boxplot_stats(spark, sf):
    amount = F.col("amount")
    rows = ev(spark, sf).withColumns({"credit": F.when(amount < 0, -amount), "debit": F.when(amount >= 0, amount)})
    return rounded(outliers.boxplot_stats(rows, "value", "credit", "debit"))


@query
def density_curve(spark, sf):
    """Densities times the distance of two points, which makes them comparable between variables."""
    curves = distributions.all_densities(tx(spark, sf), columns=NUMBERS)
    step = (F.max("x").over(Window.partitionBy("variable", "axis")) - F.min("x").over(Window.partitionBy("variable", "axis"))) / 49
    return rounded(curves.select("variable", "axis", "point", "x", (F.col("density") * step).alias("mass")), 8, mass=5)


@query
def score_scatter(spark, sf):
    return distributions.score_scatter(scored(spark, sf))


# ---- features the reports describe -----------------------------------------------------------


@query
def account_flow_features(spark, sf):
    return rounded(features.account_flow(tx(spark, sf)))


@query
def log_and_cap(spark, sf):
    rows = ev(spark, sf)
    f = outliers.fences(rows, "value")["value"]
    return rounded(features.log_and_cap(rows, "value", f.low, f.high).select("transaction_id", "log_value", "capped_value"))


@query
def user_tier(spark, sf):
    return features.user_tier(ev(spark, sf)).groupBy("user_tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("volume"))


@query
def group_rare(spark, sf):
    return features.group_rare(tx(spark, sf), "product_id", keep=5).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))


@query
def interaction_terms(spark, sf):
    rows = tx(spark, sf)
    categories = sorted(r[0] for r in rows.select("product_category").distinct().collect())
    crossed = features.category_interactions(rows, categories)
    return crossed.select("transaction_id", "product_category", *[f"amount_x_{c}" for c in categories])


@query
def interaction_vectors(spark, sf):
    rows = tx(spark, sf).select("transaction_id", "product_id", "amount")
    crossed = features.interaction_vectors(rows, LabelEncoder.fit(rows, ["product_id"]), category="product_id")
    return crossed.select("transaction_id", "product_id", "interaction.*")


@query
def accounts_per_customer(spark, sf):
    return features.accounts_per_customer(tx(spark, sf))


@query
def channel_drift(spark, sf):
    cut = F.lit(PERIODS).cast("timestamp_ntz")
    table = drift.category_drift(tx(spark, sf), "channel_id", before=F.col("txn_ts") < cut, after=F.col("txn_ts") >= cut)
    return rounded(table, 8)


@query
def channel_drift_index(spark, sf):
    cut = F.lit(PERIODS).cast("timestamp_ntz")
    table = drift.category_drift(tx(spark, sf), "channel_id", before=F.col("txn_ts") < cut, after=F.col("txn_ts") >= cut)
    return rounded(drift.stability_index(table), 8)

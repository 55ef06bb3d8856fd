import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorespark.functions.columns import parse_id, parse_timestamp
from scorespark.operators import binning, drift, features, metrics, outliers, profile, rfms, split, woe
from scorespark.operators.encoding import LabelEncoder
from scorespark.operators.scaling import Scaler
from scorespark.sources.transactions import read_transactions, write_table

COLUMNS = "customer_id string, transaction_id string, value double, amount double, txn_ts timestamp_ntz"


def day(n, hour=0):
    return dt.datetime(2020, 1, n, hour)


def txns(spark, rows):
    return spark.createDataFrame([(c, t, v, v, d) for c, t, v, d in rows], COLUMNS)


def test_single_transaction(spark):
    df = txns(spark, [("a", "t1", 5.0, day(1))])
    assert rfms.customer_rfms(df, as_of="2020-01-03").first()["std_deviation"] == 0.0
    assert features.customer_aggregates(df).first()["std_transaction"] is None


def test_recency_rounds_down(spark):
    df = txns(spark, [("a", "t1", 5.0, day(2, 6)), ("b", "t2", 5.0, day(1, 1))])
    got = {r["customer_id"]: r["recency"] for r in rfms.customer_rfms(df, as_of="2020-01-02 00:00:00").collect()}
    assert got == {"a": -1, "b": 0}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_recency_in_other_time_zones(spark, zone):
    moments = [dt.datetime(2020, 3, 7, 12), dt.datetime(2020, 3, 7, 12, 0, 0, 1), dt.datetime(2020, 3, 10, 11, 59), dt.datetime(2020, 10, 31, 12)]
    df = txns(spark, [(f"c{i}", "t", 1.0, m) for i, m in enumerate(moments)])
    as_of = dt.datetime(2020, 3, 9, 12)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r["customer_id"]: r["recency"] for r in rfms.customer_rfms(df, as_of=as_of).collect()}
        assert got == {f"c{i}": (as_of - m).days for i, m in enumerate(moments)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_customers_without_name_are_left_out(spark):
    df = txns(spark, [(None, "t1", 5.0, day(2)), ("b", None, None, day(1))])
    (row,) = rfms.customer_rfms(df, as_of="2020-01-02").collect()
    assert (row["customer_id"], row["frequency"], row["monetary"]) == ("b", 0, 0.0)


def test_equal_customers_score_three(spark):
    df = txns(spark, [(c, c, 7.0, day(1)) for c in "abc"])
    scored = rfms.score_rfms(rfms.customer_rfms(df, as_of="2020-01-02"))
    assert {tuple(r)[5:] for r in scored.collect()} == {(3.0, 3.0, 3.0, 3.0, 3.0)}


def labels(spark, scores, **options):
    df = spark.createDataFrame([(float(s),) for s in scores], "rfms_score double")
    return [r["risk_label"] for r in rfms.label_scores(df, **options).orderBy("rfms_score").collect()]


def test_label_tie(spark):
    assert labels(spark, [1, 2, 2.1, 2.1, 3]) == ["Bad"] * 4 + ["Good"]


def test_label_degenerate(spark):
    assert labels(spark, [7, 7, 7, 8]) == ["Bad"] * 3 + ["Good"]
    with pytest.raises(Exception, match="leaves one label empty"):
        labels(spark, [7, 7, 7, 8], strict=True)
    assert labels(spark, [1, 2, 2.1, 2.1, 3], strict=True) == ["Bad"] * 4 + ["Good"]


def test_equal_sums_of_weights_are_equal(spark):
    parts = [(r, f, m, s) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6) for s in range(1, 6)]
    rows = [(str(i), 6 - r, f, float(m), float(6 - s)) for i, (r, f, m, s) in enumerate(parts)]
    df = spark.createDataFrame(rows, "customer_id string, recency bigint, frequency bigint, monetary double, std_deviation double")
    got = rfms.score_rfms(df).collect()
    assert len({r["rfms_score"] for r in got}) == 41
    for r in got:
        exact = (r["recency_score"] + 2 * r["frequency_score"] + 5 * r["monetary_score"] + 2 * r["std_score"]) / 10
        assert r["rfms_score"] == exact


def test_other_weights(spark):
    df = spark.createDataFrame([("a", 1, 1, 1.0, 1.0), ("b", 2, 2, 2.0, 2.0)], "customer_id string, recency bigint, frequency bigint, monetary double, std_deviation double")
    got = {r["customer_id"]: r["rfms_score"] for r in rfms.score_rfms(df, weights=[1, 0, 0, 0]).collect()}
    assert got == {"a": 5.0, "b": 1.0}


def test_one_class(spark):
    df = spark.createDataFrame([(float(i), "Good") for i in range(10)], "x double, risk_label string")
    bins = binning.QuantileBins.fit(df, ["x"])
    table = woe.woe_table(woe.numeric_counts(df, bins))
    rows = table.collect()
    assert all(r["bad_rate"] == 0.0 and r["woe"] is not None for r in rows)
    assert woe.information_value(table).first()["iv"] is not None


def test_null_bins_and_constants(spark):
    rows = [(1.0, 7.0, "a", "Good"), (2.0, 7.0, "a", "Bad"), (None, 7.0, None, "Good"), (3.0, 7.0, "b", None)]
    df = spark.createDataFrame(rows, "x double, k double, c string, risk_label string")
    bins = binning.QuantileBins.fit(df, ["x", "k"])
    counts = woe.numeric_counts(df, bins)
    assert counts.agg(F.sum("total")).first()[0] == 2
    assert {r["variable"] for r in counts.collect()} == {"x"}
    cats = woe.categorical_counts(df)
    assert [(r["label"], r["good"], r["bad"]) for r in cats.collect()] == [("a", 1, 1)]
    iv = woe.information_value(woe.woe_table(counts), variables=["x", "k"]).collect()
    assert {r["variable"]: r["iv"] for r in iv}["k"] == 0.0


def test_empty_bins_on_request(spark):
    df = spark.createDataFrame([(float(i), "Good" if i > 2 else None) for i in range(10)], "x double, risk_label string")
    bins = binning.QuantileBins({"x": [0.0, 1.0, 5.0, 9.0]})
    assert woe.numeric_counts(df, bins).count() == 2
    assert woe.numeric_counts(df, bins, include_empty=True).count() == 3


def test_other_label_values(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0), (3.0, 1)], "x double, y int")
    counts = woe.numeric_counts(df, binning.QuantileBins.fit(df, ["x"], n_bins=1), label="y", good=1, bad=0)
    assert tuple(counts.select("good", "bad").first()) == (2, 1)


def test_woe_identities(spark, folder):
    from scorespark.plans.evidence import build_evidence, labelled_rows
    from scorespark.sources.views import transactions

    e = build_evidence(labelled_rows(transactions(spark, folder), as_of="2002-01-01 00:00:00"))
    rows = e.rows.count()
    for r in e.numeric.unionByName(e.categorical).groupBy("variable").agg(F.sum("total").alias("n")).collect():
        assert r["n"] == rows
    assert all(r["iv"] >= -1e-3 for r in woe.information_value(e.numeric).collect())


def test_category_limit(spark):
    rows = [(f"v{i % 11}", f"w{i % 10}", f"id{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "eleven string, ten string, many string")
    got = {r["variable"]: r["n_values"] for r in binning.categorical_bin_columns(df).collect()}
    assert got == {"ten": 10}


def test_ids(spark):
    df = spark.createDataFrame([("ax",), ("a_x",), ("P_17_3",), ("P_5",), (None,)], "c string")
    assert [r[0] for r in df.select(parse_id("c")).collect()] == [None, None, 17, 5, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_timestamps(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("bad",), ("2018-11-15T02:18:49Z",), (None,)], "t string")
        got = [r[0] for r in df.select(parse_timestamp("t", strict=False)).collect()]
        assert got == [None, dt.datetime(2018, 11, 15, 2, 18, 49), None]
        with pytest.raises(Exception, match="not a timestamp"):
            df.select(parse_timestamp("t")).collect()
        assert df.where("t <> 'bad'").select(F.hour(parse_timestamp("t"))).first()[0] == 2
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_date_parts_from_text(spark):
    df = spark.createDataFrame([("2018-11-15T02:18:49Z",)], "when string")
    assert tuple(features.add_date_parts(df, ts="when").first())[1:] == (2, 15, 11, 2018)


def test_csv_source(spark, tmp_path):
    head = "TransactionId,BatchId,AccountId,SubscriptionId,CustomerId,CurrencyCode,CountryCode,ProviderId,ProductId,ProductCategory,ChannelId,Amount,Value,TransactionStartTime,PricingStrategy,FraudResult\n"
    line = "TransactionId_1,BatchId_1,AccountId_1,SubscriptionId_1,CustomerId_1,UGX,256,ProviderId_1,ProductId_1,airtime,ChannelId_1,NaN,5,2018-11-15T02:18:49Z,2,0\n"
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text(head + line)
    bad.write_text(head + line.replace(",256,", ",x,"))
    row = read_transactions(spark, str(good)).first()
    assert row["amount"] is None and row["value"] == 5.0 and row["txn_ts"] == dt.datetime(2018, 11, 15, 2, 18, 49)
    with pytest.raises(Exception):
        read_transactions(spark, str(bad)).collect()


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    write_table(df, str(tmp_path / "out"), fmt="csv")
    back = spark.read.schema("n int, s string").option("header", True).csv(str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, None)]


def test_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "x double, s string")
    assert [r["s"] for r in features.drop_incomplete(df).collect()] == ["a"]


def test_unknown_customer(spark):
    df = txns(spark, [("a", "t1", 5.0, day(1))])
    assert features.customer_rows(df, "zzz").count() == 0
    with pytest.raises(KeyError):
        features.customer_rows(df.drop("customer_id"), "a")


def test_label_codes(spark):
    df = spark.createDataFrame([("Good",), ("Bad",)], "risk_label string")
    assert sorted(r["label"] for r in features.encode_label(df).collect()) == [0, 1]
    with pytest.raises(Exception, match="unknown label"):
        features.encode_label(df.union(spark.createDataFrame([(None,)], "risk_label string"))).collect()


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (None, 7.0), (3.0, 7.0)], "x double, k double")
    scaled = Scaler.fit(df).transform(df).toPandas()
    assert abs(scaled.x.mean()) < 1e-12 and abs(scaled.x.std(ddof=0) - 1) < 1e-12
    assert scaled.x.isna().sum() == 1 and set(scaled.k) == {0.0}
    again = Scaler.from_table(Scaler.fit(df).table(spark))
    assert again.transform(df).toPandas().equals(scaled)


def test_encoder(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("B", None)], "c string, d string")
    for window in (1_000_000, 1):
        encoder = LabelEncoder.fit(df, window_values=window)
        got = {(r["c"], r["d"]) for r in encoder.transform(df).collect()}
        assert got == {(2, 0), (1, 0), (0, None)}
    other = spark.createDataFrame([("z", "x")], "c string, d string")
    with pytest.raises(Exception, match="unseen value"):
        encoder.transform(other).collect()
    assert encoder.transform(other, unseen="null").first()["c"] is None


def test_correlation_with_gaps_and_constants(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 5.0, 5.0), (4.0, 9.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, k double")
    got = {(r["x"], r["y"]): r["correlation"] for r in profile.correlation(df).collect()}
    expected = df.toPandas().corr()
    assert abs(got["a", "b"] - expected.loc["a", "b"]) < 1e-12
    assert got["a", "k"] is None and got["k", "k"] is None and got["a", "a"] == 1.0
    assert profile.correlation(df.select("a")).count() == 0


def test_missing_and_overview(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "a int, b string")
    (row,) = profile.missing_values(df).collect()
    assert (row["variable"], row["n_missing"], round(row["percent"], 4)) == ("b", 2, 66.6667)
    assert [tuple(r) for r in profile.overview(df).collect()] == [(1, "a", "int", 3, 3), (2, "b", "string", 3, 1)]


def test_weekdays_without_rows(spark):
    df = txns(spark, [("a", "t1", 5.0, day(1)), ("a", "t2", 5.0, day(1))])
    got = {r["weekday"]: r["n"] for r in profile.weekday_counts(df).collect()}
    assert got["Wednesday"] == 2 and sum(got.values()) == 2 and len(got) == 7


def test_outliers_of_one_sign(spark):
    df = txns(spark, [("a", f"t{i}", float(i), day(1)) for i in range(20)] + [("a", "t99", 500.0, day(1))])
    (row,) = outliers.amount_outliers(df).collect()
    assert (row["part"], row["n_outliers"]) == ("debit", 1)


def test_metrics_undefined(spark):
    df = spark.createDataFrame([(1, 0, 0.4), (0, 0, 0.2), (0, 0, 0.6)], "label int, prediction int, probability_good double")
    row = metrics.classification_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert abs(row["accuracy"] - 2 / 3) < 1e-12 and row["roc_auc"] == 0.5


def test_exact_split(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    marked = split.split_rows_exactly(df, ["id"], label="y", labels=[0, 1])
    got = {(r["y"], r["part"]): r["count"] for r in marked.groupBy("y", "part").count().collect()}
    assert got == {(0, "test"): 225, (0, "train"): 525, (1, "test"): 75, (1, "train"): 175}


def test_drift_of_equal_shares(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), ("b", 2), ("c", 2)], "c string, p int")
    same = drift.category_drift(df.where("c <> 'c'"), "c", before=F.col("p") == 1, after=F.col("p") == 2)
    assert drift.stability_index(same).first()["psi"] == 0.0
    shifted = drift.category_drift(df, "c", before=F.col("p") == 1, after=F.col("p") == 2)
    assert drift.stability_index(shifted).first()["psi"] > 1.0

"""Plans that must hold when one key owns a third of all rows."""

import os
import time

import pytest
from pyspark.sql import functions as F

from scorespark.functions.quantiles import exact_quantiles, quantile_table
from scorespark.operators import features, profile
from scorespark.operators.binning import QuantileBins
from scorespark.operators.joins import attach
from scorespark.operators.rfms import risk_labels
from scorespark.plans import training
from scorespark.plans.feature_table import build_feature_table
from scorespark.session import materialize_by_key
from scorespark.sources.views import transactions, transactions_from


@pytest.fixture
def no_broadcast(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, n=200_000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 5000))
    return spark.range(0, n, 1, 16).select(
        key.alias("customer_id"),
        F.concat(F.lit("t"), F.col("id")).alias("transaction_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        (F.col("id") % 97).cast("double").alias("amount"),
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_is_split(spark, no_broadcast):
    df = attach(hot_rows(spark), features.customer_aggregates(hot_rows(spark)))
    rows = df.collect()
    assert len(rows) == 200_000 and all(r["transaction_count"] is not None for r in rows)
    assert "skew=true" in plan_of(df)


def test_small_table_is_broadcast_by_its_size(spark):
    df = attach(hot_rows(spark), features.customer_aggregates(hot_rows(spark)))
    assert "BroadcastHashJoin" in plan_of(df) and "SortMergeJoin" not in plan_of(df)


def test_rank_filter_runs_before_the_shuffle(spark):
    rows = hot_rows(spark).withColumn("account_id", F.col("customer_id"))
    df = features.account_samples(rows, order=["transaction_id"])
    plan = plan_of(df)
    assert plan.count("WindowGroupLimit") == 2
    text = profile.top_categories(rows)
    assert plan_of(text).count("WindowGroupLimit") == 2


def test_labels_read_the_data_once(spark, folder):
    df = risk_labels(transactions(spark, folder), as_of="2002-01-01 00:00:00")
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")
    executed = "".join(final[i].split("== Final Plan ==")[-1] for i in range(len(final)))
    assert "ReusedExchange" in executed
    assert "CartesianProduct" not in executed and "NestedLoop" not in executed


def test_no_python_in_plans(spark, folder):
    from checks.queries import QUERIES

    for name in ("risk_labels", "customer_aggregates_joined", "describe_numeric", "top_categories", "account_flow_features"):
        plan = plan_of(QUERIES[name](spark, folder))
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("query", ["describe", "bins", "quantiles", "search"])
def test_quantiles_run_a_plan_once(spark, query):
    n, read = 4000, spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    numbers = spark.range(0, n, 1, 4).select((F.col("id") * 37 % 1009).cast("double").alias("x"), F.col("id").alias("y"))
    df = numbers.mapInArrow(counted, numbers.schema)
    if query == "describe":
        (row,) = profile.describe(df, columns=["x"]).collect()
        assert (row["count"], row["q50"]) == (n, sorted(i * 37 % 1009 for i in range(n))[n // 2])
    elif query == "bins":
        assert QuantileBins.fit(df).edges["y"][0] == 0.0
    elif query == "quantiles":
        assert quantile_table(df, ["y"], [0.0, 1.0]).count() == 2
    else:
        assert exact_quantiles(df, ["y"], [0.0, 0.5, 1.0], small_rows=50) == {"y": [0.0, (n - 1) / 2, n - 1.0]}
    assert read.value == n


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def order_lines(spark):
    lines = spark.sql(
        "SELECT id AS l_orderkey, id % 7 AS l_partkey, id % 11 AS l_suppkey, 1 AS l_linenumber, 1.0D * id AS l_extendedprice, 50.0D AS l_quantity, "
        "if(id % 3 = 0, NULL, 'R') AS l_returnflag, if(id % 5 = 0, NULL, 'O') AS l_linestatus, TIMESTAMP_NTZ'2001-01-01' AS l_shipdate FROM range(100)"
    )
    orders = spark.sql("SELECT id AS o_orderkey, id % 9 AS o_custkey, '1-URGENT' AS o_orderpriority FROM range(100)")
    return lines, orders, spark.sql("SELECT id AS p_partkey, concat('type', id) AS p_type FROM range(7)")


def test_lines_are_slim_before_their_joins(spark):
    df = transactions_from(*order_lines(spark))
    above = optimized(df).split("Join Inner")[0]
    assert not [c for c in ("l_returnflag", "l_linestatus", "l_quantity", "l_shipdate") if c in above]
    rows = {r["batch_id"]: r for r in df.collect()}
    assert [rows[f"BatchId_{i}"]["amount"] for i in (3, 4)] == [3.0, -4.0]
    assert [rows[f"BatchId_{i}"]["fraud_result"] for i in (5, 6)] == [0, 1]
    assert rows["BatchId_8"]["account_id"] == f"AccountId_{8 * 10 + 8 % 3}" and rows["BatchId_8"]["provider_id"] == f"ProviderId_{8 % 6 + 1}"


def test_features_turn_ids_into_numbers_before_the_join(spark):
    plan = optimized(build_feature_table(transactions_from(*order_lines(spark))).rows)
    assert "split(transaction_id" not in plan
    assert plan.index("split(concat(TransactionId_") > plan.index("Join LeftOuter, (customer_id")


def test_stored_scores_serve_several_joins(spark):
    rows = transactions_from(*order_lines(spark))
    scores = training.stored_scores(rows, as_of="2002-01-01 00:00:00")
    got = training.label_transactions(rows.limit(0), scores=scores)
    assert got.columns == training.label_transactions(rows, as_of="2002-01-01 00:00:00").columns
    again = training.label_transactions(rows, scores=scores)
    assert again.where("risk_label IS NULL").count() == 0 and again.count() == 100
    assert "Aggregate" not in optimized(again)


def test_date_parts_of_written_features_follow_the_join(spark, folder, monkeypatch):
    from checks import queries

    written = []
    monkeypatch.setattr(queries.files, "write_table", lambda df, path, **_: (written.append(df), df.limit(5).write.parquet(path)))
    queries.write_features(spark, folder)
    plan = optimized(written[0])
    assert plan.index("hour(") < plan.index("Join LeftOuter")
    assert written[0].columns[-8:] == ["hour", "day", "month", "year", "total_transaction", "average_transaction", "transaction_count", "std_transaction"]


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_written_features_leave_no_shuffle_files(spark, folder):
    from checks import queries

    before = shuffle_files(spark)
    queries.write_features(spark, folder)
    until = time.time() + 30  # files are removed in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_features_are_written_in_parts(spark, folder, monkeypatch):
    from checks import queries

    whole = sorted(queries.write_features(spark, folder).collect(), key=str)
    written, write = [], queries.files.write_table
    monkeypatch.setattr(queries, "FEATURE_ROWS", 1000)
    monkeypatch.setattr(queries.files, "write_table", lambda df, path, **how: (written.append(df), write(df, path, **how)))
    assert sorted(queries.write_features(spark, folder).collect(), key=str) == whole
    assert len(written) == 6 and all("l_orderkey" not in optimized(df) for df in written)


def test_rows_of_a_key_are_stored_in_one_part(spark):
    rows = hot_rows(spark, 6000).union(spark.sql("SELECT CAST(NULL AS STRING), 'n', 'n', NULL FROM range(300)"))
    parts = materialize_by_key(rows, "customer_id", part_rows=1000, most=4)
    keys = [{r[0] for r in part.select("customer_id").distinct().collect()} for part in parts]
    assert len(parts) == 4 and sum(map(len, keys)) == len(set.union(*keys)) == rows.select("customer_id").distinct().count()
    stored = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    assert stored.dtypes == rows.dtypes and stored.count() == 6300 and not stored.exceptAll(rows).count()
    (empty,) = materialize_by_key(rows.limit(0), "customer_id", part_rows=1000)
    assert empty.columns == rows.columns and not empty.count()


def test_lines_reach_their_orders_last(spark):
    """Lines of an order then lie side by side, and their equal texts make the shuffles behind smaller."""
    plan = optimized(transactions_from(*order_lines(spark)))
    assert plan.index("Join Inner, (l_orderkey") < plan.index("Join Inner, (l_partkey")


def test_search_keeps_its_labelled_rows(spark, folder, monkeypatch):
    from checks import queries

    monkeypatch.setattr(queries, "_SEARCHES", {})
    monkeypatch.setattr(queries.models, "grid_search", lambda data, **_: ([], []))
    rows = queries.searched(spark, folder)[-1]
    assert rows.columns == list(queries.MODEL_COLUMNS) and "Join" not in optimized(rows)

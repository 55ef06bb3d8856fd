"""Transaction tables derived from an order-line star schema and from an event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def numbered(name: str, number) -> F.Column:
    return F.concat(F.lit(f"{name}_"), number.cast("string"))


def transactions_from(lines: DataFrame, orders: DataFrame, parts: DataFrame) -> DataFrame:
    """Order lines as transactions.  Works on a batch or a streaming ``lines``.

    Columns are computed from a line alone before the joins, so that the
    shuffles carry numbers instead of texts.  Orders come last: lines of an order
    then lie side by side, and what they share compresses in the next shuffle.
    """
    line = F.col("l_linenumber")
    hour = ((F.col("l_orderkey") * 7 + line) % 24).cast("int")
    price = F.col("l_extendedprice")
    slim = lines.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice",
        (F.col("l_suppkey") % 6).alias("_supplier"),
        F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).alias("_returned"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=hour)).alias("_ts"),
        F.coalesce((F.col("l_linestatus") == "O") & (F.col("l_quantity") >= 49), F.lit(False)).alias("_fraud"),
    )
    joined = slim.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(
        numbered("TransactionId", F.col("l_orderkey") * 10 + line).alias("transaction_id"),
        numbered("BatchId", F.col("l_orderkey")).alias("batch_id"),
        numbered("AccountId", F.col("o_custkey") * 10 + F.col("_supplier") % 3).alias("account_id"),
        numbered("SubscriptionId", F.col("o_custkey") * 10 + line % 2).alias("subscription_id"),
        numbered("CustomerId", F.col("o_custkey")).alias("customer_id"),
        F.lit("UGX").alias("currency_code"),
        F.lit(256).alias("country_code"),
        numbered("ProviderId", F.col("_supplier") + 1).alias("provider_id"),
        numbered("ProductId", F.col("l_partkey") % 23 + 1).alias("product_id"),
        F.col("p_type").alias("product_category"),
        F.concat(F.lit("ChannelId_"), F.substring("o_orderpriority", 1, 1)).alias("channel_id"),
        F.when(F.col("_returned"), -price).otherwise(price).alias("amount"),
        price.alias("value"),
        F.col("_ts").alias("txn_ts"),
        (line % 5).cast("int").alias("pricing_strategy"),
        F.when(F.col("_fraud"), 1).otherwise(0).alias("fraud_result"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return transactions_from(table("lineitem"), table("orders"), table("part"))


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    return spark.read.parquet(f"{folder}/events.parquet").select(
        numbered("TransactionId", F.col("event_id")).alias("transaction_id"),
        numbered("CustomerId", F.col("user_id")).alias("customer_id"),
        F.col("event_type").alias("product_category"),
        F.when(F.col("event_type") == "error", -value).otherwise(value).alias("amount"),
        value.alias("value"),
        F.col("ts").alias("txn_ts"),
    )

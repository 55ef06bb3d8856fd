"""Table schemas and the names columns carry in source files."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the source files and of our tables.
SOURCE_NAMES = {
    "TransactionId": "transaction_id",
    "BatchId": "batch_id",
    "AccountId": "account_id",
    "SubscriptionId": "subscription_id",
    "CustomerId": "customer_id",
    "CurrencyCode": "currency_code",
    "CountryCode": "country_code",
    "ProviderId": "provider_id",
    "ProductId": "product_id",
    "ProductCategory": "product_category",
    "ChannelId": "channel_id",
    "Amount": "amount",
    "Value": "value",
    "TransactionStartTime": "txn_ts",
    "PricingStrategy": "pricing_strategy",
    "FraudResult": "fraud_result",
}

ID_COLUMNS = (
    "transaction_id",
    "batch_id",
    "account_id",
    "subscription_id",
    "customer_id",
    "provider_id",
    "product_id",
    "channel_id",
)

_INT = {"country_code", "pricing_strategy", "fraud_result"}
_DOUBLE = {"amount", "value"}


def _column_type(name: str) -> T.DataType:
    if name in _INT:
        return T.IntegerType()
    if name in _DOUBLE:
        return T.DoubleType()
    if name == "txn_ts":
        return T.TimestampNTZType()
    return T.StringType()


TRANSACTIONS = T.StructType(
    [T.StructField(name, _column_type(name)) for name in SOURCE_NAMES.values()]
)

# What a delimited source file holds: its own names, timestamps still as text.
SOURCE_FILE = T.StructType(
    [
        T.StructField(src, T.StringType() if name == "txn_ts" else _column_type(name))
        for src, name in SOURCE_NAMES.items()
    ]
)

SCORING_REQUEST = T.StructType(
    [
        T.StructField("rfms_score", T.DoubleType()),
        T.StructField("recency_score", T.DoubleType()),
        T.StructField("pricing_strategy", T.StringType()),
        T.StructField("product_category", T.StringType()),
    ]
)

MODEL_FEATURES = ("rfms_score", "recency_score", "pricing_strategy", "product_category")

"""Row-level and customer-level features of transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorespark.functions.columns import existing, parse_id, parse_timestamp
from scorespark.operators.joins import attach
from scorespark.operators.rfms import rfms_measures
from scorespark.schema import ID_COLUMNS

# The columns of an account's sample.
SAMPLE_COLUMNS = ("transaction_id", "account_id", "product_category", "amount", "value", "txn_ts")


def add_date_parts(df: DataFrame, *, ts: str = "txn_ts") -> DataFrame:
    """Add hour, day of month, month and year of ``ts`` (text is parsed strictly)."""
    when = parse_timestamp(ts) if dict(df.dtypes)[ts] == "string" else F.col(ts)
    return df.withColumn(ts, when).withColumns(
        {"hour": F.hour(ts), "day": F.dayofmonth(ts), "month": F.month(ts), "year": F.year(ts)}
    )


def parse_id_columns(df: DataFrame, *, columns: Sequence[str] = ID_COLUMNS, strict: bool = False) -> DataFrame:
    """Replace ids of the form ``<name>_<n>`` by their number; any other text by NULL, or not at all with ``strict``."""
    return df.withColumns({c: parse_id(c, strict=strict) for c in existing(df, columns)})


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows with a value in every column.

    One condition per column, each of which can reach the scan; ``dropna``
    would make one condition of all of them, which cannot.
    """
    for name, kind in df.dtypes:
        df = df.where(F.col(name).isNotNull())
        if kind in ("double", "float"):
            df = df.where(~F.isnan(name))
    return df


def split_by_sign(df: DataFrame, *, amount: str = "amount") -> DataFrame:
    """Rows with a known amount, marked as debit (>= 0) or credit (< 0) with its magnitude."""
    x = F.col(amount)
    return df.where(x.isNotNull()).withColumns(
        {"direction": F.when(x < 0, "credit").otherwise("debit"), "magnitude": F.abs(x)}
    )


def customer_rows(df: DataFrame, customer: str, *, key: str = "customer_id") -> DataFrame:
    """All rows of one customer; an unknown customer gives no rows, an unknown column an error."""
    if key not in df.columns:
        raise KeyError(f"no column {key!r}")
    return df.where(F.col(key) == customer)


def account_counts(df: DataFrame, *, account: str = "account_id") -> DataFrame:
    return df.where(F.col(account).isNotNull()).groupBy(account).agg(F.count(F.lit(1)).alias("n"))


def account_samples(
    df: DataFrame, *, k: int = 5, account: str = "account_id", order: Sequence[Column | str] = ("txn_ts", "transaction_id")
) -> DataFrame:
    """First ``k`` rows of every account.

    The rank filter is applied inside each task before the shuffle as well, so
    an account with most of the rows sends at most ``k`` rows per task.
    """
    position = F.row_number().over(Window.partitionBy(account).orderBy(*order))
    ranked = df.where(F.col(account).isNotNull()).withColumn("position", position)
    return ranked.where(F.col("position") <= k).select("position", *existing(df, SAMPLE_COLUMNS))


def top_customer(df: DataFrame, *, key: str = "customer_id") -> Column:
    """Scalar subquery: the customer with most rows, ties by id."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), key).limit(1).select(key).scalar()


def amount_measures(*, amount: str = "amount", transaction: str = "transaction_id") -> list[Column]:
    return [
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("total_transaction"),
        F.avg(amount).alias("average_transaction"),
        F.count(transaction).alias("transaction_count"),
        F.stddev_samp(amount).alias("std_transaction"),
    ]


def customer_aggregates(df: DataFrame, *, key: str = "customer_id", **names) -> DataFrame:
    """Sum, mean, count and sample deviation of the amounts per customer; one row has no deviation."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*amount_measures(**names))


def with_customer_aggregates(df: DataFrame, *, key: str = "customer_id") -> DataFrame:
    return attach(df, customer_aggregates(df, key=key), key)


def customer_profile(df: DataFrame, *, as_of=None, key: str = "customer_id") -> DataFrame:
    """Score measures and amount aggregates in one pass and one shuffle."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*rfms_measures(as_of=as_of), *amount_measures())


def encode_label(df: DataFrame, *, label: str = "risk_label", out: str = "label", good: str = "Good", bad: str = "Bad") -> DataFrame:
    """1 for good, 0 for bad; anything else, NULL included, fails the job."""
    x = F.col(label)
    problem = F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(x.cast("string"), F.lit("NULL"))))
    return df.withColumn(out, F.when(x == good, 1).when(x == bad, 0).otherwise(problem.cast("int")))


# ---- features the reports describe ----------------------------------------------------------


def account_flow(df: DataFrame, *, account: str = "account_id", amount: str = "amount") -> DataFrame:
    """Debit and credit totals, counts, share of credits and largest of each per account."""
    x = F.col(amount)
    debit, credit = F.when(x >= 0, x), F.when(x < 0, -x)
    return (
        df.where(F.col(account).isNotNull())
        .groupBy(account)
        .agg(
            F.coalesce(F.sum(debit), F.lit(0.0)).alias("total_debit"),
            F.coalesce(F.sum(credit), F.lit(0.0)).alias("total_credit"),
            F.count(debit).alias("n_debit"),
            F.count(credit).alias("n_credit"),
            F.try_divide(F.count(credit), F.count(amount)).alias("credit_fraction"),
            F.max(debit).alias("max_debit"),
            F.max(credit).alias("max_credit"),
        )
    )


def log_and_cap(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Add ``log_<column>`` = ln(1+x) for x > -1 and ``capped_<column>`` held between two fences."""
    x = F.col(column)
    return df.withColumns(
        {
            f"log_{column}": F.when(x > -1, F.log1p(x)),
            f"capped_{column}": F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x))),
        }
    )


# Amount ranges of the three user tiers named by the reports.
USER_TIERS = (("tier_1", 50.0, 500.0), ("tier_2", 1000.0, 5000.0), ("tier_3", 10000.0, None))


def user_tier(df: DataFrame, *, value: str = "value", tiers=USER_TIERS) -> DataFrame:
    """Add ``user_tier`` by closed value ranges; values between ranges are 'other'."""
    x = F.col(value)
    tier = F.lit("other")
    for name, low, high in reversed(tiers):
        inside = x >= low if high is None else x.between(low, high)
        tier = F.when(inside, name).otherwise(tier)
    return df.withColumn("user_tier", F.when(x.isNotNull(), tier))


def group_rare(df: DataFrame, column: str, *, keep: int = 10, other: str = "Other") -> DataFrame:
    """Replace all but the ``keep`` most frequent values of ``column``.

    The kept values, at most ``keep`` of them, come from a scalar subquery.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = counted.orderBy(F.desc("n"), column).limit(keep).agg(F.collect_list(column)).scalar()
    x = F.col(column)
    return df.withColumn(column, F.when(x.isNull() | F.array_contains(top, x), x).otherwise(other))


def category_interactions(df: DataFrame, categories: Sequence[str], *, category: str = "product_category", amount: str = "amount") -> DataFrame:
    """One column per category: the amount where the row is of that category, else 0."""
    return df.withColumns(
        {f"{amount}_x_{c}": F.when(F.col(category) == c, F.col(amount)).otherwise(0.0) for c in categories}
    )


def interaction_vectors(df: DataFrame, encoder, *, category: str = "product_category", number: str = "amount", out: str = "interaction") -> DataFrame:
    """``number`` times the one-hot vector of ``category``, as a sparse vector: one entry a row, however many categories there are.

    ``encoder`` holds the category's codes; an unseen category fails the job.
    Rows without a category or a number get no vector.
    """
    coded = encoder.transform(df.withColumn("_text", F.col(category)), [category])
    known = F.col(category).isNotNull() & F.col(number).isNotNull()
    entry = F.struct(F.lit(encoder.sizes[category]).alias("size"), F.col(category).alias("position"), F.col(number).cast("double").alias("value"))
    return coded.withColumn(out, F.when(known, entry)).withColumn(category, F.col("_text")).drop("_text")


def accounts_per_customer(df: DataFrame, *, key: str = "customer_id", account: str = "account_id") -> DataFrame:
    """Distinct accounts and rows per customer.

    Counted in two steps, first per account, so that neither a hot customer nor
    a hot account meets in one task with all its rows.
    """
    per_account = df.where(F.col(key).isNotNull()).groupBy(key, account).agg(F.count(F.lit(1)).alias("n"))
    return per_account.groupBy(key).agg(F.count(account).alias("n_accounts"), F.sum("n").alias("n_transactions"))


def direction_summary(df: DataFrame, *, amount: str = "amount") -> DataFrame:
    """Rows and volume of debits and credits."""
    return (
        split_by_sign(df, amount=amount)
        .groupBy("direction")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("magnitude").alias("volume"), F.max("magnitude").alias("largest"))
    )



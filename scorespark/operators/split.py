"""Training and test parts, folds, and weights against class imbalance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.functions.columns import hash_fraction
from scorespark.functions.quantiles import exact_quantiles

TEST_SHARE = 0.3
SEED = 69


def split_rows(df: DataFrame, by: Sequence[str], *, test_share: float = TEST_SHARE, seed: int = SEED, out: str = "part") -> DataFrame:
    """Mark each row 'train' or 'test' by a hash of ``by``, without a shuffle.

    Every label is split in the given share in expectation.  Give one customer
    column as ``by`` to keep a customer's rows together.
    """
    return df.withColumn(out, F.when(hash_fraction(*by, seed=seed) < test_share, "test").otherwise("train"))


def split_rows_exactly(
    df: DataFrame, by: Sequence[str], *, label: str, labels: Sequence, test_share: float = TEST_SHARE, seed: int = SEED, out: str = "part"
) -> DataFrame:
    """As ``split_rows``, with the cut-off of each label at the exact quantile of its hashes."""
    h = hash_fraction(*by, seed=seed)
    parts = {f"_h{i}": F.when(F.col(label) == v, h) for i, v in enumerate(labels)}
    cuts = exact_quantiles(df.select(*[c.alias(n) for n, c in parts.items()]), list(parts), [test_share])
    in_test = F.lit(False)
    for (name, _), value in zip(parts.items(), labels):
        if cuts[name][0] is not None:
            in_test = in_test | ((F.col(label) == value) & (h < F.lit(cuts[name][0])))
    return df.withColumn(out, F.when(in_test, "test").otherwise("train"))


def stratified_parts(
    df: DataFrame,
    by: Sequence[str],
    *,
    label: str = "label",
    labels: Sequence = (0, 1),
    test_share: float = TEST_SHARE,
    folds: int = 5,
    seed: int = SEED,
    cut: bool = True,
) -> DataFrame:
    """Add ``part`` ('test' or 'train') and, for training rows, ``fold``, both with the same share of every label.

    Within a label, rows are ranked by a hash of ``by``: the first ranks are the
    test part, the others the folds in turn.  Only the hashes at the cuts are
    wanted, which are quantiles, so no row is sorted or moved.  Where ``by``
    tells rows apart, parts of a label have their exact size and folds differ
    by one row at most; rows that agree in ``by`` stay together.  The hashes
    are stored for the search; ``cut=False`` if ``df`` is.  Rows without a label are training rows without a fold.
    """
    levels = [test_share + (1 - test_share) * k / folds for k in range(folds)]
    hashed = df.withColumn("_h", hash_fraction(*by, seed=seed, digits=13))
    names = [f"_h{i}" for i in range(len(labels))]
    cuts = exact_quantiles(hashed.select(*[F.when(F.col(label) == v, F.col("_h")).alias(n) for n, v in zip(names, labels)]), names, levels, cut=cut)
    part, fold = F.lit("train"), F.lit(None).cast("int")
    for name, value in zip(names, labels):
        first, *others = cuts[name]
        if first is None:
            continue
        own, above = F.col(label) == value, F.lit(0)
        for cut in others:
            above = above + F.when(F.col("_h") >= F.lit(cut), 1).otherwise(0)
        part = F.when(own & (F.col("_h") < F.lit(first)), "test").otherwise(part)
        fold = F.when(own & (F.col("_h") >= F.lit(first)), above).otherwise(fold)
    return hashed.withColumns({"part": part, "fold": fold.cast("int")}).drop("_h")


def add_fold(df: DataFrame, by: Sequence[str], *, folds: int = 5, seed: int = SEED, out: str = "fold") -> DataFrame:
    """Fold number by hash; every label falls evenly on the folds in expectation."""
    return df.withColumn(out, F.floor(hash_fraction(*by, seed=f"{seed}-fold") * folds).cast("int"))


def class_weights(df: DataFrame, *, label: str = "label", count: str | None = None) -> DataFrame:
    """(label, n, weight): weights that make every class as heavy as the largest one."""
    n = F.sum(count) if count else F.count(F.lit(1))
    counted = df.where(F.col(label).isNotNull()).groupBy(label).agg(n.cast("bigint").alias("n"))
    largest = counted.agg(F.max("n")).scalar()
    return counted.withColumn("weight", largest / F.col("n"))

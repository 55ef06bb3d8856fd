"""Good and bad counts per bin, weight of evidence and information value.

All columns of a data set share one long table keyed by (variable, bin), so the
number of jobs does not grow with the number of columns, and everything after
the counts works on a table of a few rows per column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorespark.functions.columns import count_if
from scorespark.operators.binning import MOST_CATEGORIES, QuantileBins, SegmentBins, categorical_bin_columns

SMOOTHING = 0.5
NO_BINS = "variable string, bin_id int, lower double, upper double, label string, good bigint, bad bigint, total bigint"


def _label_counts(label: str, good: str, bad: str) -> list[Column]:
    y = F.col(label)
    return [
        count_if(y == good).alias("good"),
        count_if(y == bad).alias("bad"),
        F.count(y).alias("total"),
    ]


def numeric_counts(
    df: DataFrame,
    bins: QuantileBins | SegmentBins,
    *,
    label: str = "risk_label",
    good: str = "Good",
    bad: str = "Bad",
    by: Sequence[str] = (),
    include_empty: bool = False,
) -> DataFrame:
    """Counts of both labels per numeric bin.

    Bins are computed before the columns are stacked, so each row is stacked as
    small integers, one for variable and bin, and reduced to those inside its own task.
    """
    spark = df.sparkSession
    keys, binned = list(dict.fromkeys([*bins.by, *by])), bins.binned
    if not binned:
        return spark.createDataFrame([], ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), NO_BINS]))
    step = 1 + bins.most_bins
    wide = df.where(F.col(label).isNotNull()).select(
        *keys, F.col(label).alias("_y"), *[(bins.assign(c) + F.lit(i * step)).alias(c) for i, c in enumerate(binned)]
    )
    long = wide.unpivot([*keys, "_y"], binned, "variable", "_code").where(F.col("_code").isNotNull())
    by_label = long.groupBy(*keys, "_y", "_code").agg(F.count(F.lit(1)).alias("_n"))
    place, y = F.floor(F.col("_code") / step).cast("int"), F.col("_y")
    variable = F.get(F.array(*[F.lit(c) for c in binned]), place)
    sums = [F.sum(F.when(y == v, F.col("_n")).otherwise(0)).alias(n) for n, v in (("good", good), ("bad", bad))]
    counted = by_label.groupBy(*keys, variable.alias("variable"), (F.col("_code") - place * step).cast("int").alias("bin_id")).agg(*sums, F.sum("_n").alias("total"))
    edges = F.broadcast(bins.table(spark))  # n_bins rows per column and segment
    how = "right" if include_empty and not keys else "inner"
    joined = counted.join(edges, [*bins.by, "variable", "bin_id"], how)
    return joined.select(
        *keys, "variable", "bin_id", "lower", "upper", "label",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("good", "bad", "total")],
    )


def categorical_counts(
    df: DataFrame,
    *,
    columns: Sequence[str] | None = None,
    ignore: Iterable[str] = (),
    label: str = "risk_label",
    good: str = "Good",
    bad: str = "Bad",
    by: Sequence[str] = (),
    most: int = MOST_CATEGORIES,
) -> DataFrame:
    """Counts of both labels per value of the columns that have at most ``most`` values."""
    spark = df.sparkSession
    chosen = categorical_bin_columns(df, columns=columns, ignore=[*ignore, label], most=most)
    names = [r["variable"] for r in chosen.select("variable").collect()]
    if not names:
        return spark.createDataFrame([], NO_BINS)
    keys = list(by)
    counted = (
        df.where(F.col(label).isNotNull())
        .select(*keys, F.col(label).alias("_y"), *[F.col(c).cast("string").alias(f"_v{i}") for i, c in enumerate(names)])
        .unpivot([*keys, "_y"], [f"_v{i}" for i in range(len(names))], "_v", "label")
        .where(F.col("label").isNotNull())
        .groupBy(*keys, F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(names) for x in (f"_v{i}", c)]), F.col("_v")).alias("variable"), "label")
        .agg(*_label_counts("_y", good, bad))
    )
    order = Window.partitionBy(*keys, "variable").orderBy("label")  # at most `most` rows each
    return counted.select(
        *keys, "variable", F.row_number().over(order).alias("bin_id"),
        F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"),
        "label", "good", "bad", "total",
    )


def woe_table(counts: DataFrame, *, by: Sequence[str] = (), smoothing: float = SMOOTHING) -> DataFrame:
    """Add bad rate, weight of evidence and the bin's part of the information value.

    The evidence is smoothed, the shares in the information value are not.
    """
    per_variable = Window.partitionBy(*by, "variable")  # a few bins each
    good_all, bad_all = F.sum("good").over(per_variable), F.sum("bad").over(per_variable)
    s = F.lit(smoothing)
    ratio = ((F.col("good") + s) / (good_all + s)) / ((F.col("bad") + s) / (bad_all + s))
    share = F.coalesce(F.try_divide(F.col("good"), good_all), F.lit(0.0)) - F.coalesce(
        F.try_divide(F.col("bad"), bad_all), F.lit(0.0)
    )
    return (
        counts.withColumn("bad_rate", F.coalesce(F.try_divide(F.col("bad"), F.col("total")), F.lit(0.0)))
        .withColumns({"woe": F.ln(ratio), "_share": share})
        .withColumn("iv_part", F.col("_share") * F.col("woe"))
        .drop("_share")
    )


def information_value(woe: DataFrame, *, variables: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Sum of the parts per variable; ``variables`` without any bin get 0."""
    found = woe.groupBy(*by, "variable").agg(F.sum("iv_part").alias("iv"))
    if not variables or by:
        return found
    names = woe.sparkSession.createDataFrame([(v,) for v in variables], "variable string")
    return names.join(found, "variable", "left").select("variable", F.coalesce("iv", F.lit(0.0)).alias("iv"))


def woe_report(woe: DataFrame, variable: str) -> DataFrame:
    """Bins of one variable in order, with counts, bad rate and weight of evidence."""
    return (
        woe.where(F.col("variable") == variable)
        .orderBy("bin_id")
        .select("bin_id", F.col("label").alias("bin"), "good", "bad", F.col("bad_rate").alias("bad_probability"), "woe")
    )


def iv_strength(iv: DataFrame) -> DataFrame:
    """Add the strength class of an information value; values between classes are 'unspecified'."""
    x = F.col("iv")
    # Class limits.
    strength = F.when(x > 0.5, "strong").when(x.between(0.1, 0.3), "medium").when(x < 0.02, "weak")
    return iv.withColumn("strength", F.coalesce(strength, F.lit("unspecified")))


@dataclass(frozen=True)
class EvidenceEncoder:
    """Every binned variable with its edges (numbers) or values (texts) and the evidence of each bin.

    A handful of literals a variable, so replacing values needs no join and runs
    the same way over tables and streams.  ``stage`` is a step that Spark saves
    and loads with the model that uses it.
    """

    edges: dict[str, list[float]]
    numeric: dict[str, dict[int, float]]
    categorical: dict[str, dict[str, float]]
    suffix: str = "_woe"

    @classmethod
    def fit(cls, numeric: DataFrame, categorical: DataFrame, bins: QuantileBins, *, suffix: str = "_woe") -> EvidenceEncoder:
        """From evidence tables, which have a few rows a variable."""
        own: dict[str, dict[int, float]] = {}
        for r in numeric.select("variable", "bin_id", "woe").collect():
            own.setdefault(r["variable"], {})[r["bin_id"]] = r["woe"]
        texts: dict[str, dict[str, float]] = {}
        for r in categorical.select("variable", "label", "woe").collect():
            texts.setdefault(r["variable"], {})[r["label"]] = r["woe"]
        return cls({v: bins.edges[v] for v in own}, own, texts, suffix)

    @property
    def variables(self) -> list[str]:
        return sorted([*self.numeric, *self.categorical])

    @property
    def outputs(self) -> list[str]:
        return [v + self.suffix for v in self.variables]

    def _sql(self, variable: str) -> str:
        if variable in self.numeric:
            edges, found = self.edges[variable], self.numeric[variable]
            x = f"try_cast(`{variable}` AS DOUBLE)"
            steps = [f"WHEN {x} <= {e!r}D THEN {_number(found.get(i + 1))}" for i, e in enumerate(edges[1:])]
            return f"CASE WHEN {x} IS NULL OR {x} < {edges[0]!r}D THEN NULL {' '.join(steps)} END"
        steps = " ".join(f"WHEN {_text(value)} THEN {_number(w)}" for value, w in sorted(self.categorical[variable].items()))
        return f"CASE CAST(`{variable}` AS STRING) {steps} END"

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the evidence of each variable; NULL for values outside every bin."""
        return df.withColumns({v + self.suffix: F.expr(self._sql(v)) for v in self.variables})

    def stage(self) -> SQLTransformer:
        added = ", ".join(f"{self._sql(v)} AS `{v}{self.suffix}`" for v in self.variables)
        return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


def _number(x: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if x is None else f"{float(x)!r}D"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def woe_transform(df: DataFrame, woe: DataFrame, bins: QuantileBins | None = None, *, suffix: str = "_woe") -> DataFrame:
    """Add the weight of evidence of each variable of the table ``woe``; those in ``bins`` are numbers."""
    numbers = [v for v in bins.binned] if bins is not None else []
    own, texts = woe.where(F.col("variable").isin(numbers)), woe.where(~F.col("variable").isin(numbers))
    return EvidenceEncoder.fit(own, texts, bins or QuantileBins({}), suffix=suffix).transform(df)

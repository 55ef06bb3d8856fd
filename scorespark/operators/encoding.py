"""Label codes of string columns: rank among the sorted distinct values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorespark.functions.columns import categorical_columns
from scorespark.functions.ordering import running_totals
from scorespark.session import materialize

BROADCAST_VALUES = 100_000  # a column's dictionary is broadcast up to this many values
WINDOW_VALUES = 1_000_000  # dictionaries up to this many values are ranked by one window


@dataclass(frozen=True)
class LabelEncoder:
    """``dictionary`` holds (variable, value, code); ``sizes`` the values per column."""

    dictionary: DataFrame
    sizes: dict[str, int]

    @classmethod
    def fit(
        cls, df: DataFrame, columns: Sequence[str] | None = None, *, window_values: int = WINDOW_VALUES
    ) -> LabelEncoder:
        """One pass over the data for all columns; values are counted before they are ranked."""
        columns = list(columns if columns is not None else categorical_columns(df))
        long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "variable", "value")
        distinct = materialize(long.where(F.col("value").isNotNull()).distinct(), "dictionary")
        counted = {r["variable"]: r["n"] for r in distinct.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).collect()}
        sizes = {c: counted.get(c, 0) for c in columns}
        if max(sizes.values(), default=0) <= window_values:
            rank = F.row_number().over(Window.partitionBy("variable").orderBy("value"))
            ranked = distinct.withColumn("code", rank - 1)
        else:
            ranked = running_totals(distinct, ["variable", "value"], F.lit(1), "position")
            # Columns follow one another in the order of their names.
            skipped, start = 0, {}
            for c in sorted(columns):
                start[c] = skipped
                skipped += sizes[c]
            shift = F.element_at(F.create_map(*[F.lit(x) for kv in start.items() for x in kv]), F.col("variable"))
            ranked = ranked.withColumn("code", F.col("position") - 1 - shift)
        ranked = ranked.select("variable", "value", F.col("code").cast("int").alias("code"))
        return cls(materialize(ranked, "codes"), sizes)

    @classmethod
    def from_table(cls, dictionary: DataFrame) -> LabelEncoder:
        counted = dictionary.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).collect()
        return cls(dictionary, {r["variable"]: r["n"] for r in counted})

    def labels(self, column: str) -> list[str]:
        """All values of one column in code order, for steps that hold their dictionary themselves."""
        rows = self.dictionary.where(F.col("variable") == column).orderBy("code").select("value").collect()
        return [r["value"] for r in rows]

    def transform(self, df: DataFrame, columns: Sequence[str] | None = None, *, unseen: str = "error") -> DataFrame:
        """Replace values by codes.  NULL stays NULL; an unseen value fails the job or
        becomes NULL (``unseen="null"``).

        A short dictionary is broadcast.  A long one is joined as the stored
        table it is, so that adaptive execution can split frequent values.
        """
        for c in columns if columns is not None else [c for c in self.sizes if c in df.columns]:
            codes = self.dictionary.where(F.col("variable") == c).select(
                F.col("value").alias(f"_{c}"), F.col("code").alias(f"_{c}_code")
            )
            if self.sizes[c] <= BROADCAST_VALUES:
                codes = F.broadcast(codes)
            joined = df.join(codes, F.col(c).cast("string") == F.col(f"_{c}"), "left")
            code = F.col(f"_{c}_code")
            if unseen == "error":
                problem = F.raise_error(F.concat(F.lit(f"unseen value in {c}: "), F.col(c).cast("string"))).cast("int")
                code = F.when(F.col(c).isNotNull() & code.isNull(), problem).otherwise(code)
            df = joined.withColumn(c, code).drop(f"_{c}", f"_{c}_code")
        return df

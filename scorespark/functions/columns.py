"""Column selection and scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric and boolean columns in schema order."""
    skip = set(exclude)
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in skip]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """String columns in schema order."""
    skip = set(exclude)
    kinds = (T.StringType, T.CharType, T.VarcharType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in skip]


def existing(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Treat NaN as missing from here on; Spark aggregates skip only NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def as_number(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def parse_id(column: Column | str, *, strict: bool = False) -> Column:
    """Number behind the first underscore of ``<name>_<n>``.

    Text without one becomes NULL, or fails the job with ``strict``.
    """
    text = F.col(column) if isinstance(column, str) else column
    number = F.get(F.split(text, "_"), F.lit(1)).try_cast("bigint")
    if not strict:
        return number
    problem = F.raise_error(F.concat(F.lit("not an id: "), text)).cast("bigint")
    return F.when(text.isNotNull() & number.isNull(), problem).otherwise(number)


def parse_timestamp(column: Column | str, *, strict: bool = True) -> Column:
    """Text to a UTC wall-clock timestamp.

    ``strict`` fails the job on text that is not a timestamp, otherwise it
    becomes NULL.  The outcome does not depend on the session's ANSI setting.
    """
    text = F.col(column) if isinstance(column, str) else column
    instant = F.try_to_timestamp(text)
    wall = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
    if not strict:
        return wall
    problem = F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp_ntz")
    return F.when(text.isNotNull() & instant.isNull(), problem).otherwise(wall)


def hash_fraction(*columns: Column | str, seed: int | str = 0, digits: int = 8) -> Column:
    """Reproducible number in [0, 1) from the given columns.

    Built on md5 so that other SQL engines can compute the same number.  A
    retried task gets the same answer, which ``rand`` does not promise once
    the order of rows changes.  Of the digest the first ``digits`` hexadecimal
    digits count, 13 at most, as a double holds no more.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint") / F.lit(16.0**digits)


def count_if(condition: Column) -> Column:
    """Rows that meet a condition, as a count that is 0 rather than NULL."""
    return F.count(F.when(condition, F.lit(1)))


def rows_from_wide(one_row: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per entry of ``rows``."""
    records = [F.struct(*[v.alias(k) for k, v in entry.items()]) for entry in rows]
    return one_row.select(F.explode(F.array(*records)).alias("r")).select("r.*")

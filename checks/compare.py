"""Run registered queries in Spark and their SQL in DuckDB and compare whole results.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normal(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        if pd.api.types.is_datetime64_any_dtype(pdf[c]):
            pdf[c] = pdf[c].astype("datetime64[us]")
        elif pdf[c].dtype == object:
            pdf[c] = pdf[c].map(lambda v: None if v is None or v != v else str(v).removesuffix(" 00:00:00"))
        if pd.api.types.is_float_dtype(pdf[c]):
            pdf[c] = pdf[c] + 0.0
    return pdf.sort_values(list(pdf.columns), kind="stable", na_position="first").reset_index(drop=True)


def difference(a: pd.DataFrame, b: pd.DataFrame) -> str | None:
    if sorted(a.columns) != sorted(b.columns):
        return f"columns {sorted(a.columns)} / {sorted(b.columns)}"
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    a, b = normal(a), normal(b)
    for c in a.columns:
        x, y = a[c], b[c]
        if str(x.dtype) != str(y.dtype) and not (x.isna().all() and y.isna().all()):
            x, y = x.astype(object), y.astype(object)
        same = (x == y) | (x.isna() & y.isna())
        if not same.all():
            i = same.idxmin()
            return f"{(~same).sum()} rows differ in {c}, first {x[i]!r} / {y[i]!r}"
    return None


def kinds(a: pd.DataFrame, b: pd.DataFrame) -> str:
    odd = [f"{c}: {a[c].dtype}/{b[c].dtype}" for c in a.columns if c in b.columns and str(a[c].dtype).split("[")[0] != str(b[c].dtype).split("[")[0]]
    return "  types " + ", ".join(odd) if odd else ""


def main() -> None:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    from scorespark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            ours = QUERIES[name](spark, folder).toPandas()
            spent = time.time() - start
            if name in ORACLES:
                theirs = con.sql(ORACLES[name]).df()
                problem = difference(ours, theirs)
                note = kinds(ours, theirs)
            else:
                problem, note = None, "  (rows only)"
        except Exception as error:  # report and go on with the next query
            problem, note, ours, spent = f"{type(error).__name__}: {str(error)[:700]}", "", [], time.time() - start
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {len(ours):7d} rows {spent:6.2f}s {problem or ''}{note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()

"""Run queries in Spark and their SQL in DuckDB and compare columns, rows and values."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

FAMILIES = {"i": "int", "u": "int", "f": "float", "b": "bool", "O": "object", "M": "time"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def in_order(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), na_position="first", ignore_index=True) if len(frame) else frame


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """Why the two frames differ, or None. Values must be equal, not only close."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = in_order(got), in_order(want)
    for name in got.columns:
        a, b = got[name], want[name]
        if a.dtype != b.dtype and "Int64" in (str(a.dtype), str(b.dtype)):  # nulls among whole numbers
            a, b = a.astype("Int64"), b.astype("Int64")
        if a.dtype != b.dtype and len(a):
            return f"{name}: type {a.dtype} != {b.dtype}"
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            i = same.idxmin()
            return f"{name}: {(~same).sum()} values differ, first {a[i]!r} != {b[i]!r}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from pyspark.sql import SparkSession

    from riskloom.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    # PLAIN=1: a session without any of our settings.
    plain = os.environ.get("PLAIN")
    spark = SparkSession.builder.master("local[8]").getOrCreate() if plain else local_session(8)
    con = connect(folder)
    every, sql = queries(), oracle_sql()
    bad = 0
    for name, query in every.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            got = query(spark, folder).toPandas()
            took = time.time() - start
            if name not in sql:
                print(f"rows   {name} {len(got)} {took:.1f}s", flush=True)
                continue
            why = difference(got, con.execute(sql[name]).df())
        except Exception as error:  # report every query
            why, took = f"{type(error).__name__}: {str(error)[:600]}", time.time() - start
        bad += why is not None
        print(f"{'OK    ' if why is None else 'DIFFER'} {name} {took:.1f}s {why or ''}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()

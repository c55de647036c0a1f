"""Run registered queries and their check SQL side by side.

    python tests/compare.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def normalized(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if str(df[name].dtype).startswith("datetime64"):
            df[name] = df[name].astype("datetime64[us]")
        elif df[name].dtype == object:
            df[name] = df[name].map(lambda v: None if v is None or v is pd.NA else str(v))
        elif pd.api.types.is_integer_dtype(df[name].dtype):
            df[name] = df[name].astype("int64") if not df[name].isna().any() else df[name]
    return df.sort_values(list(df.columns), ignore_index=True, na_position="last")


def difference(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    """None if equal, bit for bit; otherwise what differs."""
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns {sorted(spark_df.columns)} / {sorted(duck_df.columns)}"
    if len(spark_df) != len(duck_df):
        return f"rows {len(spark_df)} / {len(duck_df)}"
    left, right = normalized(spark_df), normalized(duck_df)
    for name in left.columns:
        a, b = left[name], right[name]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            at = np.flatnonzero(~same.to_numpy())
            return f"{name}: {len(at)} differ, e.g. {a[at[0]]!r} / {b[at[0]]!r}"
        kinds = {k for k in (a.dtype.kind, b.dtype.kind)}
        if len(kinds) > 1 and len(left):
            return f"{name}: types {a.dtype} / {b.dtype}"
    return None


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from skymart.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:])
    spark, con, failed = local_session("8"), duck(sf_dir), 0
    oracles = oracle_sql()
    for name, run in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            result = run(spark, sf_dir).toPandas()
            took = time.time() - start
            expected = con.execute(oracles[name]).df() if name in oracles else None
            problem = "no oracle" if expected is None else difference(result, expected)
        except Exception as error:  # report and go on with the next query
            problem, took, result = f"{type(error).__name__}: {str(error)[:600]}", 0.0, []
        failed += problem not in (None, "no oracle")
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {took:6.2f}s {len(result):7d} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

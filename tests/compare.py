"""Runs named queries and the SQL they must agree with on the same tables."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def sql_result(folder: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con.execute(sql).fetch_df()


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True) if len(frame) else frame


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    got, want = ordered(got), ordered(want)
    for name in got.columns:
        if str(got[name].dtype) != str(want[name].dtype):
            return f"type of {name}: {got[name].dtype} / {want[name].dtype}"
        same = (got[name] == want[name]) | (got[name].isna() & want[name].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{name}, {(~same).sum()} rows, first {got.loc[at].to_dict()} / {want.loc[at].to_dict()}"
    return None


def main(folder: str, names: list[str]) -> int:
    from conftest import session

    sys.path.insert(0, str(Path(__file__).parent.parent))
    import __spark_entry__ as entry

    spark, failed = session(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            got = query(spark, folder).toPandas()
            middle = time.time()
            problem = differences(got, sql_result(folder, entry.oracle_sql()[name])) if name in entry.oracle_sql() else None
            times = f"{middle - begin:6.2f}s spark {time.time() - middle:6.2f}s sql"
            print(f"{name:26s} {'ok' if problem is None else 'DIFF':4s} {len(got):8d} rows {times} {problem or ''}", flush=True)
            failed += problem is not None
        except Exception as error:
            failed += 1
            print(f"{name:26s} FAIL {str(error)[:1500]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

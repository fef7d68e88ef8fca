"""Compare every registered query with its SQL: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, pd.Timestamp):
            return str(v)
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float) and v == 0:
            return 0.0
        return str(v) if not isinstance(v, (int, float, bool, str)) else v

    rows = [tuple(plain(v) for v in row) for row in df.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(spark, con, sf_dir: str, name: str) -> str | None:
    """None when the query and its SQL agree, else what differs first."""
    ours_df = queries()[name](spark, sf_dir)
    ours = ours_df.toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        return None if len(ours.columns) else "no columns"
    theirs = con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    a, b = canonical(ours), canonical(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0]}" if bad else None


if __name__ == "__main__":
    from logilake.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark, con = local_session(8), connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            problem = differences(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")

"""Run every registered query against its SQL on DuckDB: ``python tests/check_oracles.py``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tickfold.session import local_session  # noqa: E402

TABLES = ["events", "supplier", "documents", "embeddings", "labels"]


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted(df: pd.DataFrame) -> list[tuple]:
    rows = df[sorted(df.columns)].astype(object).where(df.notna(), None).values.tolist()
    return sorted((tuple(r) for r in rows), key=repr)


def compare(spark, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> tuple[bool, int]:
    got = entry.queries()[name](spark, sf_dir).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    same = sorted(got.columns) == sorted(want.columns) and _sorted(got) == _sorted(want)
    return same, len(got)


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(entry.oracle_sql())
    folder = f"/root/testdata/sf{sf}"
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    failed = []
    for query in names:
        start = time.time()
        try:
            ok, n = compare(session, tables(folder), query, folder)
        except Exception as error:  # report all queries before failing
            ok, n = False, -1
            print(str(error)[:600])
        print(f"{'ok  ' if ok else 'FAIL'} {query:28s} {n:8d} rows {time.time() - start:6.2f}s", flush=True)
        if not ok:
            failed.append(query)
    sys.exit(f"failed: {failed}" if failed else 0)

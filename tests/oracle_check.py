"""Compare registered queries with their SQL: python tests/oracle_check.py [sf_dir] [query ...]."""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(frame, con, sql: str) -> str | None:
    """None when columns and rows agree, whatever their order."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    order = sorted(columns)
    places = [columns.index(c) for c in order]
    want = sorted((tuple(repr(row[p]) for p in places) for row in result.fetchall()))
    got = sorted((tuple(repr(row[c]) for c in order) for row in frame.collect()))
    if got == want:
        return None
    odd = [pair for pair in zip(got, want) if pair[0] != pair[1]][:2]
    return f"{len(got)} rows against {len(want)}; columns {order}; first unequal: {odd}"


if __name__ == "__main__":
    import __spark_entry__ as registered
    from tests.conftest import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con, sql = build_session(), connect(sf_dir), registered.oracle_sql()
    bad = 0
    for name, run in registered.queries().items():
        if name not in sql:
            continue
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            problem = differences(run(spark, sf_dir), con, sql[name])
        except Exception as error:  # shown, and the next query is tried
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")

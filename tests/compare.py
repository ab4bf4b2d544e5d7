"""Run queries against their SQL: python tests/compare.py [sf_dir] [names...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def difference(spark_frame, sql_result) -> str | None:
    """What differs between a Spark frame and an executed SQL statement, or None."""
    names = [c[0] for c in sql_result.description]
    if sorted(spark_frame.columns) != sorted(names):
        return f"columns {sorted(spark_frame.columns)} != {sorted(names)}"
    columns = sorted(names)
    places = [names.index(c) for c in columns]
    left = sorted((tuple(r) for r in spark_frame.select(*columns).collect()), key=repr)
    right = sorted((tuple(r[i] for i in places) for r in sql_result.fetchall()), key=repr)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"{dict(zip(columns, a))} != {b}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, connection = build_session(), connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names:
        start = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            if name not in oracle:
                print(f"----  {name}: {frame.count()} rows, no SQL", flush=True)
                continue
            verdict = difference(frame, connection.execute(oracle[name]))
            took = time.time() - start
        except Exception as error:
            verdict, took = f"{type(error).__name__}: {str(error)[:600]}", time.time() - start
        bad += verdict is not None
        print(f"{'OK  ' if verdict is None else 'FAIL'}  {name}: {verdict or ""} {took:.1f}s", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()

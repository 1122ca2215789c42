"""Compare registered queries with DuckDB: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str):
    engine = duckdb.connect()
    for table in TABLES:
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return engine


def _value(value):
    """Numbers compare by value, everything else by text; NULL and NaN sort together."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return (1, repr(float(value)))
    return (2, str(value))


def rows(names: list[str], records) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(record[i]) for i in order) for record in records)


def difference(query, sql: str, spark, engine, folder: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, folder)
    found = rows(df.columns, df.collect())
    result = engine.execute(sql)
    names = [column[0] for column in result.description]
    wanted = rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if found != wanted:
        apart = next(((f, w) for f, w in zip(found, wanted) if f != w), None)
        return f"{len(found)} rows against {len(wanted)}; first difference {str(apart)[:400]}"
    return None if found else "no rows"


def main() -> None:
    from tidemark.session import build_session
    from tidemark.suite import QUERIES, SQL

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tidemark-compare-"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    engine = connect(folder)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            outcome = difference(QUERIES[name], SQL[name], spark, engine, folder)
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        failed += outcome is not None
        print(f"{'ok  ' if outcome is None else 'FAIL'} {time.time() - start:6.2f}s {name} {outcome or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()

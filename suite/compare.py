"""Compare driver queries with their SQL answers in DuckDB.

    python -m suite.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from typing import Any

import duckdb
from pyspark.sql import SparkSession

from silverair.session import build_session
from suite import QUERIES, SQL

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def bag(names: list[str], rows: list[tuple[Any, ...]]) -> Counter:
    """Rows as a multiset, columns in the order of their names."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(row[i]).__name__, row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> str | None:
    """``None`` if both answers agree, else what differs."""
    df = QUERIES[name](spark, folder)
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    answer = con.execute(SQL[name])
    columns = [d[0] for d in answer.description]
    want = bag(columns, answer.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        return f"{got.total()} rows, want {want.total()}; extra {list((got - want).items())[:2]}, missing {list((want - got).items())[:2]}"
    return None if got else "no rows"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session("compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names or QUERIES:
        start = time.perf_counter()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - a report of all failures is wanted
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:26s} {time.perf_counter() - start:6.2f}s  {problem or 'ok'}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))

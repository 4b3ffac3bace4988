"""Run a registered query and its DuckDB counterpart and compare all rows.

Usage: python -m catalog.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value) if value != int(value) else repr(float(int(value)))
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, folder: str, name: str, build, sql: str) -> str | None:
    """None if both results are equal, else what differs."""
    df = build(spark, folder)
    ours = [tuple(row) for row in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns: only Spark {sorted(set(df.columns) - set(names))}, only SQL {sorted(set(names) - set(df.columns))}"
    if len(ours) != len(theirs):
        return f"rows: Spark {len(ours)}, SQL {len(theirs)}"
    left, right = rows_of(df.columns, ours), rows_of(names, theirs)
    if left == right:
        return None
    for a, b in zip(left, right, strict=True):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(sorted(names), a, b, strict=True) if x != y]
            return f"values: {cells[:4]}"
    return None


def main() -> None:
    from catalog.duck_queries import SQL
    from catalog.spark_queries import QUERIES
    from shoptrail.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            problem = difference(spark, con, folder, name, QUERIES[name], SQL[name]) if name in SQL else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal")


if __name__ == "__main__":
    main()

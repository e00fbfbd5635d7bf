"""Compare registered queries with their SQL on DuckDB.

``python -m tests.oracle <sf_dir> [name ...]`` runs the named queries, or all of them.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from tablewright.plans import catalogue

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (bytearray, memoryview)):
        return bytes(v)
    return v


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(plain(r[i])).__name__, plain(r[i])) for i in order) for r in rows)


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None if the rows agree, otherwise what differs."""
    df = catalogue.QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in catalogue.ORACLE:
        return None
    cursor = con.execute(catalogue.ORACLE[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    got, want = bag(df.columns, rows), bag(columns, expected)
    if got != want:
        extra, lack = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{len(rows)} rows against {len(expected)}; extra {extra}; lacking {lack}"
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(catalogue.QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, name)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        oracle = "" if name in catalogue.ORACLE else " (no SQL)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{oracle} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))

"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8) and
``BENCH_RUNS`` (default 2, the faster counts) set what is run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from tablewright.plans import catalogue

HEADLINE = [
    "pricing_summary",
    "read_streams",
    "coerce_types",
    "merge_uploads",
    "batch_preprocess",
    "ingest_csv",
    "sql_query",
    "group_summarise",
    "top_k",
    "join_inner",
    "join_range",
    "join_asof",
    "agg_cube",
    "agg_n_distinct",
    "agg_quantile",
    "win_n",
    "win_rank",
    "win_cumsum",
    "fn_str_replace",
    "dir_tree",
    "resolve_paths",
    "sync_plan",
    "profile",
    "export_parquet",
    "insert_rows_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    catalogue.QUERIES["agg_basic"](spark, sf_dir).collect()

    times = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(min(taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

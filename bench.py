"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query runs once to warm up and then RUNS times; its time is the median. The clock covers
building the plan, which for the storage queries includes their writes, and running it into a
sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.session import build_session  # noqa: E402
from millrace.workload import REGISTRY  # noqa: E402

RUNS = 3
HEADLINE = [
    "incremental_publish", "inc_newer_drop", "inc_newer_keep", "publish_agg", "current_row_per_key", "customer_mart",
    "batch_validation_multi", "surrogate_key_nulls", "safe_math", "width_bucket", "url_path", "slugify_col",
    "date_functions", "spine_day", "column_values", "union_relations", "pivot_sum", "pivot_distinct", "unpivot",
    "dedup_row_number", "dedup_max_by", "except_both", "qc_equal_rowcount_grouped", "qc_equality", "qc_equality_strict",
    "qc_cardinality", "qc_relationships", "qc_not_constant_grouped", "qc_unique_combo", "qc_ranges_allowed",
    "qc_ranges_whole_table", "qc_sequential", "qc_sequential_whole_table", "qc_suite", "stream_ingest",
    "sink_partitioned", "compact",
]


def seconds(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    REGISTRY[name].plan(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(f"local[{cpus}]", app="millrace-bench", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(RUNS)), 4)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries, median of 3 runs each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

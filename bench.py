"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from plateflow.queries import QUERIES
from plateflow.session import build_session

HEADLINE = [
    "image_set_table", "submission_jobs", "select_images", "image_sets", "assign_batches", "distinct_images",
    "middle_z", "validate", "ready_analyses", "rollup_analyses", "rollup_files", "build_result", "compact_files",
    "merge_status", "lifecycle", "job_families", "complete_families", "progress", "error_budget",
    "merge_csv", "infer_types", "narrow_types", "stream_complete",
]


def run(spark: SparkSession, name: str, folder: str) -> None:
    """Run a query to its last row."""
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_checkpoint_dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ["BENCH_QUERIES"].split(",") if "BENCH_QUERIES" in os.environ else HEADLINE
    # The clock starts once the JVM has compiled the queries and the Python workers run.
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in names if os.path.isdir(small) else names[:1]:
        run(spark, name, small if os.path.isdir(small) else folder)
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(spark, name, folder)
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()

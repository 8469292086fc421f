"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Each time is
that of one run, from the call to the last row: tables the query writes are
written within it, and its result is computed in full.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from martloom import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINES = [
    "mart_rows",
    "mart_build",
    "corporate_mart",
    "mart_left_join",
    "left_join_fanout",
    "left_join_hot_keys",
    "scan_table",
    "scan_partition",
    "filter_report_date",
    "narrow_cast",
    "retention_cutoff",
    "count_where",
    "max_where",
    "last_step",
    "previous_count",
    "change_of_run",
    "create_mart",
    "overwrite_partition",
    "partition_inventory",
    "compact_partition",
    "retention_apply",
    "truncate_partitions",
    "step_job",
    "run_audit",
    "mart_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "martloom-bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("mart_rows")  # starts the JVM's code paths and Python's imports
    times = {name: run(name) for name in (names.split(",") if names else HEADLINES)}
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

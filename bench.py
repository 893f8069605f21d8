"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR  folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores to use (default 8)
BENCH_QUERIES comma-separated names, or "all" (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from meterloom.plans.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "normalize_text",
    "quality_reasons",
    "corpus_funnel",
    "dedup_exact",
    "chat_records",
    "assemble_turns",
    "cap_per_source",
    "judge_means",
    "eval_delta",
    "level_summary",
    "find_knee",
    "deployment_totals",
    "account_streams",
    "gap_percentiles",
    "split_thinking",
    "error_excerpt",
    "status_changes",
    "orphan_ips",
    "billing_verdict",
    "dangling",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("meterloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed run of a small query, so that no query pays for starting the engine.
    QUERIES["corpus_funnel"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) choose the data
and the cores. The given tables are one file of one row group each, which a single task reads, whatever
the cores. So the two that the edit-shaped views are made of are first written anew as several files,
as tables of any size are; that is timed apart, as ``staging``. Then every query is run in full into the
``noop`` sink, once, after one unmeasured warm-up, views and all.
"""

from __future__ import annotations

import json
import os
import re
import shutil
import tempfile
import time

from pyspark.sql import SparkSession

from editstream.registry.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "ingest_reject_counts",
    "flat_edits",
    "route_counts",
    "dead_letters_by_category",
    "flagged_events",
    "flag_counts",
    "rule_version_changes",
    "document_flags",
    "flag_rate_by_domain",
    "flag_pairs",
    "flag_correlation",
    "users_with_flags",
    "events_by_type",
    "events_per_hour",
    "daily_summary",
    "user_patterns",
    "page_frequency",
    "large_edits",
    "quality_summary",
    "pending_scan",
    "rescan_totals",
    "late_events",
    "repeated_content",
    "backlog_severity",
    "streamed_edits",
    "streamed_hour_counts",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    noop = {"format": "noop", "mode": "overwrite"}
    started = time.perf_counter()
    staged = tempfile.mkdtemp(prefix="bench-")
    for table in ("events", "documents"):
        rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
        rows.repartition(2 * int(CPUS)).write.parquet(f"file://{staged}/{table}.parquet")
    staging = time.perf_counter() - started
    QUERIES["ingest_reject_counts"](spark, staged).write.save(**noop)
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, staged).write.save(**noop)
        seconds[name] = round(time.perf_counter() - started, 3)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    scale = re.search(r"sf([\d.]+)$", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else SF_DIR,
                "events": events,
                "staging": round(staging, 3),
                "routed_rows_per_sec": round(events / seconds["route_counts"]),
            }
        )
    )
    spark.stop()
    shutil.rmtree(staged)


if __name__ == "__main__":
    main()

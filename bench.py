"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs to the end with the ``noop`` sink, so every row and column is computed and nothing is collected. A
query runs twice and the better time counts: the first run also pays for starting the JVM's code.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "wide_to_long",
    "sensor_join",
    "placeholder_filter",
    "time_parse",
    "distinct_readings",
    "drop_trailing_col",
    "control_scrub",
    "content_hash",
    "decode_roundtrip",
    "csv_fields",
    "whole_file_readings",
    "header_dim",
    "skip_by_name",
    "skip_by_hash",
    "classify_files",
    "batch_dedup",
    "ledger_upsert",
    "ledger_merge",
    "archive_entries",
    "quarantine",
    "flagship_ingest",
    "folder_ingest",
    "stream_ingest",
]


def main() -> None:
    from gaugeline.plans.table_queries import QUERIES
    from gaugeline.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4)))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "gaugeline-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

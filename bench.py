"""Time the headline queries and print one JSON line.

Each query is planned and run in full into a sink that keeps nothing, so the
time covers every row and column. The first run of the session warms up the JVM
on a query that is not counted.
"""

from __future__ import annotations

import json
import os
import time

from heightline.plans.catalog import QUERIES
from heightline.session import build_session

HEADLINE = [
    "block_scan",
    "header_project",
    "tx_map",
    "payload_encode",
    "payload_decode",
    "message_contract",
    "dedup_first",
    "dedup_ttl",
    "latest_per_key",
    "publish_anti_join",
    "publish_once",
    "head_gap_fill",
    "high_water_mark",
    "finalized_backlog",
    "missing_heights",
    "pending_entries",
    "stale_reclaim",
    "work_list",
    "oldest_n",
    "backlog_summary",
    "counter_by_label",
    "latency_histogram",
    "gauge_last",
    "counter_rate",
    "rate_sum_by_label",
    "log_lines_per_minute",
    "log_lines_sliding",
    "logfmt_extract",
    "big_parse",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["label_values"](spark, sf_dir))
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

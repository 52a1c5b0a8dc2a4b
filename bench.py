"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) names the data, ``BENCH_CPUS`` (default 8) the local cores.
Every query is run to its last row into a sink that keeps nothing; the first run warms up, the reported
time is the median of the following ``BENCH_RUNS`` (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.queries import QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = [
    "mart_fct_orders", "mart_number_of_users", "mart_number_of_orders", "mart_user_repeat_rate",
    "mart_add_to_cart_rate", "mart_conversion_by_product", "mart_fct_movements", "mart_state_summary",
    "top3_parts_month", "composite_key_join", "except_delta", "two_way_diff", "dq_suite", "dq_unique",
    "json_query", "html_listing", "euclid_topk", "batch_topk", "embed_text", "rag_context",
    "masked_users", "history_from_log", "history_scd2", "lake_upsert", "lake_delete_where",
    "day_partition_replace", "csv_typed_roundtrip", "parquet_roundtrip", "stream_movements",
]


def run_once(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    seconds = {}
    for name in names:
        run_once(spark, name, folder)
        seconds[name] = round(statistics.median(run_once(spark, name, folder) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()

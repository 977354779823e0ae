"""Wall seconds per query: one warm-up, then the median of three runs.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.
The chart table is derived before the clock starts; loads that write run
whole, and only once, as their first run is the one that matters.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chartloom.plans import testbed  # noqa: E402
from chartloom.plans.registry import QUERIES  # noqa: E402
from chartloom.session import build_session  # noqa: E402

RUNS = 3

# Over the chart table.
READS = [
    "overview",
    "overview_delta",
    "spread",
    "category_mix",
    "chart_size",
    "region_overlap",
    "exclusive_shared_all",
    "hours_to_trend_all",
    "publish_hour",
    "top_tags",
    "like_rate",
    "cross_region",
    "top_channels",
    "concentration",
    "daily_totals",
    "category_share",
    "avg_daily_overlap",
    "staying_power",
    "persistent_channels",
    "daily_churn",
    "semi_additive_last",
    "counter_delta",
    "dedup_region_sum",
    "tag_fanout_safe",
    "retitle_effect",
    "scd2_from_history",
    "self_pair_join",
    "top_k_per_group",
    # over orders and lineitem
    "scd2_customer_priority",
    "validity_join",
    "surrogate_keys",
    # over the raw zone
    "scan_manifest_batch",
    "lookup_join_default",
    "staging_projection",
    "rank_positions",
]

# Whole loads.
LOADS = ["sink_partition_replace", "backfill", "fact_load", "run_day", "stream_daily_load"]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    memory = os.environ.get("BENCH_MEMORY", "16g")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        **{"spark.driver.memory": memory},
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    rows = testbed.chart(spark, sf_dir).count()
    seconds = {"derive_chart": time.perf_counter() - start}
    for name in READS:
        timed(spark, name, sf_dir)
        seconds[name] = statistics.median(timed(spark, name, sf_dir) for _ in range(RUNS))
    for name in LOADS:
        seconds[name] = timed(spark, name, sf_dir)

    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall seconds of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": float(scale.group(1)) if scale else sf_dir,
                "chart_rows": rows,
                "master": spark.sparkContext.master,
                "shuffle_partitions": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

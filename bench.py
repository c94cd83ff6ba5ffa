"""Time the headline queries; print one JSON line.

Median of three warm runs each, forced to the end by a noop write.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from ledgerline.session import build_session
from ledgerline.trial.catalog import entries

HEADLINE = [
    "fact_transactions",
    "fact_cancellation_matches",
    "mart_purchases_hourly",
    "mart_revenue_daily",
    "mart_user_cohorts",
    "mart_data_quality_daily",
    "asof_bulk_lineitem",
    "asof_bulk_lineitem_shuffled",
    "quarantine_bulk_lineitem",
    "collision_counts_bulk_lineitem",
    "rt_transactions",
    "latest_by_key",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "ledgerline-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    found, seconds = entries(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            found[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians of 3 warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Times the headline queries, warm, and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallybook.catalog import queries  # noqa: E402
from tallybook.session import build_session  # noqa: E402

HEADLINE = (
    "recon_buckets",
    "recon_counts",
    "recon_rows",
    "hub_extract_recharge",
    "service_recon_bills",
    "wallet_flags_two_link",
    "upi_buckets",
    "up_buckets_sultanpursca",
    "refund_reconcile",
    "settlement_reconcile",
    "amount_reconcile",
    "bill_reconcile",
    "commission_reconcile",
    "daily_verdict_rows",
    "users_detail",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES")
    wanted = list(queries()) if names == "all" else (names or "").split(",")
    wanted = [n for n in wanted if n] or list(HEADLINE)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = queries()
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            # every row and column is computed, nothing reaches the driver
            catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "sum of median warm query times",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

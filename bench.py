"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads and
``BENCH_RUNS`` the timed runs per query after one warm-up (median is reported).
Results go to Spark's no-op sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.session import build_session  # noqa: E402
from ledgerline.workload.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "mart_revenue",
    "mart_attribution",
    "mart_stock",
    "join_program_match",
    "join_program_match_by_piece",
    "parse_stripe",
    "parse_paypal",
    "parse_google_ads",
    "parse_ga",
    "parse_sheet",
    "parse_facebook",
    "chk_stripe_pages",
    "chk_paypal_pages",
    "stg_stripe",
    "stg_paypal",
    "stg_students",
    "stg_inventory",
    "agg_stripe_month",
    "agg_paypal_month",
    "agg_daily_ads",
    "grain_report",
    "load_partition",
    "ingest_facebook",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "ledgerline-bench",
        f"local[{cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            frame = QUERIES[name](spark, sf_dir)
            frame.write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()

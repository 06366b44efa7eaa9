"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--all] [names...]

Each query is run to completion with the ``noop`` sink (every row is
computed, nothing is brought to the driver) and timed.  Prints one JSON
line: {"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "customer_spend", "loyalty_points_with_bonus_window", "first_item_after_join",
    "clean_runner_orders", "delivery_speed", "order_ingredient_list", "ingredient_totals_delivered",
    "next_plan_after_trial", "days_to_annual_histogram",
    "monthly_balances", "balance_increase_pct", "reallocation_percentiles",
    "clean_weekly_sales", "before_after_12w_by_year", "business_area_impact",
    "product_funnel", "visit_campaign_summary", "campaign_uplift",
    "segment_totals", "revenue_share_product_in_segment", "revenue_percentiles", "top_product_triple",
    "running_total_per_customer", "order_deltas", "items_in_favourite_colour",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    args = [a for a in sys.argv[1:] if not a.startswith("--")]

    from tidewater.plans import registry
    from tidewater.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=2 * cpus, app="tidewater-bench")
    reg = registry.load_all()
    names = args or (list(reg) if "--all" in sys.argv else HEADLINE)

    # Warm-up (JVM, parquet footers): not timed.
    registry.run("customer_visit_days", spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        registry.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    spark.stop()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()

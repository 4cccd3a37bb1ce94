"""Time the headline queries; prints one JSON line.

Every query runs in full: all rows of its result are produced and thrown away. Each is
run twice and the better time counts, so that the first run pays for compiling.
"""

from __future__ import annotations

import json
import os
import time

from starloom.plans.register import QUERIES
from starloom.session import local_session

HEADLINE = [
    "lookup_routes_with_kpis", "flight_full", "route_monthly_performance", "customer_rfm",
    "customer_lifetime", "feedback_sentiment", "feedback_tokens", "route_complaint_themes",
    "dim_customer_snapshot", "fct_flights", "fct_bookings", "fct_ancillary_offers",
    "fct_loyalty_events", "fct_customer_feedback", "high_value_at_risk",
    "strategic_underperforming", "premium_upsell", "loyal_detractor", "irops_heavy",
    "metrics_across_models", "report_revenue_by_route", "quality_sources", "warehouse_build",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, best of two",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

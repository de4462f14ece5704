"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
cores. Each query runs once to warm up, then twice more (BENCH_REPEATS); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.registry import all_queries
from millrace.session import build_session

HEADLINE = (
    "agg04_count_distinct",
    "agg14_quantiles",
    "agg17_box_stats",
    "dq03_describe",
    "dq11_record_rules",
    "job01_user_summary",
    "job02_top_categories",
    "job03_monthly_trend",
    "job04_top_customers",
    "job05_state_analysis",
    "job06_status_distribution",
    "job07_category_performance",
    "job08_delivery_performance",
    "job09_customer_segments",
    "job10_daily_summary",
    "job11_high_amount_alerts",
    "job12_velocity_alerts",
    "job15_patient_risk_weighted",
    "job17_hospital_ranking",
    "job25_repeated_firings",
    "job26_funnel",
    "job27_retention",
    "job29_friend_suggestions",
    "join01_inner_salted",
    "set04_new_by_key",
    "str02_window_counts",
    "txt01_sentiment",
    "txt02_keywords",
    "win05_trending_keywords",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", 2))
    spark = build_session("bench", f"local[{cpus}]", cpus, **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    wanted = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for name in wanted:
        laps = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

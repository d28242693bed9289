"""Wall-clock seconds of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` (optional) the
queries. Building the star schema is timed as a query of its own; the views then read the written
star, as they would in production. Every result is computed in full and dropped.
"""

from __future__ import annotations

import json
import os
import time

from tillstar.catalog import QUERIES
from tillstar.plans.star import star_of
from tillstar.session import local_session

HEADLINE = [
    "quarantine_rows", "clean_rows", "fact_order_items", "fact_enriched", "kpi_headline",
    "daily_sales", "monthly_trend", "sales_by_category", "sales_by_size", "hourly_demand",
    "weekday_hour_heatmap", "product_performance", "basket_profile", "product_affinity",
    "ingredient_exposure", "q03_weekday_pattern", "q11_best_worst_days", "dq_report",
    "profile_numeric", "profile_fd", "kpi_sliced", "moving_avg_calendar", "attach_rate",
    "scd2_product", "calendar_rollup", "stream_hourly",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.read.parquet(f"{sf_dir}/orders.parquet"))  # start the executor threads
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("build_star_retail", lambda: star_of(spark, sf_dir, "retail"))
    timed("build_star_counter", lambda: star_of(spark, sf_dir, "counter"))
    for name in names:
        timed(name, lambda: run(QUERIES[name](spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "total wall-clock of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query is built and run in full
into the no-op sink: one warm-up, then the median of ``BENCH_RUNS`` (3) wall times.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import build_session  # noqa: E402
from tidemark.suite import QUERIES  # noqa: E402

HEADLINE = [
    "h1_films_per_category",
    "h2_most_rented_actors",
    "h3_top_category_by_money",
    "h4_films_not_in_inventory",
    "h5_top_actors_in_category",
    "h6_customers_by_state",
    "h6_customers_by_state_per_group",
    "h7_longest_rented_categories",
    "l04_models_by_range",
    "l06_flights_into",
    "l09_not_departed",
    "l14_booking_stats",
    "l17_booking_stats_per_day",
    "l18_busiest_routes",
    "l19_flights_per_model",
    "l20_tickets_with_flight",
    "l21_tickets_per_day",
    "l22_tickets_per_day_tagged",
    "l25_tickets_per_day_and_status",
    "l28_largest_booking",
    "l29_tickets_keeping_unmatched",
    "a13_null_extended_count",
    "u05_difference",
    "u07_symmetric_difference",
    "r04_distinct_items",
    "s03_csv_export",
    "s17_daily_load",
]


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__checkpoint__dir=os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="tidemark-bench-"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(QUERIES[name], spark, folder)
        seconds[name] = round(statistics.median(run(QUERIES[name], spark, folder) for _ in range(runs)), 4)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder).removeprefix("sf"),
        "pyspark": spark.version,
        "cpus": cpus,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "driver_memory": spark.conf.get("spark.driver.memory", None),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

"""Times headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from tidemill.operators import aggregates as A, ordering as O, shape as P
from tidemill.plans import all_queries
from tidemill.plans.registry import Tables
from tidemill.session import build_session

REGISTERED = [
    "popularity_mart", "sales_grouping_sets", "mean_route_price", "median_price", "prices_of_supplier",
    "events_within_an_hour", "numbered_orders", "ranked_balances", "next_event", "upserted_orders",
    "fill_percentage", "load_by_weekday", "ingested_messages", "repeated_documents", "normalised_lines", "order_constraints",
]


def headline(spark, folder: str) -> dict:
    """The four query shapes with published numbers, on their nearest tables."""
    tables = Tables(spark, folder)
    queries = all_queries()
    return {
        "point_filter": lambda: P.eq_filter(tables.lineitem, "l_suppkey", 7).select("l_suppkey"),
        "four_table_join": lambda: queries["lines_of_chosen_customers"].run(spark, folder),
        "top_ten_by_count": lambda: O.top_by_count(tables.lineitem, ["l_partkey"], 10),
        "group_count": lambda: A.count_by(tables.lineitem, ["l_returnflag"]),
    }


def seconds(make, repeats: int = 3) -> float:
    """Best of a few runs, each building and running the whole plan."""
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 4)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    runs = headline(spark, folder)
    runs.update({name: (lambda name=name: registered[name].run(spark, folder)) for name in REGISTERED})
    for make in runs.values():  # a first round for the JVM to warm up
        make().write.format("noop").mode("overwrite").save()
    times = {name: seconds(make) for name, make in runs.items()}
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": folder.rsplit("sf", 1)[-1],
        "rows_per_sec": {
            "point_filter": round(lines / times["point_filter"]),
            "group_count": round(lines / times["group_count"]),
            "top_ten_by_count": round(lines / times["top_ten_by_count"]),
            "ingested_messages": round(events / times["ingested_messages"]),
        },
    }))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()

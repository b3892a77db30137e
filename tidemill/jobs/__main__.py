"""Runs a job: ``python -m tidemill.jobs JOB ...`` or by spark-submit; ``--help`` lists the arguments.

Tables are given as Parquet paths or catalog names.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tidemill.jobs import (
    customer_totals, graph_transactions, normalised_layer, object_store_load, popularity_mart, sensor_stream,
    session_stats,
)
from tidemill.session import build_session
from tidemill.sources.files import read_table
from tidemill.streaming.messages import message_source


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemill.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *places: str, database: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for place in places:
            sub.add_argument(place)
        sub.add_argument("--root", required=True, help="folder for what the job stores")
        if database:
            sub.add_argument("--database", required=True)
        return sub

    job("popularity_mart", "src").add_argument("--archive")
    job("customer_totals", "users", "orders").add_argument("--deliveries")
    sessions = job("session_stats", "sessions", "events")
    sessions.add_argument("--order-by", nargs="+", required=True)
    sessions.add_argument("--event-id", default="event_id")
    job("normalised_layer", "users", "orders").add_argument("--deliveries")
    sensors = job("sensor_stream", "servers", "topic", database=False)
    sensors.add_argument("--every", help="keep running with this interval, such as '10 seconds'")
    graph = job("graph_transactions", "customers", "made", "transactions")
    graph.add_argument("--since", type=dt.datetime.fromisoformat)
    graph.add_argument("--load-ts", type=dt.datetime.fromisoformat, required=True)
    job("object_store_load", "src", database=False).add_argument("--archive")
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    def table(name: str | None) -> DataFrame | None:
        return name and read_table(spark, name)

    if args.job == "popularity_mart":
        return popularity_mart.run(spark, args.src, args.root, args.database, args.archive)
    if args.job == "customer_totals":
        frames = table(args.users), table(args.orders)
        return customer_totals.run(spark, *frames, args.root, args.database, table(args.deliveries))
    if args.job == "session_stats":
        frames = table(args.sessions), table(args.events)
        return session_stats.run(spark, *frames, args.root, args.database, args.order_by, args.event_id)
    if args.job == "normalised_layer":
        frames = table(args.users), table(args.orders)
        return normalised_layer.run(spark, *frames, args.root, args.database, table(args.deliveries))
    if args.job == "sensor_stream":
        source = message_source(spark, **{"kafka.bootstrap.servers": args.servers, "subscribe": args.topic})
        return sensor_stream.run(spark, source, args.root, {"processingTime": args.every} if args.every else None)
    if args.job == "graph_transactions":
        frames = table(args.customers), table(args.made), table(args.transactions)
        name = f"{args.database}.bank_transactions"
        return graph_transactions.run(spark, *frames, name, args.root, args.load_ts, args.since)
    return object_store_load.run(spark, args.src, args.root, archive=args.archive)


def main() -> None:
    parser = arguments()
    args = parser.parse_args()
    spark = build_session(f"tidemill {args.job}")
    if "database" in args and spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        parser.error("tables need a lasting catalog; set spark.sql.catalogImplementation, such as to hive")
    print(f"{args.job}: {run(spark, args).count()} rows")


if __name__ == "__main__":
    main()

"""Order sums per customer: sheets -> raw (unknown keys only) -> mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.operators.aggregates import customer_totals
from tidemill.operators.changes import new_rows
from tidemill.sources.sinks import append, ensure_table, fitted, upsert_table

# Table columns and keys.
USERS = "name STRING, surname STRING, city STRING, age INT, card_number STRING"
ORDERS = "id INT, name STRING, count INT, price DECIMAL(18,2), total_cost DECIMAL(18,2), card_number STRING"
DELIVERIES = (
    "delivery_number STRING, order_id INT, product_array STRING, delivery_company STRING, "
    "delivery_cost DECIMAL(18,2), courier_name STRING, courier_phone STRING, start_time TIMESTAMP, "
    "end_time TIMESTAMP, delivery_city STRING, warehouse_from STRING, warehouse_address STRING"
)
MART = "name STRING, card_number STRING, total_order_sum DECIMAL(24,2)"


def load(spark: SparkSession, table: str, schema: str, rows: DataFrame, key: str, root: str) -> None:
    """Adds the rows whose key the table lacks."""
    ensure_table(spark, table, schema, root)
    append(new_rows(spark.table(table), fitted(rows, table), [key]), table)


def run(
    spark: SparkSession, users: DataFrame, orders: DataFrame, root: str, database: str,
    deliveries: DataFrame | None = None,
) -> DataFrame:
    load(spark, f"{database}.users", USERS, users, "card_number", root)
    load(spark, f"{database}.orders", ORDERS, orders, "id", root)
    if deliveries is not None:
        load(spark, f"{database}.deliveries_data", DELIVERIES, deliveries, "delivery_number", root)
    mart = f"{database}.user_orders_summary"
    ensure_table(spark, mart, MART, root)
    totals = customer_totals(
        spark.table(f"{database}.users"), spark.table(f"{database}.orders"), "card_number", "name", "total_cost"
    )
    upsert_table(spark, mart, fitted(totals, mart), ["card_number"], ["card_number"], root)
    return spark.table(mart)

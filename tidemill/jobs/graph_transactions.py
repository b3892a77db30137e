"""Customer transactions from the graph to a flat table, each transaction once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.operators.changes import new_rows
from tidemill.operators.graph import graph_rows
from tidemill.operators.shape import stamp
from tidemill.sources.files import extract_since
from tidemill.sources.sinks import append, ensure_table, fitted

# Table columns and the node properties they come from.
TABLE = (
    "transaction_id STRING, customer_id STRING, customer_name STRING, amount DOUBLE, currency STRING, "
    "transaction_type STRING, status STRING, transaction_timestamp TIMESTAMP, customer_email STRING, "
    "customer_created_at TIMESTAMP, load_ts TIMESTAMP"
)
CUSTOMER = {
    "customer_id": "customer_id", "name": "customer_name", "email": "customer_email",
    "created_at": "customer_created_at",
}
TRANSACTION = {
    "transaction_id": "transaction_id", "amount": "amount", "currency": "currency",
    "type": "transaction_type", "status": "status", "timestamp": "transaction_timestamp",
}


def extract(customers: DataFrame, made: DataFrame, transactions: DataFrame, since=None) -> DataFrame:
    """Flat rows of the transactions since a time; filtered before any join."""
    recent = transactions if since is None else extract_since(transactions, "timestamp", since)
    return graph_rows(customers, made, recent, "customer_id", "transaction_id", CUSTOMER, TRANSACTION)


def run(
    spark: SparkSession, customers: DataFrame, made: DataFrame, transactions: DataFrame,
    table: str, root: str, load_ts, since=None, look_back: str = "5 minutes",
) -> DataFrame:
    """Adds the transactions not in the table yet.

    Without ``since``, those from the table's own latest time less ``look_back`` on are read, and
    only that part of the table is compared.
    """
    ensure_table(spark, table, TABLE, root)
    known = spark.table(table)
    if since is None:
        mark = known.agg(F.max("transaction_timestamp") - F.expr(f"INTERVAL {look_back}")).first()[0]
        since = None if mark is None else F.lit(mark)
        known = known if mark is None else known.filter(F.col("transaction_timestamp") >= since)
    rows = stamp(extract(customers, made, transactions, since), load_ts, {"amount": 0.0})
    append(new_rows(known, fitted(rows, table), ["transaction_id"]), table)
    return spark.table(table)

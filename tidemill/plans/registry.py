"""The registered queries: each runs an operator over the given tables and carries the SQL that
states the same result, where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.functions.scalar import two_decimals
from tidemill.session import scratch_path


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


# Columns of the given tables, so that no file is opened to learn them.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}

QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Registers ``fn(tables) -> DataFrame`` under its own name."""

    def register(fn):
        if fn.__name__ in QUERIES:
            raise ValueError(f"two queries are named {fn.__name__}")
        QUERIES[fn.__name__] = Query(
            fn.__name__, lambda spark, sf: fn(Tables(spark, sf)), sql, tuple(covers.split())
        )
        return fn

    return register


class Tables:
    """The given tables of one data folder as attributes, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self._folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    def scratch(self, kind: str) -> str:
        return scratch_path(self.spark, kind)

    @property
    def sales(self) -> DataFrame:
        """Line items as order positions with fixed-point amounts."""
        return self.lineitem.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate",
            F.col("l_quantity").cast("int").alias("quantity"), two_decimals("l_extendedprice").alias("price"),
        )

    @property
    def bookings(self) -> DataFrame:
        """Orders with a fixed-point amount."""
        return self.orders.select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
            two_decimals("o_totalprice").alias("amount"),
        )

    @property
    def accounts(self) -> DataFrame:
        """Customers with a fixed-point balance."""
        return self.customer.select(
            "c_custkey", "c_name", "c_nationkey", "c_mktsegment", two_decimals("c_acctbal").alias("balance")
        )

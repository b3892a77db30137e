"""Tables laid out by bucket, bloom filter and statistics; normal forms derived from dependencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.operators import dependencies as D, ordering as O, shape as P
from tidemill.plans.aggregates import AMOUNT, as_double
from tidemill.plans.registry import Tables, query
from tidemill.plans.storage import LATER, TARGET, database, later, target
from tidemill.sources import layouts as L


@query("J1 K7", "SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def lines_joined_by_bucket(t: Tables):
    name = database()
    lines = L.store_bucketed(t.lineitem.select("l_orderkey", "l_linenumber"), f"{name}.lines", ["l_orderkey"], 16)
    orders = L.store_bucketed(t.orders.select("o_orderkey", "o_orderstatus"), f"{name}.orders", ["o_orderkey"], 16)
    joined = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "o_orderstatus")


@query("K7", f"""
    SELECT * FROM {TARGET} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {LATER})
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {LATER} WHERE version = 2""")
def orders_upserted_by_bucket(t: Tables):
    name = f"{database()}.orders"
    L.store_bucketed(target(t), name, ["o_orderkey"], 16)
    return L.upsert_bucketed(t.spark, name, later(t), ["o_orderkey"], ["version"], 16)


@query("S3 P4", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey = 7")
def lines_of_a_part_by_bloom(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    path = L.write_with_blooms(rows, t.scratch("blooms"), {"l_partkey": 20_000}, ["l_orderkey", "l_linenumber"])
    return P.eq_filter(t.spark.read.schema(rows.schema).parquet(path), "l_partkey", 7)


FOUR_TABLES = """
    SELECT l_linenumber, c_name, p_name FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
    JOIN {customer} ON o_custkey = c_custkey JOIN {part} ON l_partkey = p_partkey
    WHERE c_custkey IN (17, 42, 105) AND l_linenumber < 5"""


@query("J3 P7", FOUR_TABLES.format(lineitem="lineitem", orders="orders", customer="customer", part="part"))
def four_tables_by_statistics(t: Tables):
    return L.by_statistics(t.spark).sql(FOUR_TABLES.format(**analysed(t)))


def analysed(t: Tables) -> dict[str, str]:
    """The four tables in the catalog, with statistics of their join and filter columns."""
    columns = {
        "lineitem": ["l_orderkey", "l_partkey", "l_linenumber"], "orders": ["o_orderkey", "o_custkey"],
        "customer": ["c_custkey"], "part": ["p_partkey"],
    }
    name = database()
    t.spark.sql(f"CREATE DATABASE {name}")
    for table, own in columns.items():
        t.spark.catalog.createTable(f"{name}.{table}", path=t.path(table), source="parquet")
        L.analyse(t.spark, f"{name}.{table}", own)
    return {table: f"{name}.{table}" for table in columns}


DEPENDENCIES = [
    D.depends("o_orderkey", "c_custkey o_orderpriority amount c_name"), D.depends("c_custkey", "c_name c_nationkey"),
    D.depends("c_nationkey", "n_name"), D.depends("o_orderkey c_custkey", "n_name"),
]


def wide_orders(t: Tables) -> DataFrame:
    joined = t.bookings.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("o_orderkey", "o_orderpriority", "amount", "c_custkey", "c_name", "c_nationkey", "n_name")


@query("V11 V12", f"""
    SELECT o_orderkey, o_orderpriority, {AMOUNT}::DOUBLE AS amount, c_custkey, c_name, c_nationkey, n_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def orders_in_third_normal_form(t: Tables):
    rows = wide_orders(t)
    tables = D.split(rows, DEPENDENCIES)  # orders, customers, nations
    return as_double(D.join_back(tables, rows.columns), "amount")


@query("V12 V11", """
    SELECT 'c_custkey -> o_orderpriority' AS dependency, count(*) AS n_broken
    FROM (SELECT o_custkey FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1)
    UNION ALL SELECT 'c_custkey -> n_name', 0""")
def dependencies_that_break(t: Tables):
    return D.broken_report(wide_orders(t), [D.depends("c_custkey", "o_orderpriority"), D.depends("c_custkey", "n_name")])


@query("A10", """
    SELECT CASE WHEN l_returnflag = 'N' THEN 'hot' ELSE CAST(l_suppkey AS VARCHAR) END AS k, round(quantile_cont(l_extendedprice, 0.5), 4) AS median
    FROM lineitem GROUP BY 1""")
def median_with_hot_key(t: Tables):
    key = F.when(F.col("l_returnflag") == "N", "hot").otherwise(F.col("l_suppkey").cast("string"))
    found = O.median_by(t.lineitem.select(key.alias("k"), "l_extendedprice"), ["k"], "l_extendedprice", max_group_rows=1_000)
    return found.withColumn("median", F.round("median", 4))

"""Loads of several tables at once, changes by file, loads behind a gate, streams whose folders are folded."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.jobs import popularity_mart as popularity_job
from tidemill.operators import changes as C, quality as V, shape as P
from tidemill.plans.aggregates import MONEY, as_double, half_up
from tidemill.plans.registry import Tables, query
from tidemill.plans.storage import UPDATES, database, updates
from tidemill.plans.streams import READING, readings
from tidemill.sources import releases as L
from tidemill.sources.sinks import to_messages
from tidemill.streaming import folding, messages as SM

STATUS = "o_orderkey BIGINT, o_orderstatus STRING"
PERSON = "c_custkey BIGINT, c_name STRING, c_nationkey INT"


def sold(items: str, name: str) -> str:
    return f"""
        SELECT CAST(p_partkey + 1 AS INTEGER) AS product_id, {name} AS product_name, CAST(sum(l_quantity) AS BIGINT) AS total_quantity_sold,
               sum(CAST(l_quantity AS DECIMAL(18,2)) * {MONEY})::DOUBLE AS total_revenue, count(DISTINCT l_orderkey) AS order_count,
               ({half_up('l_extendedprice', 2)})::DOUBLE AS avg_price
        FROM (SELECT * FROM lineitem WHERE {items} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey
              ORDER BY l_returnflag = 'R' DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
        JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, p_name"""


class Interrupted(Exception):
    """Raised on purpose in the middle of a load."""


@query("E1 K7 K3", f"""
    SELECT 'after failure' AS state, * FROM ({sold("l_returnflag <> 'R'", "p_name")})
    UNION ALL SELECT 'after repeat', * FROM ({sold("true", "upper(p_name)")})""")
def popularity_after_failed_load(t: Tables):
    root, name = t.scratch("popularity"), database()
    src = {kind: f"{root}/in/{kind}" for kind in popularity_job.TABLES}

    def land(returned: bool, product: F.Column) -> None:
        parts = t.part.select((F.col("p_partkey") + 1).alias("product_id"), product.alias("product_name"))
        orders = t.orders.select((F.col("o_orderkey") + 1).alias("order_id"), F.to_date("o_orderdate").alias("order_date"))
        items = t.lineitem.filter((F.col("l_returnflag") == "R") == F.lit(returned)).repartition("l_orderkey").sortWithinPartitions(
            "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice"
        ).select(
            (F.col("l_orderkey") + 1).alias("order_id"), (F.col("l_partkey") + 1).alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        )
        for kind, rows in (("products", parts), ("orders", orders), ("order_items", items)):
            rows.write.mode("append").option("header", True).csv(src[kind])

    def interrupt(table: str) -> None:
        if table == "order_items":
            raise Interrupted(table)

    land(False, F.col("p_name"))
    popularity_job.run(t.spark, src, root, name)
    land(True, F.upper("p_name"))
    try:
        popularity_job.run(t.spark, src, root, name, before_table=interrupt)
    except Interrupted:
        failed = popularity_job.mart(t.spark, root)
    repeated = popularity_job.run(t.spark, src, root, name)
    both = failed.withColumn("state", F.lit("after failure")).unionByName(repeated.withColumn("state", F.lit("after repeat")))
    return as_double(both, "total_revenue", "avg_price")


def released(t: Tables, table: str, rows: DataFrame, key: str) -> L.Release:
    """A table of many files, each with a range of keys."""
    empty = L.draft(t.spark, t.scratch("releases"))
    return empty.replaced(table, rows.repartitionByRange(16, key)).saved()


@query("K9", f"""
    SELECT o.o_orderkey, coalesce(u.o_orderstatus, o.o_orderstatus) AS o_orderstatus
    FROM orders o LEFT JOIN {UPDATES} u ON u.o_orderkey = o.o_orderkey""")
def statuses_updated_by_file(t: Tables):
    start = released(t, "orders", t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey")
    changed, _ = start.rows_updated("orders", STATUS, updates(t), "o_orderkey", "o_orderstatus", ["step"])
    changed.saved()
    return L.current(t.spark, start.root).read("orders", STATUS)


@query("K9", f"""
    SELECT count(*) FILTER (WHERE o.o_orderkey IS NOT NULL) AS n_updated,
           count(*) FILTER (WHERE o.o_orderkey IS NULL) AS n_unknown
    FROM {UPDATES} u LEFT JOIN orders o ON u.o_orderkey = o.o_orderkey""")
def update_report_by_file(t: Tables):
    start = released(t, "orders", t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey")
    return C.update_counts(start.rows_updated("orders", STATUS, updates(t), "o_orderkey", "o_orderstatus", ["step"])[1])


@query("K10", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE NOT (c_nationkey = 7 AND c_custkey > 10)")
def customers_deleted_by_file(t: Tables):
    start = released(t, "people", t.customer.select("c_custkey", "c_name", "c_nationkey"), "c_custkey")
    start.rows_deleted("people", PERSON, (F.col("c_nationkey") == 7) & (F.col("c_custkey") > 10)).saved()
    return L.current(t.spark, start.root).read("people", PERSON)


@query("K11", """
    SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey <> 3
    UNION ALL SELECT c_custkey, 'moved', 4 FROM customer WHERE c_nationkey = 3
    UNION ALL SELECT c_custkey + 1000000000, 'new', 3 FROM customer WHERE c_nationkey = 3""")
def customers_replaced_by_file(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey")
    start = released(t, "people", rows, "c_custkey")
    moving = P.eq_filter(rows, "c_nationkey", 3)
    moved = moving.withColumns({"c_name": F.lit("moved"), "c_nationkey": F.lit(4)})
    added = moving.withColumns({"c_custkey": F.col("c_custkey") + 1_000_000_000, "c_name": F.lit("new")})
    start.rows_replaced("people", PERSON, moved.unionByName(added), ["c_custkey"]).saved()
    return L.current(t.spark, start.root).read("people", PERSON)


@query("K3 K7", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS y
    FROM orders WHERE year(o_orderdate) <> 1995""")
def orders_replaced_by_year(t: Tables):
    schema = f"{STATUS}, y INT"
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    start = L.draft(t.spark, t.scratch("releases")).replaced("orders", rows, part="y").saved()
    paid = P.eq_filter(rows, "o_orderstatus", "P").withColumn("o_orderstatus", F.lit("X"))
    changed = start.upserted("orders", schema, paid, ["o_orderkey"], ["o_orderstatus"], part="y")
    changed.replaced("orders", changed.read("orders", schema, [1995]).filter(F.lit(False)), "y", [1995]).saved()
    return L.current(t.spark, start.root).read("orders", schema)


@query("V1 V3 V4 K2", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1")
def loads_behind_a_gate(t: Tables):
    rules = [V.required("l_orderkey"), V.positive_number("l_quantity"), V.one_of("l_returnflag", ["A", "N"])]
    release = L.draft(t.spark, t.scratch("releases"))
    for flag in ("A", "N", "R", "no such flag"):
        try:
            rows = P.eq_filter(t.lineitem, "l_returnflag", flag).select("l_orderkey", "l_quantity", "l_returnflag")
            release = release.appended("lines", rows, L.Gate(rules)).saved()
        except L.GateError:
            continue
    lines = L.current(t.spark, release.root).read("lines", "l_orderkey BIGINT, l_quantity DOUBLE, l_returnflag STRING")
    return lines.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("R1 R2 E5", "SELECT event_id, user_id, value FROM events WHERE event_type <> 'error'")
def folded_messages(t: Tables):
    table, rejects = t.scratch("readings"), t.scratch("rejects")
    topic = t.scratch("topic")
    for half in (0, 1):  # a second run goes on after the batches that the first one folded
        rows = readings(t).filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half)
        to_messages(rows).repartition(3).write.mode("append").text(topic)
        source = SM.message_source(t.spark, "text", topic, maxFilesPerTrigger=1)
        SM.ingest_stream(source, READING, table, rejects, fold_every=2).awaitTermination()
    folding.fold(t.spark, table, READING)
    folding.drop_folded(t.spark, table)
    return SM.stored_records(t.spark, table, READING)

"""Streaming ingest and the jobs that run from raw data to a mart.

Messages and files are written from the given tables first; every stream takes what is there and
stops, so its result can be compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemill.jobs import (
    customer_totals, graph_transactions, normalised_layer, object_store_load, popularity_mart as popularity_job,
    sensor_stream, session_stats,
)
from tidemill.operators import shape as P
from tidemill.plans.aggregates import AMOUNT, MONEY, as_double, half_up
from tidemill.plans.registry import Tables, query
from tidemill.plans.storage import ORDER, ORDER_COLUMNS, database
from tidemill.sources.sinks import append, ensure_table, to_messages
from tidemill.streaming import files as SF, messages as SM

READING = StructType().add("event_id", "long", False).add("user_id", "long", False).add("value", "double", False)


def topic(t: Tables, rows: DataFrame) -> str:
    """Rows as JSON lines in a folder of their own."""
    path = t.scratch("topic")
    to_messages(rows).write.text(path)
    return path


def readings(t: Tables) -> DataFrame:
    """Events as messages; those of errors lack their value."""
    return t.events.select("event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))


GOOD = "SELECT event_id, user_id, value FROM events WHERE event_type <> 'error'"


@query("S5 R1", GOOD)
def ingested_messages(t: Tables):
    table, rejects = t.scratch("readings"), t.scratch("rejects")
    source = SM.message_source(t.spark, "text", topic(t, readings(t)))
    SM.ingest_stream(source, READING, table, rejects).awaitTermination()
    return SM.stored_records(t.spark, table, READING)


@query("R2 K12", GOOD)
def appended_messages(t: Tables):
    source = SM.message_source(t.spark, "text", topic(t, readings(t)), maxFilesPerTrigger=1)
    good, _ = SM.split_bad(source, READING)
    path = t.scratch("appended")
    SM.append_batches(good, path, t.scratch("checkpoint")).awaitTermination()
    return t.spark.read.parquet(path)


@query("R3", """
    SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS value, 'missing: value' AS problem
    FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'not json ' || event_id, 'not a record of the schema' FROM events WHERE event_type = 'view'""")
def rejected_messages(t: Tables):
    path = topic(t, readings(t))
    broken = P.eq_filter(t.events, "event_type", "view").select(F.concat(F.lit("not json "), "event_id").alias("value"))
    broken.write.mode("append").text(path)
    table, rejects = t.scratch("readings"), t.scratch("rejects")
    SM.ingest_stream(SM.message_source(t.spark, "text", path), READING, table, rejects).awaitTermination()
    return SM.stored_rejects(t.spark, rejects)


@query("R4 K13", """
    SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
    FROM events""")
def published_messages(t: Tables):
    rows = t.events.select("event_id", "user_id", "event_type")
    landed = t.scratch("landed")
    rows.write.parquet(landed)
    stream = t.spark.readStream.schema(rows.schema).parquet(landed)
    path = t.scratch("published")
    SM.publish(stream, t.scratch("checkpoint"), path=path).awaitTermination()
    return SM.published(t.spark, path)


def land_orders(t: Tables, status: str, path: str) -> None:
    rows = P.eq_filter(t.orders.select(*ORDER_COLUMNS), "o_orderstatus", status)
    rows.write.mode("append").option("header", True).csv(path)


@query("S12 R5", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def files_taken_once(t: Tables):
    src, dst, checkpoint = t.scratch("src"), t.scratch("dst"), t.scratch("checkpoint")
    for status in ("F", "O", "P"):
        land_orders(t, status, src)
        for _ in range(2):
            SF.ingest_new_files(t.spark, src, dst, checkpoint, StructType.fromDDL(ORDER), glob="*.csv").awaitTermination()
    return t.spark.read.parquet(dst).select(*ORDER_COLUMNS)


@query("S13", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def file_by_file(t: Tables):
    src, dst = t.scratch("src"), t.scratch("dst")
    for status in ("F", "O", "P"):
        land_orders(t, status, src)
    SF.ingest_new_files(
        t.spark, src, dst, t.scratch("checkpoint"), StructType.fromDDL(ORDER),
        glob="*.csv", max_files=1, archive=t.scratch("archive"),
    ).awaitTermination()
    return t.spark.read.parquet(dst).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("R6 S14 K6", """
    SELECT event_id, user_id, ts FROM events
    WHERE ts >= (SELECT max(ts) FROM events WHERE event_type <> 'error' AND ts < TIMESTAMP '2024-01-20') - INTERVAL 1 DAY
      AND NOT (event_type <> 'error' AND ts < TIMESTAMP '2024-01-20')""")
def synced_events(t: Tables):
    before = P.before(t.events, "ts", "2024-01-20")
    known = before.filter(F.col("event_type") != "error").select("event_id", "ts")
    return SF.sync_new(t.events.select("event_id", "user_id", "ts"), known, "ts", ["event_id"], "1 day")


@query("R6 S14 K2", """
    SELECT event_id, user_id, ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE event_type <> 'error' OR ts >=
        (SELECT max(ts) FROM events WHERE event_type <> 'error' AND ts < TIMESTAMP '2024-01-20') - INTERVAL 1 DAY""")
def events_synced_by_day(t: Tables):
    name = f"{database()}.events"
    ensure_table(t.spark, name, "event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, day DATE", partition_by=["day"])
    rows = t.events.select("event_id", "user_id", "ts")
    before = P.before(t.events, "ts", "2024-01-20").filter(F.col("event_type") != "error").select(*rows.columns)
    append(before.withColumn("day", F.to_date("ts")).hint("rebalance", "day"), name)
    for _ in range(2):
        SF.sync_by_day(rows, name, "ts", ["event_id"], "1 day")
    return t.spark.table(name).withColumn("day", F.col("day").cast("string"))


LAST_ITEMS = """(SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey
                               ORDER BY l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) = 1)"""


@query("E1 A23", f"""
    SELECT CAST(p_partkey + 1 AS INTEGER) AS product_id, p_name AS product_name,
           CAST(sum(l_quantity) AS BIGINT) AS total_quantity_sold,
           sum(CAST(l_quantity AS DECIMAL(18,2)) * {MONEY})::DOUBLE AS total_revenue,
           count(DISTINCT l_orderkey) AS order_count, ({half_up('l_extendedprice', 2)})::DOUBLE AS avg_price
    FROM {LAST_ITEMS} JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, p_name""")
def popularity_from_files(t: Tables):
    root = t.scratch("popularity")
    parts = t.part.select((F.col("p_partkey") + 1).alias("product_id"), F.col("p_name").alias("product_name"))
    orders = t.orders.select((F.col("o_orderkey") + 1).alias("order_id"), F.to_date("o_orderdate").alias("order_date"))
    items = t.lineitem.repartition("l_orderkey").sortWithinPartitions(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice"
    ).select(
        (F.col("l_orderkey") + 1).alias("order_id"), (F.col("l_partkey") + 1).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
    )
    src = {}
    for name, rows in (("products", parts), ("orders", orders), ("order_items", items)):
        src[name] = f"{root}/in/{name}"
        rows.write.option("header", True).csv(src[name])
    name = database()
    for _ in range(2):
        mart = popularity_job.run(t.spark, src, root, name)
    return as_double(mart, "total_revenue", "avg_price")


@query("E2 A24", f"""
    SELECT c_name AS name, 'card' || c_custkey AS card_number, coalesce(sum({AMOUNT}), 0)::DOUBLE AS total_order_sum
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""")
def customer_sums_from_raw(t: Tables):
    users = t.customer.select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("surname"),
        F.col("c_nationkey").cast("string").alias("city"), F.lit(30).alias("age"),
        F.concat(F.lit("card"), "c_custkey").alias("card_number"),
    )
    orders = t.bookings.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.lit(1).alias("count"),
        F.col("amount").alias("price"), F.col("amount").alias("total_cost"),
        F.concat(F.lit("card"), "o_custkey").alias("card_number"),
    )
    root, name = t.scratch("totals"), database()
    for _ in range(2):
        mart = customer_totals.run(t.spark, users, orders, root, name)
    return as_double(mart, "total_order_sum")


@query("E3 A25 J12 P22", """
    SELECT round(avg(seconds), 4) AS avg_duration_sec, avg(n) AS avg_event_count FROM (
        SELECT (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000 AS seconds, count(*) AS n
        FROM events GROUP BY user_id, CAST(ts AS DATE)) WHERE seconds > 0""")
def session_summary_from_raw(t: Tables):
    session = F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd")).alias("session_id")
    events = t.events.select("event_id", session, F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    ends = events.groupBy("session_id").agg((F.max("us") - F.min("us")).alias("us"))
    sessions = ends.select(
        "session_id", (F.col("us").cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)").alias("duration_sec"),
        F.explode(F.array(F.lit(2), F.lit(1))).alias("version"),
    ).withColumn("duration_sec", F.when(F.col("version") == 2, F.col("duration_sec")).otherwise(F.lit(0)))
    root, name = t.scratch("sessions"), database()
    for _ in range(2):
        summary = session_stats.run(t.spark, sessions, events.unionByName(events), root, name, ["version"])
    return summary.withColumn("avg_duration_sec", F.round("avg_duration_sec", 4))


@query("E4 V5 V8 V9", """
    SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id, 'card' || o_custkey AS card_number,
           dense_rank() OVER (ORDER BY o_orderpriority) AS product_id, CAST(o_totalprice AS DECIMAL(10,2))::DOUBLE AS total_price
    FROM orders""")
def normalised_orders_from_raw(t: Tables):
    root, name = t.scratch("layer"), database()
    users, orders, deliveries = raw_layer(t)
    for _ in range(2):
        table = normalised_layer.run(t.spark, users, orders, root, name)
    return as_double(table.select("order_id", "user_id", "card_number", "product_id", "total_price"), "total_price")


@query("E4 V10", """
    SELECT 'd' || o_orderkey AS delivery_id, CAST(o_orderkey AS INTEGER) AS order_id,
           dense_rank() OVER (ORDER BY o_orderpriority) AS product_id, dense_rank() OVER (ORDER BY o_orderstatus) AS company_id,
           dense_rank() OVER (ORDER BY c_mktsegment) AS courier_id, dense_rank() OVER (ORDER BY n_name) AS warehouse_id
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def normalised_deliveries_from_raw(t: Tables):
    root, name = t.scratch("layer"), database()
    users, orders, deliveries = raw_layer(t)
    for _ in range(2):
        normalised_layer.run(t.spark, users, orders, root, name, deliveries)
    return t.spark.table(f"{name}.deliveries").select(
        "delivery_id", "order_id", "product_id", "company_id", "courier_id", "warehouse_id"
    )


@query("E4 V8 S12", """
    SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
           dense_rank() OVER (ORDER BY o_orderpriority) AS product_id
    FROM orders""")
def normalised_orders_from_files(t: Tables):
    src, root, name = t.scratch("files"), t.scratch("layer"), database()
    places = {kind: f"{src}/{kind}" for kind in normalised_layer.RAW}
    for (kind, place), rows in zip(places.items(), raw_layer(t)):
        names = StructType.fromDDL(normalised_layer.RAW[kind][0]).fieldNames()
        rows.select(*names).write.option("header", True).csv(place)
    for _ in range(2):
        table = normalised_layer.run_files(t.spark, places, root, name)
    return table.select("order_id", "user_id", "product_id")


@query("E4 V5", """
    SELECT CAST(c_custkey AS VARCHAR) AS user_id, 'age must be a whole number' AS errors FROM customer WHERE c_acctbal < 0""")
def users_rejected_by_layer(t: Tables):
    root, name = t.scratch("layer"), database()
    users, orders, _ = raw_layer(t)
    in_debt = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("user_id"))
    good = users.join(in_debt, "user_id", "left_anti").withColumn("age", F.lit("30"))
    bad = users.join(in_debt, "user_id").withColumn("age", F.lit("unknown"))
    normalised_layer.run(t.spark, good.unionByName(bad), orders, root, name)
    return t.spark.table(f"{name}.rejected_users").select("user_id", "errors")


@query("E1 V4", "SELECT DISTINCT CAST(l_orderkey + 1 AS VARCHAR) AS order_id FROM lineitem WHERE l_returnflag = 'R'")
def items_rejected_by_popularity(t: Tables):
    src, root = t.scratch("items"), t.scratch("popularity")
    places = {kind: f"{src}/{kind}" for kind in popularity_job.TABLES}
    t.part.select((F.col("p_partkey") + 1).alias("product_id"), F.col("p_name").alias("product_name")).write.option("header", True).csv(places["products"])
    t.orders.select((F.col("o_orderkey") + 1).alias("order_id"), F.to_date("o_orderdate").alias("order_date")).write.option("header", True).csv(places["orders"])
    returned = F.col("l_returnflag") == "R"
    items = t.lineitem.select(
        returned.alias("bad"), (F.col("l_orderkey") + 1).alias("order_id"), (F.col("l_partkey") + 1).alias("product_id"),
        F.when(returned, F.lit(3_000_000_000)).otherwise(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
    ).distinct()
    for bad in (True, False):
        items.filter(F.col("bad") == bad).drop("bad").write.mode("append").option("header", True).csv(places["order_items"])
    popularity_job.load_raw(t.spark, places, root)
    rejects = t.spark.read.parquet(f"{root}/rejects/order_items")
    return rejects.filter(F.array_contains("errors", "quantity must be of type int")).select("order_id").distinct()


def raw_layer(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw users, orders and deliveries with some rows repeated."""
    user = F.col("c_custkey").cast("string").alias("user_id")
    card = F.concat(F.lit("card"), "c_custkey").alias("card_number")
    users = t.customer.select(
        user, F.col("c_name").alias("name"), F.col("c_mktsegment").alias("surname"), F.lit(30).alias("age"),
        F.lower("c_name").alias("email"), F.lit("0").alias("phone"), card,
    )
    rows = t.bookings.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    orders = rows.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("product"), F.lit(1).alias("quantity"),
        F.col("amount").alias("price_per_unit"), F.col("amount").alias("total_price"), card, user,
    )
    located = rows.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    deliveries = located.select(
        F.concat(F.lit("d"), "o_orderkey").alias("delivery_id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("product"), F.col("o_orderstatus").alias("company"), F.lit(5).alias("cost"),
        F.col("c_mktsegment").alias("courier_name"), F.lit("0").alias("courier_phone"),
        F.to_date("o_orderdate").alias("start_time"), F.to_date("o_orderdate").alias("end_time"),
        F.col("n_name").alias("city"), F.col("n_name").alias("warehouse"), F.lit("street").alias("address"),
    )
    return users.unionByName(users), orders.unionByName(orders), deliveries


@query("E5 R1 R3", """
    SELECT 'sensor_' || (user_id % 5 + 1) AS sensor_id, ts AS timestamp, value
    FROM events WHERE event_type <> 'error'""")
def sensor_readings(t: Tables):
    sensor = F.concat(F.lit("sensor_"), F.col("user_id") % 5 + 1).alias("sensor_id")
    known = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    rows = t.events.select(sensor, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), known)
    path, root = topic(t, rows), t.scratch("sensors")
    for _ in range(2):
        found = sensor_stream.run(t.spark, SM.message_source(t.spark, "text", path), root)
    return found.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("E6 S7 S14 P18 K6", """
    SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(c_custkey AS VARCHAR) AS customer_id,
           c_name AS customer_name, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS amount,
           o_orderstatus AS status, o_orderdate AS transaction_timestamp, TIMESTAMP '2024-02-01 12:00:00' AS load_ts
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def transactions_from_graph(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("name"),
        F.lower("c_name").alias("email"), F.lit("2024-01-01").cast("timestamp").alias("created_at"),
    )
    amount = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("amount")
    transactions = t.orders.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"), amount, F.lit("USD").alias("currency"),
        F.col("o_orderpriority").alias("type"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )
    made = t.orders.select(
        F.col("o_custkey").cast("string").alias("src_id"), F.col("o_orderkey").cast("string").alias("dst_id")
    )
    root, table = t.scratch("graph"), f"{database()}.bank_transactions"
    since, now = F.lit("1999-01-01").cast("timestamp"), F.lit("2024-02-01 12:00:00").cast("timestamp")
    for _ in range(2):
        found = graph_transactions.run(t.spark, customers, made, transactions, table, root, now, since)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("transaction_timestamp", "load_ts")}
    return found.withColumns(times).select(
        "transaction_id", "customer_id", "customer_name", "amount", "status", "transaction_timestamp", "load_ts"
    )


@query("E7 S6 S12", """
    SELECT CAST(event_id AS INTEGER) AS id, CAST(user_id AS INTEGER) AS value FROM events
    WHERE event_type <> 'error'""")
def objects_loaded_once(t: Tables):
    src, root = t.scratch("objects"), t.scratch("loaded")
    for kind in ("click", "view", "error", "signup", "purchase"):
        value = F.lit("oops") if kind == "error" else F.col("user_id").cast("string")
        rows = P.eq_filter(t.events, "event_type", kind).select(F.col("event_id").alias("id"), value.alias("value"))
        rows.write.mode("append").option("header", True).csv(src)
        found = object_store_load.run(t.spark, src, root)
    return found.select("id", "value")

"""Sources, sinks and table changes. Files are first written from the given tables, so each query
reads what Spark derived from them."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemill.functions import scalar as S
from tidemill.operators import aggregates as A, changes as C, graph as G, joins as J, ordering as O, shape as P
from tidemill.plans.aggregates import as_double
from tidemill.plans.registry import Tables, query
from tidemill.session import materialise, shared_dir
from tidemill.sources import files as R, sinks as K

CUSTOMER = "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
EVENT = "event_id LONG, user_id LONG, event_type STRING, value DOUBLE"
ORDER = "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
# Lines that one task of merged_edges joins and merges.
EDGE_ROWS_PER_TASK = 1_000_000


def database() -> str:
    """A database name of its own for each call."""
    return f"tidemill_{uuid.uuid4().hex[:12]}"


@query("S1 K1", "SELECT * FROM customer")
def customers_through_csv(t: Tables):
    return R.read_csv(t.spark, K.write_csv(t.customer, t.scratch("csv")), CUSTOMER)


@query("S2", "SELECT * FROM part")
def whole_table(t: Tables):
    return R.read_table(t.spark, t.path("part"))


@query("S3", "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000")
def query_with_parameters(t: Tables):
    sql = "SELECT c_custkey, c_acctbal FROM {customer} WHERE c_mktsegment = :segment AND c_acctbal > :least"
    return R.read_query(t.spark, sql, {"segment": "BUILDING", "least": 1000}, customer=t.customer)


@query("S4", "SELECT event_id, user_id, event_type, value FROM events")
def events_through_json(t: Tables):
    record = F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("record")
    arrays = O.ordered_array(t.events.select("event_type", record), ["event_type"], "record", max_items=100_000)
    path = t.scratch("json")
    text = F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("value")
    arrays.select(text, "event_type", "part").write.partitionBy("event_type", "part").text(path)
    return R.read_json(t.spark, path, StructType.fromDDL(EVENT)).select("event_id", "user_id", "event_type", "value")


@query("S6", "SELECT s_suppkey, s_name, s_nationkey, true AS has_file FROM supplier")
def suppliers_by_prefix(t: Tables):
    path = K.write_csv(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), t.scratch("prefix"))
    head, _, last = path.rpartition("/")
    rows = R.read_prefix(t.spark, f"{head}//{last}", "s_suppkey LONG, s_name STRING, s_nationkey INT")
    return rows.withColumn("has_file", F.col("file_path").endswith(".csv")).drop("file_path")


@query("S8 P19", "SELECT DISTINCT p_brand, p_type, p_size FROM part")
def unique_sheet_rows(t: Tables):
    path = t.scratch("sheet")
    t.part.select("p_brand", "p_type", "p_size").write.options(header=True, sep=";").csv(path)
    return P.dedup_rows(R.read_csv(t.spark, path, "p_brand STRING, p_type STRING, p_size INT", sep=";"))


@query("S9", "SELECT p_name AS value, count(*) AS n FROM part GROUP BY p_name")
def lines_of_text(t: Tables):
    path = t.scratch("lines")
    t.part.select("p_name").write.text(path)
    return A.count_by(R.read_lines(t.spark, path), ["value"])


@query("S10", """
    SELECT p_name AS product, CAST(sum(l_quantity) AS BIGINT) AS pieces, CAST(sum(round(l_extendedprice)) AS BIGINT) AS price
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name""")
def sales_from_lines(t: Tables):
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    amount, price = F.col("l_quantity").cast("int"), S.round_int("l_extendedprice")
    line = F.concat_ws(",", "p_name", F.concat(amount, F.lit(R.PIECES)), F.concat(price, F.lit(R.ROUBLES)))
    path = t.scratch("sales")
    sold.select(line).write.text(path)
    parsed = R.parse_sales_lines(R.read_lines(t.spark, path))
    return parsed.groupBy("product").agg(F.sum("quantity").alias("pieces"), F.sum("price").alias("price"))


@query("S11", """
    SELECT code, discount_percent, count(*) AS n FROM customer
    JOIN (VALUES ('SUMMER10', 10, 'BUILDING'), ('VIP40', 40, 'MACHINERY')) AS v(code, discount_percent, segment)
    ON c_mktsegment = segment GROUP BY code, discount_percent""")
def customers_of_inline_rows(t: Tables):
    values = [("SUMMER10", 10, "BUILDING"), ("VIP40", 40, "MACHINERY")]
    codes = R.rows(t.spark, values, "code string, discount_percent int, segment string")
    counts = A.count_by(t.customer, ["c_mktsegment"])
    return counts.join(codes, F.col("c_mktsegment") == F.col("segment")).select("code", "discount_percent", "n")


@query("A27", "SELECT c_mktsegment, count(*) AS n_rows FROM customer GROUP BY c_mktsegment")
def rows_by_file(t: Tables):
    path = t.scratch("files")
    t.customer.select("c_custkey", "c_mktsegment").write.partitionBy("c_mktsegment").csv(path)
    counts = R.rows_per_file(t.spark.read.schema("c_custkey LONG").csv(path))
    folder = F.regexp_extract("file_path", "c_mktsegment=([^/]*)", 1).alias("c_mktsegment")
    return counts.groupBy(folder).agg(F.sum("n_rows").alias("n_rows"))


@query("K2 K16", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def appended_orders(t: Tables):
    name = f"{database()}.orders"
    K.ensure_table(t.spark, name, ORDER)
    for status in ("F", "O", "P"):
        K.append(P.eq_filter(t.orders, "o_orderstatus", status), name)
    return t.spark.table(name)


@query("K3", "SELECT o_orderkey, o_custkey, 'done' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def replaced_orders(t: Tables):
    name = f"{database()}.orders"
    K.ensure_table(t.spark, name, ORDER)
    K.append(t.orders, name)
    finished = P.eq_filter(t.spark.table(name), "o_orderstatus", "F").withColumn("o_orderstatus", F.lit("done"))
    K.overwrite(finished, name)
    return t.spark.table(name)


@query("K4", "SELECT s_suppkey, s_name, true AS first_wrote, false AS second_wrote FROM supplier")
def written_once(t: Tables):
    path = t.scratch("once")
    rows = t.supplier.select("s_suppkey", "s_name")
    first, second = K.write_new(rows, path), K.write_new(rows.withColumn("s_name", F.lit("late")), path)
    return P.with_params(t.spark.read.parquet(path), first_wrote=first, second_wrote=second)


@query("K5", "SELECT avg(n) AS avg_orders, max(n) AS most FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)")
def inserted_from_query(t: Tables):
    name = f"{database()}.summary"
    K.ensure_table(t.spark, name, "avg_orders DOUBLE, most BIGINT")
    sql = "SELECT max(n) AS most, avg(n) AS avg_orders FROM (SELECT count(*) AS n FROM {orders} GROUP BY o_custkey)"
    K.insert_select(t.spark, sql, name, orders=t.orders)
    return t.spark.table(name)


# A target of the finished and open orders, and a later delivery of all pending and finished ones with new sums.
TARGET = "(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O'))"
LATER = """(SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + version AS o_totalprice, version
            FROM orders, (VALUES (1), (2)) AS v(version) WHERE o_orderstatus IN ('F', 'P'))"""


def target(t: Tables) -> DataFrame:
    return P.in_list(t.orders.select(*ORDER_COLUMNS), "o_orderstatus", ["F", "O"])


def later(t: Tables) -> DataFrame:
    rows = P.in_list(t.orders.select(*ORDER_COLUMNS), "o_orderstatus", ["F", "P"])
    versions = rows.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    return versions.withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + F.col("version")})


@query("K6", f"""
    SELECT * FROM {TARGET} UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {LATER}
    WHERE version = 1 AND o_orderkey NOT IN (SELECT o_orderkey FROM {TARGET})""")
def inserted_unless_known(t: Tables):
    return C.insert_ignore(target(t), later(t), ["o_orderkey"], ["version"])


@query("K7", f"""
    SELECT * FROM {TARGET} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {LATER})
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {LATER} WHERE version = 2""")
def upserted_orders(t: Tables):
    return C.upsert(target(t), later(t), ["o_orderkey"], ["version"])


@query("K7 T13", """
    SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber DESC, l_suppkey DESC,
                               l_extendedprice DESC) = 1""")
def upserted_positions(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_linenumber", "l_suppkey"
    )
    empty = rows.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice").filter(F.lit(False))
    return C.upsert(empty, rows, ["l_orderkey", "l_partkey"], ["l_linenumber", "l_suppkey", "l_extendedprice"])


@query("K7 K16", f"""
    SELECT *, CAST(o_orderkey // 1000 AS INTEGER) AS block FROM ({TARGET} UNION ALL
        SELECT o_orderkey, o_custkey, 'X', o_totalprice + 2 FROM orders WHERE o_orderstatus = 'P')""")
def upserted_blocks(t: Tables):
    name = f"{database()}.orders"
    block = F.expr("CAST(o_orderkey div 1000 AS INT)")
    K.ensure_table(t.spark, name, f"{ORDER}, block INT", partition_by=["block"])
    K.append(target(t).withColumn("block", block), name)
    new = J.not_in(later(t), target(t), ["o_orderkey"]).withColumn("block", block)
    K.upsert_table(t.spark, name, new, ["o_orderkey"], ["version"], partitions=["block"])
    return t.spark.table(name)


@query("K3", "SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey = 7")
def clustered_point_filter(t: Tables):
    name = f"{database()}.lines"
    K.ensure_table(t.spark, name, "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_suppkey BIGINT")
    K.overwrite(t.lineitem, name, cluster_by=["l_suppkey", "l_orderkey", "l_partkey"])
    return P.eq_filter(t.spark.table(name), "l_suppkey", 7)


@query("K8", """
    SELECT c_custkey, upper(c_name) AS c_name FROM customer""")
def merged_nodes(t: Tables):
    nodes = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    paid = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    incoming = paid.select("c_custkey", F.upper("c_name").alias("c_name"), "o_orderkey").unionByName(
        t.customer.select("c_custkey", F.upper("c_name").alias("c_name"), F.lit(-1).cast("long").alias("o_orderkey"))
    )
    return G.merge_nodes(nodes, incoming, "c_custkey", ["o_orderkey"])


@query("K8", "SELECT DISTINCT o_custkey AS src_id, l_partkey AS dst_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def merged_edges(t: Tables):
    # the join and the merges get tasks in proportion to the lines, whatever the session's number of shuffle partitions
    parts = max(t.spark.sparkContext.defaultParallelism, math.ceil(t.lineitem.count() / EDGE_ROWS_PER_TASK))
    lines, orders = t.lineitem.repartition(parts, "l_orderkey"), t.orders.repartition(parts, "o_orderkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    edges = joined.select(F.col("o_custkey").alias("src_id"), F.col("l_partkey").alias("dst_id"), "l_returnflag")
    first = G.merge_edges(edges.filter(F.lit(False)).drop("l_returnflag"), edges.filter("l_returnflag = 'A'"), parts)
    return G.merge_edges(first, edges.drop("l_returnflag"), parts)


UPDATES = """(SELECT o_orderkey, 'Delayed' AS o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
              UNION ALL SELECT o_orderkey + 1000000000, 'Cancelled' FROM orders WHERE o_orderpriority = '5-LOW')"""


def updates(t: Tables) -> DataFrame:
    urgent = P.eq_filter(t.orders, "o_orderpriority", "1-URGENT").select("o_orderkey", F.lit("Delayed").alias("o_orderstatus"))
    low = P.eq_filter(t.orders, "o_orderpriority", "5-LOW")
    unknown = low.select((F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"), F.lit("Cancelled").alias("o_orderstatus"))
    return urgent.unionByName(unknown).withColumn("step", F.lit(1))


@query("K9", f"""
    SELECT o.o_orderkey, coalesce(u.o_orderstatus, o.o_orderstatus) AS o_orderstatus
    FROM orders o LEFT JOIN {UPDATES} u ON u.o_orderkey = o.o_orderkey""")
def updated_statuses(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    return C.batch_update(orders, updates(t), "o_orderkey", "o_orderstatus", ["step"])[0]


@query("K9", f"""
    SELECT count(*) FILTER (WHERE o.o_orderkey IS NOT NULL) AS n_updated,
           count(*) FILTER (WHERE o.o_orderkey IS NULL) AS n_unknown
    FROM {UPDATES} u LEFT JOIN orders o ON u.o_orderkey = o.o_orderkey""")
def update_report(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    return C.update_counts(C.batch_update(orders, updates(t), "o_orderkey", "o_orderstatus", ["step"])[1])


@query("K10", "SELECT c_custkey, c_name FROM customer WHERE NOT (c_acctbal < 0 AND c_mktsegment = 'BUILDING')")
def deleted_customers(t: Tables):
    in_debt = (F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == "BUILDING")
    return C.delete_where(t.customer, in_debt).select("c_custkey", "c_name")


@query("K11", """
    SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey <> 3
    UNION ALL SELECT c_custkey, 'moved', 4 FROM customer WHERE c_nationkey = 3
    UNION ALL SELECT c_custkey + 1000000000, 'new', 3 FROM customer WHERE c_nationkey = 3""")
def replaced_customers(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey")
    moving = P.eq_filter(rows, "c_nationkey", 3)
    moved = moving.withColumns({"c_name": F.lit("moved"), "c_nationkey": F.lit(4)})
    added = moving.withColumns({"c_custkey": F.col("c_custkey") + 1_000_000_000, "c_name": F.lit("new")})
    return C.replace_by_key(rows, moved.unionByName(added), ["c_custkey"])


@query("K13 F16", """
    SELECT CAST(user_id AS VARCHAR) AS key,
           '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
    FROM events""")
def event_messages(t: Tables):
    return K.to_messages(t.events.select("event_id", "user_id", "event_type"), "user_id")


@query("K15", """
    SELECT c_name, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS amount
    FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 5000""")
def joined_with_temp_table(t: Tables):
    grown = P.greater_than(t.customer, "c_acctbal", 5000).select("c_custkey", "c_name")
    with K.temp_table(grown, f"tidemill_{uuid.uuid4().hex[:12]}") as users:
        found = users.join(t.bookings, F.col("c_custkey") == F.col("o_custkey")).select("c_name", "amount")
        result = materialise(as_double(found, "amount"), "temp-join")
    return result


@query("K16", "SELECT o_custkey AS user_id, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(10,2)))::DOUBLE AS total FROM orders GROUP BY 1")
def typed_table(t: Tables):
    name = f"{database()}.totals"
    root = f"{shared_dir(t.spark)}/tables"
    for _ in range(2):
        K.ensure_table(t.spark, name, "user_id BIGINT, n BIGINT, total DECIMAL(14,2)", root)
    sums = t.bookings.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count("*").alias("n"), F.sum("amount").alias("total")
    )
    K.append(sums, name)
    return as_double(t.spark.table(name), "total")

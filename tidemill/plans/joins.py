"""Joins, graph patterns and parameterised table functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemill.functions import tables as U
from tidemill.operators import aggregates as A, graph as G, joins as J, ordering as O, shape as P
from tidemill.plans.aggregates import AMOUNT, MONEY, as_double, routes
from tidemill.plans.registry import Tables, query
from tidemill.sources.files import extract_since
from tidemill.sources.sinks import view_orders_from


def days(n: int):
    return F.expr(f"INTERVAL {n} DAYS")


@query("J1", """
    SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def orders_with_customer(t: Tables):
    joined = J.inner(t.orders, t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@query("J2", """
    SELECT l_orderkey, l_partkey, l_linenumber, a.n_name AS to_n_name, b.n_name AS from_n_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON c_nationkey = a.n_nationkey
    JOIN nation b ON s_nationkey = b.n_nationkey WHERE l_returnflag = 'R' AND l_quantity > 40""")
def routes_of_large_returns(t: Tables):
    large = routes(t).filter((F.col("l_returnflag") == "R") & (F.col("quantity") > 40))
    named = J.join_roles(large, t.nation, {"to": "c_nationkey", "from": "s_nationkey"}, "n_nationkey", ["n_name"])
    return named.select("l_orderkey", "l_partkey", "l_linenumber", "to_n_name", "from_n_name")


@query("J3 P7", """
    SELECT l_linenumber, c_name, p_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
    WHERE c_custkey IN (17, 42, 105) AND l_linenumber < 5""")
def lines_of_chosen_customers(t: Tables):
    return J.star_join(
        t.lineitem,
        [
            (t.orders, F.col("l_orderkey") == F.col("o_orderkey")),
            (t.customer, F.col("o_custkey") == F.col("c_custkey")),
            (t.part, F.col("l_partkey") == F.col("p_partkey")),
        ],
        F.col("c_custkey").isin(17, 42, 105) & (F.col("l_linenumber") < 5),
        ["l_linenumber", "c_name", "p_name"],
    )


@query("J4", """
    SELECT c_custkey, c_mktsegment, coalesce(n_urgent, 0) AS n_urgent FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS n_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
    ON o_custkey = c_custkey""")
def urgent_orders_or_zero(t: Tables):
    urgent = P.eq_filter(t.orders, "o_orderpriority", "1-URGENT").withColumnRenamed("o_custkey", "c_custkey")
    counts = A.count_by(urgent, ["c_custkey"], "n_urgent")
    return J.left_default(t.customer.select("c_custkey", "c_mktsegment"), counts, "c_custkey", {"n_urgent": 0})


BRANDS = """(SELECT row_number() OVER (ORDER BY p_brand) AS brand_id, p_brand AS brand
             FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand <> 'Brand#1'))"""


@query("J5", f"SELECT p_partkey, p_brand, brand_id::VARCHAR AS brand_id FROM part LEFT JOIN {BRANDS} ON p_brand = brand")
def brand_keys(t: Tables):
    names = t.part.filter(F.col("p_brand") != "Brand#1").select(F.col("p_brand").alias("brand")).distinct()
    brands = O.number_rows(names, [O.asc("brand")], name="brand_id")
    brands = brands.withColumn("brand_id", F.col("brand_id").cast("string"))
    return J.lookup_key(t.part.select("p_partkey", "p_brand"), brands, "p_brand", "brand", "brand_id")


@query("J6", """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""")
def customers_without_pending(t: Tables):
    pending = P.eq_filter(t.orders, "o_orderstatus", "P").withColumnRenamed("o_custkey", "c_custkey")
    return J.not_in(t.customer.select("c_custkey", "c_name"), pending, ["c_custkey"])


@query("J7", """
    SELECT a.event_id AS a_id, b.event_id AS b_id, (epoch_us(b.ts) - epoch_us(a.ts)) / 1000000 AS gap_sec, a.user_id
    FROM events a JOIN events b ON a.user_id = b.user_id AND (a.ts, a.event_id) < (b.ts, b.event_id)
    WHERE epoch_us(b.ts) - epoch_us(a.ts) <= 3600000000""")
def events_within_an_hour(t: Tables):
    return J.band_self_join(t.events, "event_id", "ts", 3600, ["user_id"])


@query("J7", """
    SELECT a.event_id AS a_id, b.event_id AS b_id, abs(epoch_us(b.ts) - epoch_us(a.ts)) / 1000000 AS gap_sec,
           a.event_type
    FROM events a JOIN events b ON a.event_type = b.event_type AND a.event_id <> b.event_id
    WHERE abs(epoch_us(b.ts) - epoch_us(a.ts)) <= 60000000""")
def events_within_a_minute(t: Tables):
    return J.band_self_join(t.events, "event_id", "ts", 60, ["event_type"], ordered_pairs=True, max_bucket_rows=3)


@query("J8", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
           (SELECT avg(l_quantity) FROM lineitem) AS mean_quantity, (SELECT max(l_quantity) FROM lineitem) AS most
    FROM lineitem""")
def lines_with_mean(t: Tables):
    one = t.lineitem.agg(F.avg("l_quantity").alias("mean_quantity"), F.max("l_quantity").alias("most"))
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return J.with_scalar(rows, one)


@query("J9", f"""
    SELECT c_custkey, n_orders, n_items, item_sum::DOUBLE AS item_sum FROM customer
    JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) a ON a.o_custkey = c_custkey
    JOIN (SELECT o_custkey, count(*) AS n_items, sum({MONEY}) AS item_sum
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey) b ON b.o_custkey = c_custkey""")
def customer_volumes(t: Tables):
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    items = t.sales.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    joined = J.join_aggregates(t.customer.select("c_custkey"), [
        (orders, "c_custkey", {"n_orders": F.count("*")}),
        (items, "c_custkey", {"n_items": F.count("*"), "item_sum": F.sum("price")}),
    ])
    return as_double(joined, "item_sum")


@query("J10", """
    SELECT c_custkey AS a_c_custkey, c_mktsegment AS a_c_mktsegment, p_partkey AS b_p_partkey, p_type AS b_p_type,
           count(*) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4""")
def bought_pattern(t: Tables):
    bought = bought_edges(t)
    found = G.pattern(
        t.customer.select("c_custkey", "c_mktsegment"), bought, t.part.select("p_partkey", "p_type"),
        "c_custkey", "p_partkey",
    )
    return found.groupBy("a_c_custkey", "a_c_mktsegment", "b_p_partkey", "b_p_type").agg(F.count("*").alias("n"))


def bought_edges(t: Tables):
    """Customer to part, an edge for each line."""
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(F.col("o_custkey").alias("src_id"), F.col("l_partkey").alias("dst_id"))


@query("J10 A17", """
    SELECT avg(n) AS mean_buyers FROM (SELECT p_partkey, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY p_partkey)""")
def mean_buyers_per_part(t: Tables):
    found = G.pattern(t.customer, bought_edges(t), t.part, "c_custkey", "p_partkey")
    return A.mean_group_count(found, "b_p_partkey", "mean_buyers")


@query("J12", """
    SELECT o_orderkey, coalesce(n, 0) AS n_returned FROM orders LEFT JOIN
    (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def returned_items_or_zero(t: Tables):
    returned = P.eq_filter(t.lineitem, "l_returnflag", "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.count_children(t.orders.select("o_orderkey"), returned, "o_orderkey", "n_returned")


@query("J13", """
    SELECT c_custkey, c_name, c_mktsegment, n_name, o_orderkey, o_orderdate, o_totalprice
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey""")
def wide_orders(t: Tables):
    located = J.denormalise(
        t.customer, t.nation, F.col("c_nationkey") == F.col("n_nationkey"),
        ["c_custkey", "c_name", "c_mktsegment", "n_name"],
    )
    return J.denormalise(
        located, t.orders, F.col("o_custkey") == F.col("c_custkey"),
        ["c_custkey", "c_name", "c_mktsegment", "n_name", "o_orderkey", "o_orderdate", "o_totalprice"],
    )


@query("J14", """
    SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderdate >= TIMESTAMP '1996-01-01')""")
def lines_without_order(t: Tables):
    kept = t.orders.filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    lost = J.orphans(t.lineitem, kept, ["l_orderkey"], ["o_orderkey"])
    return lost.select("l_orderkey", "l_partkey", "l_linenumber")


@query("S7", """
    SELECT o_orderkey AS transaction_id, o_totalprice AS amount, c_custkey AS customer_id, c_name AS customer_name
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def graph_extract(t: Tables):
    made = t.orders.select(F.col("o_custkey").alias("src_id"), F.col("o_orderkey").alias("dst_id"))
    return G.graph_rows(
        t.customer, made, t.orders, "c_custkey", "o_orderkey",
        {"c_custkey": "customer_id", "c_name": "customer_name"},
        {"o_orderkey": "transaction_id", "o_totalprice": "amount"},
    )


@query("S14 F11", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 5 MINUTES")
def recent_events(t: Tables):
    since = F.expr("TIMESTAMP_NTZ '2024-01-20 12:00:00' - INTERVAL 5 MINUTES")
    return extract_since(t.events.select("event_id", "ts"), "ts", since)


TRIPS = """(SELECT l_orderkey AS trip_id, l_suppkey AS place, o_orderdate AS planned_start, l_shipdate AS actual_start,
                   o_orderdate + INTERVAL 14 DAY AS planned_end, l_shipdate + INTERVAL 3 DAY AS actual_end
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
DELAYS = f"""
    SELECT trip_id, CAST(abs(epoch_us(planned_start) - epoch_us(actual_start)) // 1000000 AS BIGINT) AS departure_delay_sec,
           CAST(abs(epoch_us(planned_end) - epoch_us(actual_end)) // 1000000 AS BIGINT) AS arrival_delay_sec
    FROM {TRIPS} WHERE place = 7"""


def fresh(name: str) -> str:
    """A name that no view or function of the session has."""
    return f"tidemill_{name}_{uuid.uuid4().hex[:12]}"


def trips(t: Tables):
    """Shipments as trips: planned from the order date, actual from the ship date."""
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("l_orderkey").alias("trip_id"), F.col("l_suppkey").alias("place"),
        F.col("o_orderdate").alias("planned_start"), F.col("l_shipdate").alias("actual_start"),
        (F.col("o_orderdate") + days(14)).alias("planned_end"), (F.col("l_shipdate") + days(3)).alias("actual_end"),
    )


@query("U1", DELAYS)
def delay_statistics(t: Tables):
    return U.delay_statistics(
        trips(t), "trip_id", "place", 7, "planned_start", "actual_start", "planned_end", "actual_end"
    )


def delay_function(t: Tables) -> str:
    """Registers the function under a name of its own, as its view; both go with the session."""
    view, name = fresh("trips"), fresh("trip_delays")
    trips(t).createOrReplaceTempView(view)
    U.create_delay_function(
        t.spark, name, code_type="BIGINT", id="trip_id", trips=view, place="place",
        planned_start="planned_start", actual_start="actual_start", planned_end="planned_end", actual_end="actual_end",
    )
    return name


@query("U1", DELAYS)
def delay_statistics_by_name(t: Tables):
    return t.spark.sql(f"SELECT * FROM {delay_function(t)}(7)")


@query("U1", f"""
    SELECT s_suppkey AS code, trip_id, CAST(abs(epoch_us(planned_start) - epoch_us(actual_start)) // 1000000 AS BIGINT) AS departure_delay_sec,
           CAST(abs(epoch_us(planned_end) - epoch_us(actual_end)) // 1000000 AS BIGINT) AS arrival_delay_sec
    FROM {TRIPS} JOIN supplier ON place = s_suppkey WHERE s_nationkey = 3""")
def delays_of_many_places(t: Tables):
    codes = t.supplier.filter("s_nationkey = 3").select(F.col("s_suppkey").alias("code"))
    return U.for_each(codes, delay_function(t), "code")


@query("U2", """
    WITH sold AS (SELECT o_orderkey, o_orderpriority, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
    mean AS (SELECT CAST(round(avg(n)) AS BIGINT) AS m FROM sold),
    a(code, least) AS (VALUES ('1-URGENT', 50), ('5-LOW', 120), ('5-LOW', 100), ('none', 0))
    SELECT code, CAST(least AS BIGINT) AS least, o_orderkey AS trip_id, n * 100 // m AS fill_percentage
    FROM a JOIN sold ON o_orderpriority = code, mean WHERE n * 100 // m >= least""")
def fill_of_many_places(t: Tables):
    tickets = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    view, name = fresh("shares"), fresh("fill_percentage")
    U.fill_shares(t.orders, tickets, "o_orderkey", ["o_orderpriority"]).createOrReplaceTempView(view)
    U.create_fill_function(t.spark, name, code_type="STRING", id="o_orderkey", place="o_orderpriority", shares=view)
    arguments = t.spark.createDataFrame([("1-URGENT", 50), ("5-LOW", 120), ("5-LOW", 100), ("none", 0)], "code STRING, least BIGINT")
    return U.for_each(arguments, name, "code", "least")


@query("U2 J8 Q1 F14", """
    WITH sold AS (SELECT o_orderkey, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey),
    mean AS (SELECT CAST(round(avg(n)) AS BIGINT) AS m FROM sold)
    SELECT o_orderkey, n * 100 // m AS fill_percentage FROM sold, mean WHERE n * 100 // m >= 50""")
def fill_percentage(t: Tables):
    tickets = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return U.fill_percentage(t.orders, tickets, "o_orderkey", 50)


@query("U3 P16 A26", f"""
    SELECT 'NATION_3' AS city_departure, 'NATION_8' AS city_arrival, o_orderkey, o_orderdate, l_shipdate, p_type,
           sum({MONEY})::DOUBLE / count(*) AS avg_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
    JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON s_nationkey = b.n_nationkey
    WHERE a.n_name = 'NATION_3' AND b.n_name = 'NATION_8' GROUP BY o_orderkey, o_orderdate, l_shipdate, p_type""")
def route_timetable(t: Tables):
    parts = t.part.select("p_partkey", "p_type")
    priced = routes(t).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    cities = t.nation.withColumnRenamed("n_name", "city")
    named = J.join_roles(priced, cities, {"from": "c_nationkey", "to": "s_nationkey"}, "n_nationkey", ["city"])
    path = t.scratch("timetable")
    columns = ["o_orderkey", "o_orderdate", "l_shipdate", "p_type"]
    return U.export_route(named, "NATION_3", "NATION_8", columns, "price", path)


@query("K14", f"""
    SELECT o_orderkey, n_name, {AMOUNT}::DOUBLE AS amount FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_5'""")
def view_of_one_nation(t: Tables):
    located = t.bookings.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    on = F.col("c_nationkey") == F.col("n_nationkey")
    view = view_orders_from(
        located, t.nation, on, F.col("n_name") == "NATION_5", ["o_orderkey", "n_name", "amount"], fresh("orders_from_nation")
    )
    return as_double(view, "amount")

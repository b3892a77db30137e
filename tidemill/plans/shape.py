"""Filters, projections, bins and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import scalar as S
from tidemill.operators import aggregates as A, ordering as O, shape as P
from tidemill.plans.registry import Tables, query


@query("P1 F3", "SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name FROM customer")
def full_name(t: Tables):
    return P.full_name(t.customer, "c_name", "c_mktsegment").select("c_custkey", "full_name")


@query("P2 F2", """
    SELECT p_partkey, p_name, p_size FROM part
    WHERE starts_with(p_name, 'blue') AND p_type = 'ECONOMY'""")
def prefix_filter(t: Tables):
    return P.prefix_filter(t.part, "p_name", "blue", p_type="ECONOMY").select("p_partkey", "p_name", "p_size")


@query("P3 F13", """
    SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 2 = 0""")
def even_ids(t: Tables):
    return P.modulo_filter(t.customer, "c_custkey", 2, 0, c_mktsegment="BUILDING").select("c_custkey", "c_name")


@query("P4", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def finished_orders(t: Tables):
    return P.eq_filter(t.orders, "o_orderstatus", "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query("P5", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'")
def orders_before(t: Tables):
    return P.before(t.orders, "o_orderdate", "1996-01-01").select("o_orderkey", "o_orderdate")


@query("P6", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 1000")
def balance_above(t: Tables):
    return P.greater_than(t.customer, "c_acctbal", 1000).select("c_custkey", "c_acctbal")


@query("P7", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
    WHERE l_suppkey IN (3, 7, 9) AND l_linenumber < 4""")
def chosen_suppliers(t: Tables):
    found = P.in_list(t.lineitem, "l_suppkey", [3, 7, 9], {"l_linenumber": 4})
    return found.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


_LARGE = "(SELECT o_custkey, o_orderkey FROM orders WHERE o_totalprice > 400000)"


@query("P8", f"""
    SELECT c_custkey, c_name FROM customer LEFT JOIN {_LARGE} ON o_custkey = c_custkey WHERE o_orderkey IS NULL""")
def without_large_order(t: Tables):
    large = P.greater_than(t.orders, "o_totalprice", 400000).select("o_custkey", "o_orderkey")
    joined = t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left")
    return P.missing(joined, "o_orderkey").select("c_custkey", "c_name")


@query("P8", f"""
    SELECT c_custkey, o_orderkey FROM customer LEFT JOIN {_LARGE} ON o_custkey = c_custkey
    WHERE o_orderkey IS NOT NULL""")
def with_large_order(t: Tables):
    large = P.greater_than(t.orders, "o_totalprice", 400000).select("o_custkey", "o_orderkey")
    joined = t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left")
    return P.present(joined, "o_orderkey").select("c_custkey", "o_orderkey")


@query("P9 O1", """
    SELECT c_custkey, c_acctbal FROM customer
    WHERE c_acctbal > 1000 AND c_acctbal < 5000 AND c_mktsegment = 'BUILDING' ORDER BY c_acctbal""")
def document_match(t: Tables):
    spec = {"$and": [{"c_acctbal": {"$gt": 1000}}, {"c_acctbal": {"$lt": 5000}}], "c_mktsegment": "BUILDING"}
    return O.sort_by(P.match(t.customer, spec), "c_acctbal").select("c_custkey", "c_acctbal")


@query("P10", "SELECT c_name AS name, c_mktsegment AS segment FROM customer WHERE c_nationkey = 7")
def document_project(t: Tables):
    users = t.customer.select(
        F.col("c_custkey").alias("_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("country"),
    )
    return P.project(P.match(users, {"country": 7}), ["_id", "name", "segment"])


DISCOUNTS = [(None, 2, "<2"), (2, 4, "2-4"), (5, 6, "5-6"), (7, 8, "7-8"), (8, None, ">8")]
DISCOUNT_CASE = """
    CASE WHEN pct < 2 THEN '<2' WHEN pct BETWEEN 2 AND 4 THEN '2-4' WHEN pct BETWEEN 5 AND 6 THEN '5-6'
         WHEN pct BETWEEN 7 AND 8 THEN '7-8' WHEN pct > 8 THEN '>8' END"""
DISCOUNT_PCT = "(SELECT *, CAST(round(l_discount * 100) AS BIGINT) AS pct FROM lineitem)"


def discounts(t: Tables):
    return t.lineitem.withColumn("pct", S.round_int(F.col("l_discount") * 100))


@query("P11", f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, pct, {DISCOUNT_CASE} AS bucket FROM {DISCOUNT_PCT}""")
def discount_buckets(t: Tables):
    found = P.case_buckets(discounts(t), "pct", DISCOUNTS)
    return found.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "pct", "bucket")


VALID = """(SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS valid_from,
                   strftime(o_orderdate + INTERVAL 90 DAY, '%Y-%m-%d') AS valid_to FROM orders)"""


def valid_orders(t: Tables):
    return t.bookings.withColumns({
        "valid_from": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "valid_to": F.date_format(F.expr("o_orderdate + INTERVAL 90 DAYS"), "yyyy-MM-dd"),
    })


@query("P12 F11", f"""
    SELECT o_orderkey, valid_from, valid_to,
           CASE WHEN DATE '1998-06-15' BETWEEN valid_from::DATE AND valid_to::DATE THEN 'active'
                WHEN DATE '1998-06-15' > valid_to::DATE THEN 'expired'
                WHEN DATE '1998-06-15' < valid_from::DATE THEN 'not started' END AS state,
           CASE WHEN '1998-06-15 10:00:00' BETWEEN valid_from AND valid_to THEN 'active'
                WHEN '1998-06-15 10:00:00' > valid_to THEN 'expired'
                WHEN '1998-06-15 10:00:00' < valid_from THEN 'not started' END AS text_state
    FROM {VALID}""")
def validity(t: Tables):
    as_dates = P.validity_state(valid_orders(t), "valid_from", "valid_to", "1998-06-15 10:00:00")
    both = P.validity_state(
        as_dates, "valid_from", "valid_to", "1998-06-15 10:00:00", name="text_state", text_compare=True
    )
    return both.select("o_orderkey", "valid_from", "valid_to", "state", "text_state")


SIZE_EDGES, SIZE_LABELS = [1, 10, 25, 40, 60], ["1-10", "11-25", "26-40", "41+"]
SIZE_CASE = """
    CASE WHEN p_size > 1 AND p_size <= 10 THEN '1-10' WHEN p_size > 10 AND p_size <= 25 THEN '11-25'
         WHEN p_size > 25 AND p_size <= 40 THEN '26-40' WHEN p_size > 40 AND p_size <= 60 THEN '41+' END"""


@query("P13", f"""
    SELECT p_partkey, p_size, {SIZE_CASE} AS bin,
           CASE WHEN p_size = 1 THEN '1-10' ELSE {SIZE_CASE} END AS bin_with_lowest FROM part""")
def size_bins(t: Tables):
    open_low = P.bin_column(t.part, "p_size", SIZE_EDGES, SIZE_LABELS)
    both = P.bin_column(open_low, "p_size", SIZE_EDGES, SIZE_LABELS, True, "bin_with_lowest")
    return both.select("p_partkey", "p_size", "bin", "bin_with_lowest")


@query("P14", """
    SELECT c_mktsegment, count(*) AS n, true AS in_range, true AS varies FROM customer GROUP BY c_mktsegment""")
def random_ages(t: Tables):
    aged = P.random_int(t.customer, "age", 18, 65, seed=42)
    return aged.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"),
        F.every(F.col("age").between(18, 65)).alias("in_range"),
        (F.min("age") < F.max("age")).alias("varies"),
    )


@query("P15", "SELECT s_name AS name, s_suppkey AS id, s_nationkey FROM supplier")
def reshaped_suppliers(t: Tables):
    return P.reshape(
        t.supplier, ["s_acctbal"], {"s_name": "name", "s_suppkey": "id"}, ["name", "id", "s_nationkey"]
    )


@query("P16", """
    SELECT 'NATION_1' AS city_from, 30 AS days, c_custkey, c_nationkey FROM customer""")
def parameter_columns(t: Tables):
    return P.with_params(t.customer.select("c_custkey", "c_nationkey"), city_from="NATION_1", days=30)


@query("P17 J1", """
    SELECT o_orderkey, c_acctbal, o_totalprice, c_acctbal * 30.0::DOUBLE AS threshold, use_abs
    FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES (false), (true)) AS v(use_abs)
    WHERE (CASE WHEN use_abs THEN abs(-o_totalprice) ELSE -o_totalprice END) > c_acctbal * 30.0::DOUBLE""")
def suspicious_amounts(t: Tables):
    spent = t.orders.withColumn("spent", -F.col("o_totalprice"))
    joined = t.customer.join(spent, F.col("o_custkey") == F.col("c_custkey"))
    signed = P.over_threshold(joined, "spent", "c_acctbal", 3000).withColumn("use_abs", F.lit(False))
    sized = P.over_threshold(joined, "spent", "c_acctbal", 3000, True).withColumn("use_abs", F.lit(True))
    return signed.unionByName(sized).select("o_orderkey", "c_acctbal", "o_totalprice", "threshold", "use_abs")


@query("P18 F15", """
    SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END, 0) AS amount,
           TIMESTAMP '2024-02-01 12:00:00' AS load_ts FROM orders""")
def stamped_orders(t: Tables):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    rows = t.orders.select("o_orderkey", known.alias("amount"))
    return P.stamp(rows, F.expr("TIMESTAMP_NTZ '2024-02-01 12:00:00'"), {"amount": 0.0})


@query("P19", """
    SELECT md5(text) AS text_hash, lang, source FROM (SELECT DISTINCT text, lang, source FROM documents)""")
def distinct_documents(t: Tables):
    once = P.dedup_rows(t.documents.select("text", "lang", "source"), wide=True)
    return once.select(F.md5("text").alias("text_hash"), "lang", "source")


@query("P20", """
    SELECT o_custkey, o_orderkey, o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def first_order(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return P.dedup_keys(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("P21", "SELECT DISTINCT source FROM documents")
def distinct_sources(t: Tables):
    return P.distinct_values(t.documents, "source")


@query("P22", """
    SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
           count(*) FILTER (WHERE event_type = 'error') AS errors
    FROM events GROUP BY user_id HAVING purchases > 0 AND errors > 0""")
def non_zero_users(t: Tables):
    counted = t.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
    )
    return P.non_zero(counted, ["purchases", "errors"])


@query("F1 F3", """
    SELECT c_custkey, lower(c_mktsegment) || '.com' AS domain, split_part(c_name, '#', 2) AS number FROM customer""")
def email_domains(t: Tables):
    address = F.concat(F.lower("c_name"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".com"))
    found = P.email_domain(t.customer.withColumn("email", address), "email")
    return found.select("c_custkey", "domain", S.part_after("c_name", "#").alias("number"))


@query("F4", """
    SELECT source, count(*) FILTER (WHERE length(trim(text)) = 0) AS n_blank,
           count(*) FILTER (WHERE length(text) > 2000) AS n_long
    FROM documents GROUP BY source""")
def text_lengths(t: Tables):
    return t.documents.groupBy("source").agg(
        F.count_if(S.blank("text")).alias("n_blank"), F.count_if(S.too_long("text", 2000)).alias("n_long")
    )


@query("F5 F6 F8 F12", """
    SELECT event_id, epoch_us(ts) / 1000000 AS epoch, date_trunc('month', ts)::TIMESTAMP AS month,
           lower(dayname(ts)) AS weekday, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events""")
def time_parts(t: Tables):
    return t.events.select(
        "event_id", S.epoch_seconds("ts").alias("epoch"),
        S.month_start("ts").cast("timestamp_ntz").alias("month"),
        S.weekday_name("ts").alias("weekday"), S.stamp_text("ts").alias("stamp"),
    )


@query("F7", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000 AS seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def shipping_seconds(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        S.seconds_between("o_orderdate", "l_shipdate").alias("seconds"),
    )


@query("F9 F10", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END::TIMESTAMP AS loose,
           date_trunc('second', ts)::TIMESTAMP AS strict FROM events""")
def parsed_times(t: Tables):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    rows = t.events.select(
        "event_id", text.alias("good"), F.when(F.col("event_type") == "error", "n/a").otherwise(text).alias("mixed")
    )
    return rows.select(
        "event_id", S.parse_or_null("mixed").cast("timestamp_ntz").alias("loose"),
        S.parse_or_fail("good").cast("timestamp_ntz").alias("strict"),
    )


@query("F13 F14", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, abs(l_discount - l_tax) AS gap,
           CAST(round(l_extendedprice) AS BIGINT) AS rounded, CAST(l_quantity AS BIGINT) * 100 // 7 AS sevenths,
           CAST(l_extendedprice AS DECIMAL(18,2))::DOUBLE AS amount, l_orderkey % 7 AS remainder
    FROM lineitem""")
def rounding(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.abs(F.col("l_discount") - F.col("l_tax")).alias("gap"),
        S.round_int("l_extendedprice").alias("rounded"),
        S.whole_div(F.col("l_quantity").cast("long") * 100, F.lit(7)).alias("sevenths"),
        S.money("l_extendedprice").cast("double").alias("amount"), (F.col("l_orderkey") % 7).alias("remainder"),
    )


@query("F16", """
    SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, replace(props, ' ', '') AS again
    FROM events""")
def json_fields(t: Tables):
    record = F.from_json("props", "k INT")
    return t.events.select("event_id", record["k"].alias("k"), F.to_json(record).alias("again"))


@query("F18", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS p_name FROM part")
def one_value_per_cell(t: Tables):
    return P.explode_cell(t.part.select("p_partkey", "p_name"), "p_name", " ")


@query("A3 P13", f"""
    SELECT bin, avg(p_size) AS mean FROM (SELECT *, {SIZE_CASE} AS bin FROM part) GROUP BY bin""")
def mean_size_by_bin(t: Tables):
    return A.mean_by(P.bin_column(t.part, "p_size", SIZE_EDGES, SIZE_LABELS), "p_size", "bin")


@query("A1 P13", f"""
    SELECT bin_no, label AS bin, count(p_size) AS n
    FROM (VALUES (0, '1-10'), (1, '11-25'), (2, '26-40'), (3, '41+'), (4, '60+')) AS b(bin_no, label)
    LEFT JOIN (SELECT *, {SIZE_CASE} AS bin FROM part) ON bin = label GROUP BY bin_no, label""")
def sizes_with_empty_bins(t: Tables):
    counts = A.value_counts(P.bin_column(t.part, "p_size", SIZE_EDGES, SIZE_LABELS), ["bin"])
    return A.with_empty_bins(counts, [*SIZE_LABELS, "60+"], "bin", {"n": 0})

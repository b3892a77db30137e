"""Data-quality rules and modelling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemill.operators import modelling as M, ordering as O, quality as V, shape as P
from tidemill.plans.registry import Tables, query


@query("V1", "SELECT count(*) AS n FROM lineitem")
def not_empty(t: Tables):
    V.check_not_empty(t.lineitem)
    return t.lineitem.agg(F.count("*").alias("n"))


@query("V2", """
    SELECT md5(text) AS text_hash, lang, source, count(*) AS copies FROM documents
    GROUP BY text, lang, source HAVING count(*) > 1""")
def repeated_documents(t: Tables):
    found = V.check_duplicates(t.documents.select("text", "lang", "source"), wide=True)
    return found.select(F.md5("text").alias("text_hash"), "lang", "source", "copies")


@query("V3", """
    SELECT count(*) FILTER (WHERE doc_id IS NULL) AS doc_id, count(*) FILTER (WHERE quality IS NULL) AS quality,
           count(*) FILTER (WHERE toxic IS NULL) AS toxic
    FROM (SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))""")
def null_counts(t: Tables):
    return V.check_nulls(t.documents.select("doc_id").join(t.labels, "doc_id", "left"))


def items(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        (F.col("l_quantity") - 1).cast("int").alias("quantity"), F.col("l_extendedprice").alias("price"),
    )


ITEMS = "(SELECT l_orderkey, l_partkey, l_quantity - 1 AS quantity, l_extendedprice FROM lineitem)"


@query("V4 V7", f"""
    SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(quantity AS INTEGER) AS quantity,
           concat_ws('; ', CASE WHEN l_orderkey <= 0 THEN 'order_id must be a whole number above 0' END,
                     CASE WHEN l_partkey <= 0 THEN 'product_id must be a whole number above 0' END,
                     CASE WHEN quantity <= 0 THEN 'quantity must be a whole number above 0' END) AS errors
    FROM {ITEMS} WHERE l_orderkey <= 0 OR l_partkey <= 0 OR quantity <= 0""")
def failing_items(t: Tables):
    found = V.validate(items(t), V.rules_for("order_items"))
    return found.select("order_id", "product_id", "quantity", F.array_join("errors", "; ").alias("errors"))


@query("V4", f"""
    SELECT message, count(*) AS n_rows FROM (
        SELECT unnest([CASE WHEN l_orderkey <= 0 THEN 'order_id must be a whole number above 0' END,
                       CASE WHEN l_partkey <= 0 THEN 'product_id must be a whole number above 0' END,
                       CASE WHEN quantity <= 0 THEN 'quantity must be a whole number above 0' END]) AS message FROM {ITEMS})
    WHERE message IS NOT NULL GROUP BY message""")
def failures_by_rule(t: Tables):
    return V.error_counts(items(t), V.rules_for("order_items"))


@query("V5 F4", """
    SELECT c_custkey, length(c_name) <= 18 AND c_mktsegment <> 'BUILDING' AND c_acctbal > 0 AS good FROM customer""")
def valid_customers(t: Tables):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    rows = t.customer.withColumn("c_mktsegment", segment)
    rules = [V.max_length("c_name", 18), V.required("c_mktsegment"), V.positive_number("c_acctbal")]
    good, bad = V.split_valid(rows, rules)
    good = good.select("c_custkey", F.lit(True).alias("good"))
    return good.unionByName(bad.select("c_custkey", F.lit(False).alias("good")))


@query("V6", """
    SELECT 'o_totalprice must be from 0 to 400000' AS rule, count(*) FILTER (WHERE o_totalprice NOT BETWEEN 0 AND 400000) AS n_broken FROM orders
    UNION ALL SELECT 'o_orderstatus must be one of F, O', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
    UNION ALL SELECT 'o_custkey is required', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
    UNION ALL SELECT 'o_orderkey must be unique', count(o_orderkey) - count(DISTINCT o_orderkey) FROM orders
    UNION ALL SELECT 'o_custkey, o_orderpriority must be unique',
                     count(*) - count(DISTINCT (o_custkey, o_orderpriority)) FROM orders""")
def order_constraints(t: Tables):
    checks = [
        V.between("o_totalprice", 0, 400000), V.one_of("o_orderstatus", ["F", "O"]), V.required("o_custkey")
    ]
    return V.check_constraints(t.orders, checks, [["o_orderkey"], ["o_custkey", "o_orderpriority"]])


# The known products: names of the smallest parts, numbered by name.
KNOWN = """(SELECT row_number() OVER (ORDER BY product_name) AS product_id, product_name
            FROM (SELECT DISTINCT p_name AS product_name FROM part WHERE p_size <= 2))"""
ALL_PRODUCTS = f"""(SELECT * FROM {KNOWN} UNION ALL
    SELECT row_number() OVER (ORDER BY product_name) + (SELECT max(product_id) FROM {KNOWN}), product_name
    FROM (SELECT DISTINCT p_name AS product_name FROM part JOIN lineitem ON l_partkey = p_partkey
          WHERE p_name NOT IN (SELECT product_name FROM {KNOWN})))"""


def products(t: Tables) -> M.Dimension:
    names = P.distinct_values(t.part.filter("p_size <= 2").withColumnRenamed("p_name", "product_name"), "product_name")
    known = O.number_rows(names, [O.asc("product_name")], name="product_id")
    return M.Dimension(known.select("product_id", "product_name"), {"p_name": "product_name"}, "product_id")


@query("V8 J5", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, product_id FROM lineitem JOIN part ON l_partkey = p_partkey
    LEFT JOIN {ALL_PRODUCTS} ON product_name = p_name""")
def normalised_lines(t: Tables):
    raw = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "product_id"]
    return M.normalise(raw, {"products": products(t)}, columns)[1]


@query("V8 J6", f"SELECT product_id, product_name FROM {ALL_PRODUCTS}")
def extended_products(t: Tables):
    raw = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return M.members(raw, products(t))


@query("V9", """
    SELECT 'users' AS entity, count(*) AS n FROM (SELECT DISTINCT c_custkey, c_name FROM customer JOIN orders ON o_custkey = c_custkey)
    UNION ALL SELECT 'cards', count(*) FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)""")
def split_users_and_cards(t: Tables):
    raw = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    parts = M.split_entities(raw, {"users": ["c_custkey", "c_name"], "cards": ["o_custkey", "o_orderpriority"]})
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("entity"), "n") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, counts)


@query("V10", """
    WITH raw AS (
        SELECT l_orderkey, l_partkey, l_linenumber, p_brand, s_name, s.n_name AS warehouse, s_acctbal::VARCHAR AS phone
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation s ON s_nationkey = s.n_nationkey),
    companies AS (SELECT row_number() OVER (ORDER BY p_brand) AS company_id, p_brand FROM (SELECT DISTINCT p_brand FROM raw)),
    couriers AS (SELECT row_number() OVER (ORDER BY s_name) AS courier_id, s_name FROM (SELECT DISTINCT s_name FROM raw)),
    warehouses AS (SELECT row_number() OVER (ORDER BY warehouse) AS warehouse_id, warehouse FROM (SELECT DISTINCT warehouse FROM raw))
    SELECT l_orderkey, l_partkey, l_linenumber, company_id, courier_id, warehouse_id
    FROM raw JOIN companies USING (p_brand) JOIN couriers USING (s_name) JOIN warehouses USING (warehouse)""")
def normalised_deliveries(t: Tables):
    raw = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation.withColumnRenamed("n_name", "warehouse"), F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn("phone", F.col("s_acctbal").cast("string"))
    )

    def empty(ddl: str) -> DataFrame:
        return t.spark.createDataFrame([], ddl)

    dims = {
        "companies": M.Dimension(empty("company_id long, name string"), {"p_brand": "name"}, "company_id"),
        "couriers": M.Dimension(
            empty("courier_id long, courier string, phone_no string"), {"s_name": "courier", "phone": "phone_no"}, "courier_id"
        ),
        "warehouses": M.Dimension(empty("warehouse_id long, place string"), {"warehouse": "place"}, "warehouse_id"),
    }
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "company_id", "courier_id", "warehouse_id"]
    return M.normalise(raw, dims, columns)[1]


@query("V11 J13", """
    SELECT c_custkey, c_name, c_nationkey, n_name, n_regionkey, r_name, true AS kept
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def decomposed_and_joined(t: Tables):
    wide = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", "c_nationkey", "n_name", "n_regionkey", "r_name")
    )
    rest, nations = M.decompose(wide, {"nations": (["c_nationkey"], ["n_name", "n_regionkey", "r_name"])})
    narrow, regions = M.decompose(nations["nations"], {"regions": (["n_regionkey"], ["r_name"])})
    kept = F.lit(rest.columns == ["c_custkey", "c_name", "c_nationkey"]).alias("kept")
    return rest.join(narrow, "c_nationkey").join(regions["regions"], "n_regionkey").select(*wide.columns, kept)


@query("V12", """
    SELECT p_name, count(*) AS n_values FROM (SELECT DISTINCT p_name, p_brand FROM part)
    GROUP BY p_name HAVING count(*) > 1""")
def broken_dependency(t: Tables):
    return M.check_fd(t.part, ["p_name"], ["p_brand"])

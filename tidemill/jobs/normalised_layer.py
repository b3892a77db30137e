"""The normalised layer: raw users, orders and deliveries to entities, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemill.operators.changes import new_rows
from tidemill.operators.modelling import Dimension, new_members, split_entities, with_key
from tidemill.operators.quality import rules_for, split_valid
from tidemill.sources.sinks import append, ensure_table, fitted, overwrite, table_id
from tidemill.streaming.files import ingest_checked_files, stored_schema
from tidemill.streaming.messages import MAX_FILES

# Table columns, in the order in which references allow them to be made.
TABLES = {
    "users": "user_id STRING, name STRING, surname STRING, age INT, email STRING, phone STRING",
    "products": "product_id BIGINT, product_name STRING",
    "delivery_companies": "company_id BIGINT, company_name STRING",
    "couriers": "courier_id BIGINT, courier_name STRING, courier_phone STRING",
    "warehouses": "warehouse_id BIGINT, warehouse STRING, address STRING",
    "orders": (
        "order_id INT, quantity INT, price_per_unit DECIMAL(10,2), total_price DECIMAL(10,2), "
        "card_number STRING, user_id STRING, product_id BIGINT"
    ),
    "deliveries": (
        "delivery_id STRING, order_id INT, product_id BIGINT, company_id BIGINT, cost DECIMAL(10,2), "
        "courier_id BIGINT, start_time DATE, end_time DATE, city STRING, warehouse_id BIGINT"
    ),
    "cards": "card_number STRING, user_id STRING",
}
# Raw rows that break a rule, of the latest run, as read and with what is wrong.
REJECTS = {
    "rejected_users": "user_id STRING, name STRING, surname STRING, age STRING, email STRING, phone STRING, errors STRING",
    "rejected_cards": "card_number STRING, user_id STRING, errors STRING",
}


# Raw files: columns and name patterns.
RAW = {
    "users": (
        "user_id STRING, name STRING, surname STRING, age INT, email STRING, phone STRING, card_number STRING",
        "users_*.csv",
    ),
    "orders": (
        "order_id INT, product STRING, quantity INT, price_per_unit DECIMAL(10,2), total_price DECIMAL(10,2), "
        "card_number STRING, user_id STRING",
        "orders_*.csv",
    ),
    "deliveries": (
        "delivery_id STRING, order_id INT, product STRING, company STRING, cost DECIMAL(10,2), courier_name STRING, "
        "courier_phone STRING, start_time DATE, end_time DATE, city STRING, warehouse STRING, address STRING",
        "deliveries_*.csv",
    ),
}


def land_files(spark: SparkSession, src: str | dict[str, str], root: str, archive: str | None = None) -> None:
    """Takes new raw files from ``src``, each once, to ``root/raw``; lines that do not fit the columns, and files
    with another header, to ``root/rejects``, without stopping the others.

    ``src`` is one folder whose file names tell the kind, or a folder for each kind. Files that were
    read move to ``archive`` when it is given.
    """
    running = []
    for name, (ddl, pattern) in RAW.items():
        folder, glob = (src, pattern) if isinstance(src, str) else (src[name], "*.csv")
        running.append(ingest_checked_files(
            spark, folder, f"{root}/raw/{name}", f"{root}/rejects/{name}", StructType.fromDDL(ddl), [], glob=glob,
            archive=archive, whole_file=False, unique_rows=False, reject_empty=False, required=False,
        ))
    for query in running:
        query.awaitTermination()


def run_files(
    spark: SparkSession, src: str | dict[str, str], root: str, database: str, archive: str | None = None
) -> DataFrame:
    """Lands new files and extends the layer by the raw rows it has not seen; returns the orders table.

    Each kind follows its raw folder as a stream, so many files at a time, whatever has landed before. What is known
    already is not added, so a batch that was cut off can be repeated. A layer made anew begins with the first rows.
    """
    land_files(spark, src, root, archive)
    ensure_tables(spark, root, database)
    steps = {
        "users": lambda own, rows: load_users(own, rows, database, root, replace_rejects=False),
        "orders": lambda own, rows: load_orders(own, rows, database),
        "deliveries": lambda own, rows: load_deliveries(own, rows, database),
    }
    for name, load in steps.items():
        def put(batch: DataFrame, _: int, load=load, columns=StructType.fromDDL(RAW[name][0]).fieldNames()) -> None:
            if not batch.isEmpty():
                load(batch.sparkSession, batch.select(*columns))

        raw = spark.readStream.schema(stored_schema(StructType.fromDDL(RAW[name][0]))).option("maxFilesPerTrigger", MAX_FILES)
        writer = raw.parquet(f"{root}/raw/{name}").writeStream.foreachBatch(put)
        seen = f"{root}/layer_checkpoints/{name}-{table_id(spark, f'{database}.{name}')}"
        writer.option("checkpointLocation", seen).trigger(availableNow=True).start().awaitTermination()
    for name in TABLES | REJECTS:  # micro-batches have a session of their own, which alone knows of the new files
        spark.catalog.refreshTable(f"{database}.{name}")
    return spark.table(f"{database}.orders")


def ensure_tables(spark: SparkSession, root: str, database: str) -> None:
    for name, schema in (TABLES | REJECTS).items():
        ensure_table(spark, f"{database}.{name}", schema, root)


def load_users(
    spark: SparkSession, raw: DataFrame, database: str, root: str | None = None, replace_rejects: bool = True
) -> None:
    """Valid users and cards not known yet; the rows that failed replace the tables of rejects, or are added to
    them where ``raw`` holds new rows only."""
    user_columns = ["user_id", "name", "surname", "age", "email", "phone"]
    parts = split_entities(raw, {"users": user_columns, "cards": ["card_number", "user_id"]})
    users, bad = split_valid(parts["users"], rules_for("users"))
    cards, bad_cards = split_valid(parts["cards"], rules_for("cards"))
    for name, rows, key in (("users", users, "user_id"), ("cards", cards, "card_number")):
        table = f"{database}.{name}"
        append(new_rows(spark.table(table), fitted(rows, table), [key]), table)
    for name, rows in (("rejected_users", bad), ("rejected_cards", bad_cards)):
        table, noted = f"{database}.{name}", rows.withColumn("errors", F.array_join("errors", "; "))
        if replace_rejects:
            overwrite(noted, table, root)
        else:
            append(new_rows(spark.table(table), fitted(noted, table), noted.columns), table)


def add_members(spark: SparkSession, raw: DataFrame, table: str, columns: dict[str, str], key: str) -> Dimension:
    """Adds the names new to a dimension and returns it as it then is."""
    append(new_members(raw, Dimension(spark.table(table), columns, key)), table)
    return Dimension(spark.table(table), columns, key)


def load_orders(spark: SparkSession, raw: DataFrame, database: str) -> None:
    """New products, then new orders with their product keys."""
    product = add_members(spark, raw, f"{database}.products", {"product": "product_name"}, "product_id")
    table = f"{database}.orders"
    rows = with_key(raw, product, product.existing)
    append(new_rows(spark.table(table), fitted(rows, table), ["order_id"]), table)


def load_deliveries(spark: SparkSession, raw: DataFrame, database: str) -> None:
    """New companies, couriers, warehouses and products, then new deliveries with their keys."""
    keys = {
        "products": ({"product": "product_name"}, "product_id"),
        "delivery_companies": ({"company": "company_name"}, "company_id"),
        "couriers": ({"courier_name": "courier_name", "courier_phone": "courier_phone"}, "courier_id"),
        "warehouses": ({"warehouse": "warehouse", "address": "address"}, "warehouse_id"),
    }
    rows = raw
    for name, (columns, key) in keys.items():
        dim = add_members(spark, raw, f"{database}.{name}", columns, key)
        rows = with_key(rows, dim, dim.existing)
    table = f"{database}.deliveries"
    append(new_rows(spark.table(table), fitted(rows, table), ["delivery_id"]), table)


def run(
    spark: SparkSession, users: DataFrame, orders: DataFrame, root: str, database: str,
    deliveries: DataFrame | None = None,
) -> DataFrame:
    """Builds or extends the layer; returns the orders table."""
    ensure_tables(spark, root, database)
    load_users(spark, users, database, root)
    load_orders(spark, orders, database)
    if deliveries is not None:
        load_deliveries(spark, deliveries, database)
    return spark.table(f"{database}.orders")

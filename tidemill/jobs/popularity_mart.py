"""Product popularity: CSV files -> raw -> dds -> mart, all-or-nothing.

Raw is filled from new files only. The dds step takes the raw batches after the ones its record names,
upserts all tables and recounts the products these batches touch; the rows and how far the batches
were taken in are named by one record. Readers see the three tables and the mart of one record, so a run
that fails on the way changes nothing for them, and the next run goes on from its last draft.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemill.operators.aggregates import popularity
from tidemill.operators.quality import rules_for
from tidemill.sources import releases
from tidemill.sources.releases import Release
from tidemill.sources.sinks import ensure_table
from tidemill.streaming.files import POSITION, ingest_checked_files, reject_zero_length, stored

# Table columns, file patterns and upsert keys.
TABLES = {
    "products": ("product_id INT, product_name STRING", "raw_products_*.csv", ["product_id"]),
    "orders": ("order_id INT, order_date DATE", "raw_orders_*.csv", ["order_id"]),
    "order_items": (
        "order_id INT, product_id INT, quantity INT, price DECIMAL(10,2)",
        "raw_order_items_*.csv",
        ["order_id", "product_id"],
    ),
}
# Orders are stored in blocks of ids, so that a batch replaces the blocks it falls into only.
BLOCKED = {"orders", "order_items"}
ORDERS_PER_BLOCK = 1_000_000
# Raw batches that one turn takes in.
BATCHES = 50
MART_TABLE, TOUCHED = "product_popularity", "touched_products"
MART = (
    "product_id INT, product_name STRING, total_quantity_sold BIGINT, "
    "total_revenue DECIMAL(24,2), order_count BIGINT, avg_price DECIMAL(18,2)"
)


def load_raw(
    spark: SparkSession, src: str | dict[str, str], root: str, archive: str | None = None
) -> None:
    """New, valid files of each kind to ``root/raw``; the others to ``root/rejects``.

    ``src`` is one folder whose file names tell the kind, or a folder for each kind; files that were
    read move to ``archive`` when it is given.
    """
    running = []
    places = {name: (src, pattern) if isinstance(src, str) else (src[name], "*.csv") for name, (_, pattern, _) in TABLES.items()}
    for name, (ddl, _, _) in TABLES.items():
        folder, glob = places[name]
        running.append(ingest_checked_files(
            spark, folder, f"{root}/raw/{name}", f"{root}/rejects/{name}",
            StructType.fromDDL(ddl), rules_for(name), glob=glob, archive=archive,
        ))
    for query in running:
        query.awaitTermination()
    for name, (folder, glob) in places.items():
        reject_zero_length(spark, folder, f"{root}/rejects/{name}", StructType.fromDDL(TABLES[name][0]), glob)


def schema_of(table: str) -> str:
    """Columns of a dds table or of the mart."""
    if table == MART_TABLE:
        return MART
    return f"{TABLES[table][0]}, order_block INT" if table in BLOCKED else TABLES[table][0]


def new_batches(spark: SparkSession, release: Release, root: str, name: str) -> tuple[DataFrame, list[int]]:
    """Raw rows of a kind and the numbers of the batches not taken in yet, the oldest ones first."""
    raw = stored(spark, f"{root}/raw/{name}", StructType.fromDDL(TABLES[name][0]))
    new = raw.filter(F.col("batch_id") > int(release.marks.get(name, -1))).select("batch_id").distinct()
    return raw, [r[0] for r in new.orderBy("batch_id").limit(BATCHES).collect()]


def raw_to_dds(
    spark: SparkSession, release: Release, root: str, before_table: Callable[[str], None] | None = None
) -> Release:
    """Upserts the raw batches not taken in yet, so many at a time; the later place in the files wins.

    Each turn ends with a draft that holds all three tables or none. ``before_table`` is called with each
    table's name before it is written; what it raises ends the run.
    """
    while True:
        turn = release
        for name, (_, _, keys) in TABLES.items():
            raw, batches = new_batches(spark, release, root, name)
            if before_table:
                before_table(name)
            if not batches:
                continue
            new = raw.filter(F.col("batch_id").isin(batches))
            block = "order_block" if name in BLOCKED else None
            if block:
                new = new.withColumn(block, F.floor(F.col("order_id") / ORDERS_PER_BLOCK).cast("int"))
            turn = turn.upserted(name, schema_of(name), new, keys, ["batch_id", *POSITION], block)
            if "product_id" in keys:
                turn = turn.appended(TOUCHED, new.select("product_id").distinct())
            turn = turn.marked(**{name: batches[-1]})
        if turn is release:
            return release
        release = turn.saved(final=False)


def dds_to_mart(spark: SparkSession, release: Release) -> Release:
    """Recounts the products that new rows touched; all others keep their row of the mart.

    The upsert key of the items makes (order, product) unique.
    """
    if TOUCHED not in release.places:
        return release
    touched = release.read(TOUCHED, "product_id INT").distinct()
    items, products = (release.read(t, schema_of(t)).join(touched, "product_id", "left_semi") for t in ("order_items", "products"))
    counted = popularity(items, products, one_row_per_order=True)
    counted = counted.select(*[F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(MART).fields])
    kept = release.read(MART_TABLE, MART).join(touched, "product_id", "left_anti")
    return release.replaced(MART_TABLE, kept.unionByName(counted)).dropped(TOUCHED)


def publish(spark: SparkSession, release: Release, root: str, database: str) -> Release:
    """Puts a draft in force by one record, then points the catalog's tables at it; the latter is also done for tables
    that were made anew and for a record whose run ended between the two."""
    before = releases.current(spark, root)
    if not release.final:
        release = release.saved()
    for table in (*TABLES, MART_TABLE):
        name, block = f"{database}.{table}", "order_block" if table in BLOCKED else None
        made = not spark.catalog.tableExists(name)
        ensure_table(spark, name, schema_of(table), root, [block] if block else None)
        if release.paths(table):
            # a record in force says nothing of the catalog; only what this run changed is known to be behind
            releases.follow(release, table, name, block, None if made or release.number == before.number else before)
    return release


def run(
    spark: SparkSession, src: str | dict[str, str], root: str, database: str, archive: str | None = None,
    before_table: Callable[[str], None] | None = None,
) -> DataFrame:
    load_raw(spark, src, root, archive)
    release = raw_to_dds(spark, releases.draft(spark, root), root, before_table)
    return mart(spark, publish(spark, dds_to_mart(spark, release), root, database))


def mart(spark: SparkSession, of: Release | str) -> DataFrame:
    """The mart of a record, or of the one in force under a root."""
    release = releases.current(spark, of) if isinstance(of, str) else of
    return release.read(MART_TABLE, MART)

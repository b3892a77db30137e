"""Sinks and catalog tables."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemill.operators.changes import upsert
from tidemill.session import materialise, shared_dir

_OVERWRITE_MODE = threading.Lock()
_TABLE_ID = "tidemill.id"
MAX_TOUCHED = 100_000


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """CSV part files with a header, written by all tasks."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def append_jdbc(df: DataFrame, url: str, table: str, connections: int = 16, **options: str) -> None:
    """Adds the rows to a database table over at most ``connections`` connections at a time."""
    writer = df.coalesce(connections).write.format("jdbc").mode("append")
    writer.options(url=url, dbtable=table, **options).save()


def write_new(df: DataFrame, path: str) -> bool:
    """Writes unless the path already holds data; tells whether it wrote."""
    try:
        df.write.mode("errorifexists").parquet(path)
    except Exception as error:
        if "PATH_ALREADY_EXISTS" in str(error):
            return False
        raise
    return True


def ensure_table(
    spark: SparkSession, name: str, schema: StructType | str, root: str | None = None,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Creates ``database.table`` as external Parquet when it is absent."""
    root = root or f"{shared_dir(spark)}/tables"
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if "." in name:
        database = name.split(".")[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/{database}'")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        location = version_path(name, root)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} LOCATION '{location}' "
            f"TBLPROPERTIES ('{_TABLE_ID}' = '{uuid.uuid4().hex}')"
        )
    return spark.table(name)


def table_id(spark: SparkSession, name: str) -> str:
    """An id given to the table when it was created; a table made anew has another."""
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('{_TABLE_ID}')").first()["value"]


def version_path(name: str, root: str) -> str:
    return f"{root}/{name.replace('.', '/')}/version={uuid.uuid4().hex}"


def fitted(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns, order and types of the table."""
    schema = df.sparkSession.table(name).schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def laid_out(df: DataFrame, cluster_by: list[str]) -> DataFrame:
    """Rows in value order over all files, so that a filter on the columns skips most of them.

    The list should end with a column that varies: a frequent value can then span many files.
    """
    if not cluster_by:
        return df
    return df.repartitionByRange(*[F.col(c) for c in cluster_by]).sortWithinPartitions(*cluster_by)


def append(df: DataFrame, name: str, cluster_by: list[str] = ()) -> None:
    """Adds the rows to a catalog table."""
    laid_out(fitted(df, name), cluster_by).write.mode("append").insertInto(name)


@contextmanager
def _mode_of(spark: SparkSession, mode: str):
    """A catalog table takes the overwrite mode from the session only."""
    key = "spark.sql.sources.partitionOverwriteMode"
    usual = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def overwrite(df: DataFrame, name: str, root: str | None = None, cluster_by: list[str] = ()) -> None:
    """Replaces all rows of a table, also when ``df`` reads that table.

    The rows go to a new folder first; then the table is pointed at it. A failed write leaves the
    table as it was, and a running reader keeps its old files. Partitions have places of their own
    in the catalog: there the rows are stored first and then replace all partitions; if that
    fails, a repeat completes it.
    """
    spark = df.sparkSession
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        rows = materialise(laid_out(fitted(df, name), cluster_by), "replacement")
        with _OVERWRITE_MODE, _mode_of(spark, "static"):
            rows.write.insertInto(name, overwrite=True)
        return
    root = root or f"{shared_dir(spark)}/tables"
    path = version_path(name, root)
    laid_out(fitted(df, name), cluster_by).write.parquet(path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def overwrite_partitions(df: DataFrame, name: str, partitions: list[str]) -> None:
    """Replaces only the partitions that occur in ``df``; ``df`` must not read the table.

    Rows are gathered by partition before the write, a large one split over several tasks, so that
    neither many small files nor one slow task come about. Partitions are replaced one after the
    other; after a failure in between, a repeat completes the work.
    """
    with _OVERWRITE_MODE, _mode_of(df.sparkSession, "dynamic"):
        fitted(df, name).hint("rebalance", *partitions).write.insertInto(name, overwrite=True)


def upsert_table(
    spark: SparkSession, name: str, new: DataFrame, keys: list[str], order_by: list[str],
    root: str | None = None, partitions: list[str] = (),
) -> None:
    """Upserts into a catalog table; the last new row in ``order_by`` wins.

    Where the table is partitioned by ``partitions``, which must follow from the keys, only the
    partitions that the new rows fall into are read and replaced; a small batch then costs little
    however large the table is. Without them the table is written anew. Both can be repeated.
    """
    # Micro-batches have a session of their own; the table's is the one whose readers must see it.
    target = spark.table(name)
    if not partitions:
        overwrite(upsert(target, new, keys, order_by), name, root)
        return
    touched = materialise(new.select(*partitions).distinct(), "touched")
    if touched.count() <= MAX_TOUCHED:  # as a broadcast it prunes the scan
        touched = F.broadcast(touched)
    near = target.join(touched, list(partitions), "left_semi").select(*target.columns)
    overwrite_partitions(materialise(upsert(near, new, keys, order_by), "upsert"), name, list(partitions))


def insert_select(spark: SparkSession, sql: str, name: str, **tables: DataFrame) -> None:
    """Appends the result of a query, columns matched by name."""
    append(spark.sql(sql, **tables), name)


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON messages: ``value``, and ``key`` when a column is named for it."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def view_orders_from(
    facts: DataFrame, places: DataFrame, on: Column, where: Column, columns: list[str], view: str
) -> DataFrame:
    """A named view of the facts whose place passes ``where``; nothing is computed until read."""
    facts.join(places, on).filter(where).select(*columns).createOrReplaceTempView(view)
    return facts.sparkSession.table(view)


@contextmanager
def temp_table(df: DataFrame, name: str):
    """A session table filled once and dropped at the end of the block, so results must be taken inside.

    Rows are kept on executors and spill to their disks; a lost one is computed again.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        df.createTempView(name)  # an error if there is a view of that name, which stays as it is
    except Exception:
        df.unpersist()
        raise
    try:
        yield df.sparkSession.table(name)
    finally:
        df.sparkSession.catalog.dropTempView(name)
        df.unpersist()

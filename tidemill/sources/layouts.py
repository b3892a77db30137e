"""Tables laid out for how they are read: bucketed by key, with bloom filters, with statistics.

A bucketed table is a view over its newest version, which is stored bucketed and sorted by key. Two
tables with the same keys and buckets join without an exchange of either, and an upsert moves the new
rows only: the version it writes keeps every row in its bucket. Replacing the view puts it in place.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.operators.changes import upsert
from tidemill.operators.shape import last_per_key
from tidemill.session import shared_dir

BUCKETS = 64


def _version(df: DataFrame, name: str, keys: list[str], buckets: int, root: str | None) -> str:
    """Stores rows that are already dealt by key, as one file per bucket."""
    spark = df.sparkSession
    version = f"{name}_{uuid.uuid4().hex}"
    path = f"{root or shared_dir(spark) + '/tables'}/{version.replace('.', '/')}"
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(version)
    return version


def _show(spark: SparkSession, name: str, version: str) -> DataFrame:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    return spark.table(name)


def store_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int = BUCKETS, root: str | None = None) -> DataFrame:
    """Stores a table by key; one exchange deals the rows out. Older versions stay for running readers."""
    dealt = df.repartition(buckets, *keys)
    return _show(df.sparkSession, name, _version(dealt, name, keys, buckets, root))


def upsert_bucketed(
    spark: SparkSession, name: str, new: DataFrame, keys: list[str], order_by: list[str], buckets: int = BUCKETS,
    root: str | None = None,
) -> DataFrame:
    """Adds unknown keys and replaces known ones, the last new row in ``order_by`` winning; null keys are equal.

    The stored rows are read in their buckets and meet the new ones there, so only the new rows are moved."""
    merged = merged_by_bucket(spark.table(name), new, keys, order_by, buckets)
    return _show(spark, name, _version(merged, name, keys, buckets, root))


def merged_by_bucket(target: DataFrame, new: DataFrame, keys: list[str], order_by: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The rows of an upsert as one join of the buckets, without an exchange of ``target``."""
    last = last_per_key(new, keys, order_by).select(*target.columns)
    present = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    moved = last.filter(present).select(*[F.col(c).alias(f"_n_{c}") for c in target.columns], F.lit(True).alias("_new"))
    moved = moved.repartition(buckets, *[f"_n_{k}" for k in keys]).hint("merge")
    equal = [F.col(k) == F.col(f"_n_{k}") for k in keys]
    joined = target.filter(present).join(moved, equal, "full_outer")
    rows = joined.select(*[F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns])
    # keys with a null, which plain equality passes over; file statistics skip most of the table
    return rows.unionByName(upsert(target.filter(~present), last.filter(~present), keys, keys))


def write_with_blooms(
    df: DataFrame, path: str, values: dict[str, int], sort_by: list[str] = (), row_group_bytes: int | None = None
) -> str:
    """Parquet files with a bloom filter per row group on the columns of ``values``, given with about how many different
    ones a file holds, so that a look-up by any of them skips row groups although rows are sorted by others."""
    rows = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by) if sort_by else df
    writer = rows.write
    for column, distinct in values.items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    return path


def analyse(spark: SparkSession, name: str, columns: list[str]) -> None:
    """Counts rows, distinct values, nulls and bounds, for the optimizer to order joins by."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


def by_statistics(spark: SparkSession):
    """A session beside this one that orders joins by statistics; tables and temporary folders are the same."""
    own = spark.newSession()
    for key in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled", "spark.sql.statistics.histogram.enabled"):
        own.conf.set(key, "true")
    return own

"""Folders of micro-batches folded into large files, so that a stream can run for years.

A stream writes a ``batch_id=`` folder per micro-batch, which a repeat of the batch replaces. Only the newest
batch can be repeated, so all older ones are finished: their rows are written together, and a record
(see ``sources.releases``) names the new folder and the last batch in it. Readers take the folded rows
and the batches after that mark, so each row is seen once at any moment. Ten folders of a size are
merged into one of the next, so a row is written again only once per power of ten.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemill.sources import releases
from tidemill.sources.releases import Release, plain

ROWS, MARK = "rows", "folded"
MERGED = 10


def records(table: str) -> str:
    """Where the records and the folded rows of a stream's table lie: beside it."""
    return f"{table.rstrip('/')}.folded"


def _batches(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields]).add("batch_id", "long")).parquet(table)


def _mark(release: Release) -> int:
    return int(release.marks.get(MARK, -1))


def read(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """All rows of a stream's table, folded or not, each once."""
    release = releases.current(spark, records(table))
    rest = _batches(spark, table, schema).filter(F.col("batch_id") > _mark(release)).select(*schema.fieldNames())
    return release.read(ROWS, schema).unionByName(rest) if release.paths(ROWS) else rest


def fold(spark: SparkSession, table: str, schema: StructType, at_least: int = 2, merged: int = MERGED) -> Release:
    """Folds the finished batches after the mark if there are ``at_least`` so many; a run that is cut off changes nothing.

    Rows of a batch folder that a stream has yet to finish stay where they are."""
    release = releases.current(spark, records(table))
    batches = _batches(spark, table, schema).filter(F.col("batch_id") > _mark(release))
    numbers = sorted(r[0] for r in batches.select("batch_id").distinct().collect())
    finished = numbers[:-1]
    if len(finished) < at_least:
        return release
    rows = batches.filter(F.col("batch_id") <= finished[-1]).select(*schema.fieldNames()).hint("rebalance")
    release = release.appended(ROWS, rows, group="0").marked(**{MARK: finished[-1]})
    level = 0
    while len(release.places[ROWS].get(str(level), ())) >= merged:
        release = release.merged(ROWS, schema, str(level), str(level + 1))
        level += 1
    return release.saved()


def drop_folded(spark: SparkSession, table: str, keep: int = 10) -> int:
    """Deletes the folders of folded batches and what old records alone name, in any store that Arrow can open, and tells
    how many went. Readers that began before the last fold must have ended."""
    import pyarrow.fs as fs

    mark = _mark(releases.current(spark, records(table)))
    store, base = fs.FileSystem.from_uri(plain(table))
    gone = 0
    for f in store.get_file_info(fs.FileSelector(base)):
        number = re.search(r"/batch_id=(\d+)$", f.path)
        if number and int(number[1]) <= mark:
            store.delete_dir(f.path)
            gone += 1
    return gone + releases.expire(spark, records(table), keep)

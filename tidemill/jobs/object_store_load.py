"""New CSV objects under a prefix to a table, each object once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemill.operators.quality import Rule
from tidemill.streaming.files import ingest_checked_files, loaded_files, stored

# Columns of an object.
OBJECT = StructType().add("id", "integer").add("value", "integer")


def run(
    spark: SparkSession, src: str, root: str, schema: StructType = OBJECT, rules: list[Rule] = (),
    archive: str | None = None,
) -> DataFrame:
    """Loads objects not loaded before; one that cannot be read is put aside, the others go on."""
    ingest_checked_files(
        spark, src, f"{root}/data", f"{root}/rejects", schema, list(rules),
        unique_rows=False, reject_empty=False, glob="*.csv", archive=archive,
    ).awaitTermination()
    return stored(spark, f"{root}/data", schema)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Objects loaded so far."""
    return loaded_files(spark, f"{root}/data")

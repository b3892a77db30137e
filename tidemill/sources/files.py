"""File and table scans. Schemas are given, never inferred from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Units of the sales text line, `product,<n>шт,<n>р`.
PIECES = "шт"
ROUBLES = "р"


def read_csv(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """CSV with a header row. A header that differs from the schema fails, and so does a cell that
    does not fit its type unless ``mode`` is given."""
    options = {"header": True, "enforceSchema": False, "mode": "FAILFAST", **options}
    return spark.read.schema(schema).options(**options).csv(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A whole table: a Parquet path when there is a slash in the name, else a catalog table."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str,
    lower,
    upper,
    splits: int,
    **options: str,
) -> DataFrame:
    """A database table read by ``splits`` tasks over ranges of ``split_column``.

    Filters and column choice made on the result are pushed into the database query.
    """
    bounds = {
        "partitionColumn": split_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(splits),
    }
    return spark.read.format("jdbc").options(url=url, dbtable=table, **bounds, **options).load()


def read_query(spark: SparkSession, sql: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """SQL over the named frames, ``{name}`` in the text; ``:name`` marks a parameter value."""
    return spark.sql(sql, args=args, **tables)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Files that each hold one JSON array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in one column, ``value``."""
    return spark.read.text(path)


def read_prefix(spark: SparkSession, uri: str, schema: StructType | str, **options) -> DataFrame:
    """CSV objects under a prefix, each row with the object it came from.

    Doubled slashes are folded, so `/raw/x` and `raw/x` under one bucket name the same object.
    """
    head, sep, tail = uri.partition("://")
    uri = head + sep + _fold(tail) if sep else _fold(head)
    return read_csv(spark, uri, schema, **options).withColumn("file_path", F.col("_metadata.file_path"))


def _local(path: Column) -> Column:
    """Local paths without their scheme, which is written with one slash or three."""
    return F.regexp_replace(path, "^file:/+", "/")


def _fold(path: str) -> str:
    while "//" in path:
        path = path.replace("//", "/")
    return path


def rows(spark: SparkSession, values: list[tuple], schema: StructType | str) -> DataFrame:
    """Rows written out in the call."""
    return spark.createDataFrame(values, schema)


def parse_sales_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """``product,<n>шт,<n>р`` lines to columns; numbers are null where a line does not fit."""
    cells = F.split(F.col(line), ",")

    def number(cell: Column, unit: str) -> Column:
        return F.regexp_extract(cell, f"^([0-9]+){unit}$", 1).try_cast("int")

    return df.select(
        F.get(cells, 0).alias("product"),
        number(F.get(cells, 1), PIECES).alias("quantity"),
        number(F.get(cells, 2), ROUBLES).alias("price"),
    )


def rows_per_file(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Row count by file, for any file scan.

    Files without rows have no group; naming the ``paths`` adds them with 0.
    """
    path = _local(F.col("_metadata.file_path")).alias("file_path")
    counted = df.groupBy(path).agg(F.count("*").alias("n_rows"))
    if paths is None:
        return counted
    wanted = df.sparkSession.createDataFrame([(p,) for p in paths], "file_path string")
    wanted = wanted.select(_local(F.col("file_path")).alias("file_path"))
    return wanted.join(counted, "file_path", "left").fillna(0, ["n_rows"])


def extract_since(df: DataFrame, ts: str, since) -> DataFrame:
    """Rows at or after ``since``; the filter reaches the scan."""
    since = since if isinstance(since, Column) else F.lit(since)
    return df.filter(F.col(ts) >= since)

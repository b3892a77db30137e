"""Incremental file ingest: every file is taken once, as the checkpoint remembers.

A file without rows is remembered too and not looked at again; checked ingest reports it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tidemill.operators.quality import Rule, errors_of, typed_cells
from tidemill.session import materialise
from tidemill.sources.sinks import append
from tidemill.streaming.messages import MAX_FILES, append_batches

# Where a row stood: file, block within the file, and a number that rises within the block.
POSITION = ["file_path", "file_block", "row_no"]


def new_files(
    spark: SparkSession, src: str, schema: StructType, glob: str | None = None,
    max_files: int | None = None, archive: str | None = None, **options,
) -> DataFrame:
    """A stream of the CSV files that arrive in ``src``, with the file of each row.

    ``max_files`` limits a micro-batch (1 for file by file); ``archive`` moves read files there. A
    header that differs from the schema stops the stream, so no column is taken for another.
    """
    reader = spark.readStream.schema(schema).options(**{"header": True, "enforceSchema": False, **options})
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(src).select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block"),
    )


def ingest_new_files(
    spark: SparkSession, src: str, dst: str, checkpoint: str, schema: StructType, **options
) -> StreamingQuery:
    """Appends the rows of files not seen before to the Parquet table ``dst``."""
    return append_batches(new_files(spark, src, schema, **options), dst, checkpoint)


BROKEN = "_corrupt_record"
EMPTY = "the file is empty"


def as_text(schema: StructType) -> StructType:
    """All cells as text, and the line itself where it has too few or too many of them."""
    return StructType([StructField(name, StringType()) for name in [*schema.fieldNames(), BROKEN]])


def ingest_checked_files(
    spark: SparkSession, src: str, dst: str, rejects: str, schema: StructType, rules: list[Rule],
    whole_file: bool = True, unique_rows: bool = True, reject_empty: bool = True, required: bool = True, **options,
) -> StreamingQuery:
    """Takes new files whose rows keep the rules; bad rows go to ``rejects`` with their messages.

    Cells are read as text, and the header as a row like others, so what is wrong is reported and
    does not stop the load. A file without the right header is not loaded; with ``whole_file`` nor is
    one with any bad or (if ``unique_rows``) repeated row. A header alone is reported as an empty
    file unless ``reject_empty`` is off. Empty cells are errors unless ``required`` is off. A batch takes ``max_files`` at most, so a backlog comes in turns.
    ``dst`` and ``rejects`` are paths; batches are folders that a repeat replaces, and the
    checkpoint lies with ``dst``.
    """
    names = schema.fieldNames()
    filled = [Rule(f"{n} is empty", F.col(n).isNotNull()) for n in names] if required else []
    cells = typed_cells(schema)
    if not required:
        cells = [Rule(r.message, F.col(n).isNull() | r.holds) for n, r in zip(names, cells)]
    whole = Rule(f"the line does not have {len(names)} cells", F.col(BROKEN).isNull())
    is_header = reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.lit(n)) for n in names))
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]

    def store(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("row_no", F.monotonically_increasing_id()).withColumn("header", is_header)
        lines = numbered.withColumn("errors", errors_of([whole, *filled, *rules, *cells])).persist()
        files = lines.groupBy("file_path").agg(F.max("header").alias("known"), F.count_if(~F.col("header")).alias("n"))
        headless = files.filter("NOT known").select("file_path", F.lit(True).alias("headless"))
        empty = files.filter("n = 0").select(
            *[F.lit(None).cast("string").alias(n) for n in names], "file_path", F.array(F.lit(EMPTY)).alias("errors")
        )
        rows = lines.filter("NOT header").join(headless, "file_path", "left")
        note = F.when(F.col("headless"), F.array_append("errors", F.lit(f"the header is not {','.join(names)}")))
        rows = rows.withColumn("errors", F.coalesce(note, "errors"))
        try:
            bad = rows.filter(F.size("errors") > 0).select(*names, "file_path", "errors")
            if unique_rows:
                copies = rows.groupBy("file_path", *names).agg(F.count("*").alias("n")).filter("n > 1")
                note = F.array(F.lit("the row is repeated in its file")).alias("errors")
                bad = bad.unionByName(copies.select(*names, "file_path", note))
            good = rows.filter(F.size("errors") == 0)
            if whole_file:
                failed = bad.select("file_path").distinct()
                good = good.join(failed, "file_path", "left_anti")
            good.select(*typed, *POSITION).write.mode("overwrite").parquet(f"{dst}/batch_id={batch_id}")
            (bad.unionByName(empty) if reject_empty else bad).write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        finally:
            lines.unpersist()

    options = {"max_files": MAX_FILES, **options}
    stream = new_files(spark, src, as_text(schema), header=False, columnNameOfCorruptRecord=BROKEN, **options)
    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{dst}/_checkpoint")
    return writer.trigger(availableNow=True).start()


def reject_zero_length(
    spark: SparkSession, src: str, rejects: str, schema: StructType, glob: str | None = None
) -> None:
    """Records files of no bytes at all, which all of Spark's readers pass over, ``binaryFile`` too, so the folder is
    listed by the store's own client. Those recorded before are left out."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{src.rstrip('/')}/{glob or '*'}")
    listing = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = [(f.getPath().toString(),) for f in listing if f.isFile() and f.getLen() == 0]
    found = spark.createDataFrame(paths, "file_path STRING").select(
        *[F.lit(None).cast("string").alias(n) for n in schema.fieldNames()], "file_path", F.array(F.lit(EMPTY)).alias("errors"),
    )
    known = spark.read.schema("file_path string").parquet(rejects)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")  # noqa: E731 - listings and rows spell it differently
    new = found.join(known.select(plain("file_path").alias("_known")).distinct(), plain("file_path") == F.col("_known"), "left_anti")
    if not new.isEmpty():
        new.write.mode("append").parquet(f"{rejects}/batch_id=-1")


def stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows stored by ``ingest_checked_files``, with their place and batch; empty before the first."""
    return spark.read.schema(stored_schema(schema)).parquet(path)


def stored_schema(schema: StructType) -> StructType:
    out = StructType([*schema.fields])
    return out.add("file_path", "string").add("file_block", "long").add("row_no", "long").add("batch_id", "long")


def loaded_files(spark: SparkSession, path: str) -> DataFrame:
    """The files whose rows were loaded, with their row counts."""
    return spark.read.parquet(path).groupBy("file_path").agg(F.count("*").alias("n_rows"))


def sync_new(source: DataFrame, target: DataFrame, ts: str, keys: list[str], look_back: str = "5 minutes") -> DataFrame:
    """Source rows the target lacks, from the target's latest time less ``look_back`` on.

    The mark comes from the target, not from the clock, so nothing is missed after a pause; rows
    read twice because of the look-back drop out by key. A row keeps its time, so only the target's
    part from the mark on is compared; both sides push the mark to their scan.
    """
    first = F.lit("0001-01-01").cast(target.schema[ts].dataType)
    mark = target.agg(F.coalesce(F.max(ts) - F.expr(f"INTERVAL {look_back}"), first)).scalar()
    recent, known = (rows.filter(F.col(ts) >= mark) for rows in (source, target))
    return recent.join(known.select(*keys), keys, "left_anti")


def sync_by_day(
    source: DataFrame, table: str, ts: str, keys: list[str], look_back: str = "5 minutes", day: str = "day"
) -> DataFrame:
    """``sync_new`` into a catalog table that is partitioned by the ``day`` of the time: appends the new rows and returns
    them.

    The mark is looked for in the table's last day, and rows are compared with the days from the
    mark's on: all other partitions are pruned, however long the table. A row that comes later than the
    look-back allows is not taken.
    """
    spark = source.sparkSession
    target = spark.table(table)
    last_day = target.agg(F.max(day).alias("d")).first()["d"]  # from the list of partitions
    newest = None if last_day is None else target.filter(F.col(day) == F.lit(last_day)).agg((F.max(ts) - F.expr(f"INTERVAL {look_back}")).alias("t")).first()["t"]
    rows = source
    if newest is not None:
        mark = F.lit(newest).cast(target.schema[ts].dataType)
        known = target.filter((F.col(day) >= F.to_date(mark)) & (F.col(ts) >= mark))
        rows = source.filter(F.col(ts) >= mark).join(known.select(*keys), keys, "left_anti")
    new = materialise(rows.withColumn(day, F.to_date(ts)), "synced")  # appended and returned alike
    append(new.hint("rebalance", day), table)
    return new.select(*source.columns)

"""JSON message streams: reading, checking, storing and publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, StringType

from tidemill.sources.sinks import to_messages
from tidemill.streaming import folding

CORRUPT = "_corrupt_record"
# What one micro-batch takes unless told otherwise.
MAX_OFFSETS = 5_000_000
MAX_FILES = 1_000
# Batches whose folders are folded together while a stream runs.
FOLD_EVERY = 200
REJECT = StructType([StructField("value", StringType()), StructField("problem", StringType())])


def message_source(spark: SparkSession, source: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """A stream of text messages in the column ``value``.

    ``kafka`` starts at the earliest offset unless told otherwise; ``text`` follows a folder of
    line files. Kafka splits by topic partition, and ``minPartitions`` splits a hot one further.
    A micro-batch takes a part of a long backlog only, unless the limits are set otherwise.
    """
    if source == "kafka":
        options = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": MAX_OFFSETS, **options}
        stream = spark.readStream.format("kafka").options(**options).load()
        return stream.select(F.col("value").cast("string").alias("value"))
    options = {"maxFilesPerTrigger": MAX_FILES, **options}
    return spark.readStream.format(source).options(**options).load(path).select("value")


def parse(messages: DataFrame, schema: StructType) -> DataFrame:
    """Adds ``record``, and ``problem`` where a message is no JSON object of this schema or lacks
    a field that must not be null."""
    noted = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json("value", noted, options)
    lacking = [F.when(F.col(f"record.{f.name}").isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable]
    absent: Column = F.array_compact(F.array(*lacking)) if lacking else F.array().cast("array<string>")
    problem = (
        F.when(F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull(), "not a record of the schema")
        .when(F.size(absent) > 0, F.concat(F.lit("missing: "), F.array_join(absent, ", ")))
    )
    return messages.withColumn("record", record).withColumn("problem", problem)


def _good(parsed: DataFrame, schema: StructType) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).select(*[f"record.{f.name}" for f in schema.fields])


def _bad(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull()).select("value", "problem")


def split_bad(messages: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Good records, and bad messages with what is wrong; for streams and plain frames alike."""
    parsed = parse(messages, schema)
    return _good(parsed, schema), _bad(parsed)


def ingest_stream(
    messages: DataFrame, schema: StructType, table: str, rejects: str, checkpoint: str | None = None,
    trigger: dict | None = None, fold_every: int | None = FOLD_EVERY,
) -> StreamingQuery:
    """Stores good records under ``table`` and bad messages under ``rejects`` (both paths).

    Every micro-batch has its own ``batch_id`` folder that a repeat replaces, so a batch that was
    cut off and run again leaves no second copy. The checkpoint lies with the table, because batch
    numbers only make sense together with it. Every ``fold_every`` batches the finished folders are
    folded into large files (see ``streaming.folding``), through which readers go.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(batch, schema).persist()
        try:
            _good(parsed, schema).write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
            _bad(parsed).write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        finally:
            parsed.unpersist()
        if fold_every and batch_id and batch_id % fold_every == 0:
            for path, columns in ((table, schema), (rejects, REJECT)):
                folding.fold(batch.sparkSession, path, columns)

    writer = messages.writeStream.foreachBatch(store)
    writer = writer.option("checkpointLocation", checkpoint or f"{table}/_checkpoint")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stored_records(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """Good records stored by ``ingest_stream``."""
    return folding.read(spark, table, schema)


def stored_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """Bad messages stored by ``ingest_stream``."""
    return folding.read(spark, rejects, REJECT)


def append_batches(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Appends a stream to a Parquet table, each micro-batch committed once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def publish(
    stream: DataFrame, checkpoint: str, topic: str | None = None, path: str | None = None,
    key: str | None = None, trigger: dict | None = None, **options,
) -> StreamingQuery:
    """Publishes rows as JSON messages to a Kafka ``topic``, or as text lines under ``path``."""
    messages = to_messages(stream, key)
    if topic:
        writer = messages.writeStream.format("kafka").option("topic", topic).options(**options)
    else:
        writer = messages.select("value").writeStream.format("text").option("path", path).options(**options)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def published(spark: SparkSession, path: str) -> DataFrame:
    """Messages stored by ``publish``, as a plain frame."""
    return spark.read.text(path)

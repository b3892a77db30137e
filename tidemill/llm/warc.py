"""WARC archives: writing, making one gzip member per record, and reading by offset index."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.session import scratch_path

END = "\r\n\r\n"
SMALLEST_SHARED = 100  # bytes: payloads below are never written as revisits
RECORDS_PER_ARCHIVE = 50_000
INDEX = (
    "archive STRING, offset BIGINT, length BIGINT, record_id STRING, record_type STRING, uri STRING, "
    "payload_digest STRING, source STRING, source_offset BIGINT"
)
RECORDS = (
    "page_id BIGINT, uri STRING, payload BINARY, payload_bytes BIGINT, payload_digest STRING, record_type STRING, "
    "refers_to BIGINT"
)


def filesystem(uri: str):
    """The store a folder or file lies in, and its path there. Any store that Arrow knows will do."""
    from pyarrow.fs import FileSystem

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return FileSystem.from_uri(uri)


def page_records(pages: DataFrame) -> DataFrame:
    """One WARC record per page, without its closing blank lines, in column ``value``.

    Of pages with equal payloads of at least 100 bytes, the one with the smallest id is a response
    and the others revisits of it. A null html is an empty payload. Pages without an id are never
    referred to; where no page of the group has an id, all are responses. Rows that repeat the
    smallest id are each a response.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20\x7F]", "").alias("uri"),
        payload.alias("payload"), F.octet_length(payload).alias("size"), F.sha2(payload, 256).alias("digest"),
    )
    shared = (
        rows.where(F.col("size") >= SMALLEST_SHARED).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1").select("digest", "first_id")
    )
    rows = rows.join(shared, "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit(END),
    )
    block = F.when(again, "").otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Bytes", F.col("size").cast("string")),
        F.when(again, line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">")))).otherwise(""),
        F.when(again, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_monolithic(records: DataFrame, folder: str) -> None:
    """Archives as many crawlers leave them: each file one gzip stream over all its records."""
    (
        records.write.option("lineSep", END).option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(folder)
    )


def _headers(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if colon:
            found[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return found


class _Records:
    """Cuts one inflated stream, fed line by line, into whole records."""

    def __init__(self, source: str):
        self.source, self.at = source, 0
        self._start = 0
        self._head: list[bytes] = []
        self._body: list[bytes] = []
        self._missing: int | None = None  # bytes of block and closing lines still to come

    def feed(self, line: bytes):
        self.at += len(line)
        if self._missing is None:
            if not self._head and not line.strip():
                self._start = self.at
                return None
            if not self._head and not line.startswith(b"WARC/"):
                raise ValueError(f"no record at byte {self._start} of {self.source}")
            self._head.append(line)
            if line.strip():
                return None
            headers = _headers(self._head[1:])
            if not headers.get("content-length", "").isdigit():
                raise ValueError(f"record without a length at byte {self._start} of {self.source}")
            self._headers, self._missing = headers, int(headers["content-length"]) + len(END)
        else:
            self._body.append(line)
            self._missing -= len(line)
        if self._missing > 0:
            return None
        found = (self._start, self._headers, b"".join(self._head) + b"".join(self._body))
        self._head, self._body, self._missing, self._start = [], [], None, self.at
        return found

    def close(self) -> None:
        if self._head or self._missing:
            raise ValueError(f"{self.source} ends inside a record")


def _rewrite(folder: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in INDEX.split(", ")]
        store, root = filesystem(folder)
        records, sink, archive, offset, rows = None, None, "", 0, []

        def drained():
            out = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=INDEX_SCHEMA)
            rows.clear()
            return out

        for batch in batches:
            for source, line in zip(batch.column("source").to_pylist(), batch.column("line").to_pylist()):
                if records is None or source != records.source:
                    if records:
                        records.close()
                        sink.close()
                    # a new name for each attempt: what a lost attempt leaves is never indexed
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    records, archive, offset = _Records(source), f"{folder}/{name}", 0
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                found = records.feed(line + b"\n")
                if found:
                    start, headers, raw = found
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = packer.compress(raw) + packer.flush()
                    sink.write(member)
                    rows.append((
                        archive, offset, len(member), headers.get("warc-record-id"), headers.get("warc-type"),
                        headers.get("warc-target-uri"), headers.get("warc-payload-digest"), source, start,
                    ))
                    offset += len(member)
            if rows:
                yield drained()
        if records:
            records.close()
            sink.close()

    return run


INDEX_SCHEMA = pa.schema([
    (f.split()[0], pa.int64() if f.endswith("BIGINT") else pa.string()) for f in INDEX.split(", ")
])


def normalise(spark: SparkSession, monolithic: str, folder: str, level: int = 5) -> DataFrame:
    """Rewrites whole-file gzip archives with one gzip member per record; returns the offset index.

    Each file is inflated once, by one task, as a stream: memory holds one record. New archives go
    to ``folder`` and the index to ``folder/index``. Only archives that the index names count. A
    stream that ends inside a record, or a record without a length, is an error. An empty folder
    gives an empty index.
    """
    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)
    lines = spark.read.option("lineSep", "\n").text(monolithic).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("source")
    )
    index = f"{folder}/index"
    lines.mapInArrow(_rewrite(folder, level), INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _fetch(with_payload: bool):
    schema = pa.schema([
        ("page_id", pa.int64()), ("uri", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_name, source = "", None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != open_name:
                    if source:
                        source.close()
                    store, path = filesystem(archive)
                    open_name, source = archive, store.open_input_file(path)
                source.seek(offset)
                raw = zlib.decompress(source.read(length), 31)
                head, _, rest = raw.partition(END.encode())
                headers = _headers(head.split(b"\r\n")[1:])
                block, digest = rest[: int(headers["content-length"])], headers["warc-payload-digest"].removeprefix("sha256:")
                payload = None
                if headers["warc-type"] == "response":
                    payload = block.partition(END.encode())[2]
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"digest of the record at byte {offset} of {archive} differs")
                rows.append((
                    _page(headers["warc-record-id"]), headers.get("warc-target-uri"), payload if with_payload else None,
                    int(headers["x-payload-bytes"]) if payload is None else len(payload), digest,
                    headers["warc-type"], _page(headers.get("warc-refers-to")),
                ))
                if len(rows) == 500:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def read_archives(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records fetched by their offsets; payloads of responses are checked against their digests.

    A revisit has no payload of its own (null); its bytes and digest are those of the page it
    refers to.
    """
    return index.select("archive", "offset", "length").mapInArrow(_fetch(with_payload), RECORDS)


def pages_through_warc(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes pages to monolithic archives, normalises these, and reads every record back."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write_monolithic(page_records(pages), f"{folder}/monolithic")
    return read_archives(normalise(spark, f"{folder}/monolithic", f"{folder}/records"), with_payload=False)

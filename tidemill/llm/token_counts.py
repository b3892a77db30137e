"""Token counts of texts, kept in a cache by content and tokenizer digest."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.session import scratch_path

CACHE = "content BINARY, n_tokens BIGINT, tokenizer STRING"
# White space of the byte-level pattern, by Unicode's White_Space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The byte-level pattern never matches across these pieces, so a text's count is the sum of theirs.
PIECE = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
MEMO_PIECES = 600_000
MEMO_CHARS = 48


class JsonTokenizer:
    """Counts by the ``tokenizers`` library. Byte-level vocabularies are encoded piece by piece, and
    the counts of short pieces are remembered: a speed-up that leaves every count as it is."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        made_of = json.loads(self._tokenizer.to_str())
        split = made_of.get("pre_tokenizer") or {}
        self._by_piece = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space") and not made_of.get("normalizer")
        )
        self._special = [t["content"] for t in made_of.get("added_tokens") or []]
        self._memo: dict[str, int] = {}

    def _encoded(self, texts: list[str]) -> list[int]:
        found = []
        for at in range(0, len(texts), 256):
            part = self._tokenizer.encode_batch_fast(texts[at : at + 256], add_special_tokens=False)
            found.extend(len(x) for x in part)
        return found

    def counts(self, texts: list[str]) -> list[int]:
        return [self._count(t) for t in texts] if self._by_piece else self._encoded(texts)

    def _count(self, text: str) -> int:
        if any(s in text for s in self._special):
            return self._encoded([text])[0]
        pieces, memo = PIECE.findall(text), self._memo
        new = [p for p in set(pieces) if p not in memo]
        if not new:
            return sum(map(memo.__getitem__, pieces))
        if len(memo) + len(new) > MEMO_PIECES:
            memo.clear()
            new = list(set(pieces))
        own = dict(zip(new, self._encoded(new)))
        total = sum(own[p] if p in own else memo[p] for p in pieces)
        if len(own) <= MEMO_PIECES // 4:
            memo.update((p, n) for p, n in own.items() if len(p) <= MEMO_CHARS)
        return total


class PieceTokenizer:
    """Counts by the ``sentencepiece`` library."""

    def __init__(self, path: str):
        import sentencepiece

        self._processor = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(self._processor.encode(t, num_threads=1)) for t in texts]


_LOADED: dict[str, JsonTokenizer | PieceTokenizer] = {}


def load(path: str):
    """One tokenizer per worker process; the vocabulary file lies at the same path on every node."""
    if path not in _LOADED:
        _LOADED[path] = PieceTokenizer(path) if path.endswith(".model") else JsonTokenizer(path)
    return _LOADED[path]


def version_digest(path: str) -> str:
    """Digest of the vocabulary file and the version of the library that applies it."""
    from importlib.metadata import version

    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"{library} {version(library)}".encode()).hexdigest()


def _first_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops repeats of a content that this task has already sent on."""
    seen: set[bytes] = set()
    for batch in batches:
        mask = []
        for key in batch.column("content").to_pylist():
            mask.append(key not in seen)
            seen.add(key)
        yield batch.filter(pa.array(mask, pa.bool_()))


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in _first_in_task(batches):
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts = tokenizer.counts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("content").cast(pa.binary()), pa.array(counts, pa.int64())], ["content", "n_tokens"]
                )

    return run


def open_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per content even if two writers stored it."""
    spark.createDataFrame([], CACHE).write.mode("ignore").partitionBy("tokenizer").parquet(path)
    stored = spark.read.schema(CACHE).parquet(path).where(F.col("tokenizer") == version)
    return stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 1024, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    Texts are known by their SHA-256. Those without a stored count for this tokenizer version are
    encoded once each and appended to ``cache`` (a folder of Parquet files; without one, a new folder
    in the shared scratch space). Repeats are dropped in each task before the shuffle, so a text that
    a third of the rows have is sent once per task.

    A null text counts as empty: 0 bytes, 0 tokens. Null and repeated ids give a row each. An empty
    table gives no rows. Texts are encoded whole, of any length; other columns are ignored.
    """
    spark, version = docs.sparkSession, version_digest(tokenizer)
    cache = cache or scratch_path(spark, "token-counts")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("content")
    )
    known = open_cache(spark, cache, version)
    misses = (
        rows.select("content", "text").mapInArrow(_first_in_task, "content BINARY, text STRING")
        .repartition("content").join(known, "content", "left_anti")
    )
    (
        misses.mapInArrow(_encode(tokenizer), "content BINARY, n_tokens BIGINT")
        .withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    )
    counts = open_cache(spark, cache, version)
    sizes = rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "content")
    return sizes.join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

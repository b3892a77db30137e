"""Importance resampling toward a target distribution, on hashed n-grams found by overlapped scanning.

Separators are collapsed to single spaces; a pattern with look-arounds at word boundaries then runs over the
text with ``overlapped=True``, so that every match is one n-gram, whose bytes go to a CRC. Each text is scanned
once: its buckets and counts are stored, and totals, gains and weights are made from these.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.common import LOWER, UPPER
from tidemill.operators.ordering import asc, desc, number_rows
from tidemill.session import materialise

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Rows that one task puts in order; more are dealt over ranges of scores.
RANKED_ROWS = 50_000
# Bytes of texts that are scanned before their counts are sent on, and n-grams whose bucket is remembered.
SLICE_BYTES = 8 << 20
MEMO = 300_000
# What stands between words, as in the contract's pattern.
SEPARATORS = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLDED = str.maketrans(UPPER, LOWER)
FEATURES = "doc_id BIGINT, n_words BIGINT, n_features BIGINT, buckets ARRAY<INT>, counts ARRAY<BIGINT>"


def pattern(n: int) -> regex.Pattern:
    """Runs of ``n`` words in a text whose words are one space apart, one match from each word on."""
    return regex.compile(r"(?<![^ ])[^ ]++" + r"(?: [^ ]++)" * (n - 1) + r"(?![^ ])")


def collapsed(text: str) -> str:
    return SEPARATORS.sub(" ", text.translate(_FOLDED)).strip(" ")


class Buckets(dict):
    """Bucket of an n-gram: the CRC of its bytes; remembered, within bounds, as n-grams repeat."""

    def __init__(self, buckets: int):
        self._buckets = buckets

    def __missing__(self, gram: str) -> int:
        found = zlib.crc32(gram.encode()) % self._buckets
        if len(self) >= MEMO:
            self.clear()
        if len(gram) < 64:
            self[gram] = found
        return found


def counted(text: str, patterns: list[regex.Pattern], buckets: Buckets) -> tuple[int, Counter]:
    """Number of words, and how often each bucket occurs in the text."""
    text = collapsed(text)
    found: Counter = Counter()
    for p in patterns:
        for gram, n in Counter(m.group() for m in p.finditer(text, overlapped=True)).items():
            found[buckets[gram]] += n
    return (text.count(" ") + 1 if text else 0), found


def _scan(shortest: int, longest: int, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, buckets = [pattern(n) for n in range(shortest, longest + 1)], Buckets(n_buckets)
        ids, words, sizes, keys, counts, held = [], [], [], [], [], 0

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(keys, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64())),
            ], ["doc_id", "n_words", "n_features", "buckets", "counts"])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                n_words, found = counted(text, patterns, buckets)
                ids.append(key.as_py())
                words.append(n_words)
                sizes.append(found.total())
                keys.append(list(found))
                counts.append(list(found.values()))
                held += len(text)
                if held >= SLICE_BYTES:
                    yield sent()
                    ids, words, sizes, keys, counts, held = [], [], [], [], [], 0
        if ids:
            yield sent()

    return run


def features(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 1, longest: int = 1,
    buckets: int = BUCKETS,
) -> DataFrame:
    """For each row its id, its number of words and of n-grams of ``shortest`` to ``longest`` words, and how often each
    hashed bucket occurs. Null and empty texts have none; texts are scanned whole."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scan(shortest, longest, buckets), FEATURES)


def _summed(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(n_buckets, np.int64)
        for batch in batches:
            keys, counts = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
            np.add.at(totals, keys, counts)
        held = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(totals[held])], ["bucket", "n"])

    return run


def bucket_totals(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all rows; each task sends on one row per bucket at most."""
    sums = found.select("buckets", "counts").mapInArrow(_summed(buckets), "bucket INT, n BIGINT")
    return sums.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket: a thousand times the log of its smoothed share in the target over that in the source,
    rounded down. One row per bucket, a number fixed by the parameter, comes to the driver from either side; a side
    without features has the same share for all buckets."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for side, totals in ((s, source), (t, target)):
        for bucket, n in totals.collect():
            side[bucket] = n
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(gain_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = batch.column(3), batch.column(4)
            parts = gain_of[keys.flatten().to_numpy(zero_copy_only=False)] * counts.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(keys.value_lengths().to_numpy(zero_copy_only=False))
            sums = np.concatenate([[0], np.cumsum(parts)])
            weights = sums[ends] - sums[np.concatenate([[0], ends[:-1]]).astype(np.int64)] if len(ends) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    return run


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
    shortest: int = 1, longest: int = 1, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for each row of ``docs``, all long.

    A row's weight is the sum of the gains of its n-grams; its score adds Gumbel noise drawn from the seed and the id,
    so that the highest scores are a weighted draw without replacement. ``percent`` of the rows with at least
    ``least_words`` words are drawn; ``rank`` counts them from 1 by falling score, then by smaller id, null ids last,
    and is null for the others. Rows that are alike in all of this are ranked in any order.

    Null and empty texts have no features and weight 0. A null id counts as the empty text in the noise. Repeated
    rows give a row each. An empty target or table makes every gain of that side's buckets alike; no documents, no
    rows. Other columns are ignored.
    """
    scan = {"shortest": shortest, "longest": longest, "buckets": buckets}
    found = materialise(features(docs, id_col, text_col, **scan), "resampling-features")
    wanted = features(target.select(F.lit(None).cast("bigint").alias("id"), F.col(target_text).alias("text")), "id", "text", **scan)
    gain_of = gains(bucket_totals(found, buckets), bucket_totals(wanted, buckets), buckets)
    weighed = found.mapInArrow(_weigh(gain_of), "doc_id BIGINT, n_words BIGINT, n_features BIGINT, weight BIGINT")
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(draw, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(share))).cast("bigint")
    scored = weighed.select(
        "doc_id", "n_features", "weight", (F.col("weight") + noise).alias("score"), (F.col("n_words") >= least_words).alias("_able"),
    )
    drawn = found.where(F.col("n_words") >= least_words).count() * percent // 100
    order = [desc("_able"), desc("score"), asc("doc_id"), asc("n_features"), asc("weight")]
    ranked = number_rows(scored, order, name="_place", max_group_rows=RANKED_ROWS)
    rank = F.when(F.col("_able") & (F.col("_place") <= drawn), F.col("_place")).cast("bigint")
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))

"""Removal of repeated passages by prefix-partitioned suffix trees.

A window is twenty words in a row. Each window holds one anchor, the run of six words with the smallest
hash in it, so equal windows have equal anchors at equal places: only suffixes around anchors that
occur more than once can repeat. They are split by a prefix of variable length: the anchor's six words,
or, where that prefix is too frequent for memory, all twenty. Prefixes are grouped into bins that fit
into memory; in each the suffixes are put in the order of the tree's leaves, neighbours are compared
(the depths of the nodes between them), and nodes twenty words deep are the repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm.shingles import WordHashes, runs
from tidemill.session import materialise

WINDOW = 20
ANCHOR = 6
BIN_ROWS = 40_000  # suffix groups in one tree
FREQUENT = 4_000  # occurrences of a short prefix from which it is lengthened
GROUP_WORDS = 400_000  # words of short texts hashed together
_PLACE_BITS = 24


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def anchors(hashes: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``anchor`` words, and for each window the place of its anchor: the run of
    smallest hash, the first of equal ones, so that only the window's words decide."""
    grams, inside = runs(hashes, anchor), window - anchor + 1
    n = len(hashes) - window + 1
    if n <= 0:
        return grams, np.zeros(0, np.int64)
    bits = np.uint64(_PLACE_BITS)
    found = np.empty(n, np.int64)
    step = (1 << _PLACE_BITS) - window  # places in a piece fit into the low bits
    for at in range(0, n, step):
        piece = grams[at : min(n, at + step) + inside - 1]
        marked = (piece >> bits << bits) | np.arange(len(piece), dtype=np.uint64)
        found[at : at + step] = at + (_smallest(marked, inside) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    return grams, found


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


class _Texts:
    """Words of several texts one after the other, with the anchors of windows that lie in one text."""

    def __init__(self, texts: list[str | None], memo: WordHashes, window: int):
        parts = [_words(t) for t in texts]
        self.words = list(chain.from_iterable(parts))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.begins = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(parts)), sizes)
        self.grams, at = anchors(memo.of(self.words), window)
        self.starts = np.flatnonzero(owner[: len(at)] == owner[window - 1 :]) if len(at) else at
        self.at = at[self.starts]  # rises with the starts
        self.owner = owner


def _grouped(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about as many words as are hashed together; a long text is one of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)) // (6 * GROUP_WORDS)
    cuts = np.flatnonzero(np.diff(sizes)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def _anchor_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for part in _grouped(batch):
                texts = _Texts(part.column("text").to_pylist(), memo, window)
                at = texts.at[np.r_[True, texts.at[1:] != texts.at[:-1]]] if len(texts.at) else texts.at
                doc = texts.owner[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts.grams[at].view(np.int64)), *(part.column(n).take(pa.array(doc)) for n in ("no_id", "key", "version")),
                     pa.array((at - texts.begins[doc]).astype(np.int32))], ["prefix", "no_id", "key", "version", "at"],
                )

    return run


SUFFIXES = "prefix BIGINT, no_id BOOLEAN, key BIGINT, version BIGINT, start INT, words BINARY, deep BINARY"


def _suffix_rows(window: int):
    """Suffixes around the anchors that occur elsewhere: below a short prefix one row with all windows of
    the anchor, whose own words the prefix stands for; below a lengthened prefix, which is all of the
    window, a row per window, dealt further by salt."""
    schema = pa.schema([
        ("prefix", pa.int64()), ("no_id", pa.bool_()), ("key", pa.int64()), ("version", pa.int64()), ("start", pa.int32()),
        ("words", pa.binary()), ("deep", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for part in _grouped(batch):
                texts = _Texts(part.column("text").to_pylist(), memo, window)
                places, salts = part.column("places"), part.column("salts")
                doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(places).to_numpy(zero_copy_only=False))
                spots, salt = texts.begins[doc] + places.flatten().to_numpy(), salts.flatten().to_numpy()
                # a place counts in its own text only
                inside = np.flatnonzero(spots < len(texts.owner))
                inside = inside[texts.owner[spots[inside]] == doc[inside]]
                order = inside[np.unique(spots[inside], return_index=True)[1]]
                doc, spots, salt = doc[order], spots[order], salt[order]
                low, high = np.searchsorted(texts.at, spots), np.searchsorted(texts.at, spots, "right")
                held = low < high
                doc, spots, salt, low, high = doc[held], spots[held], salt[held], low[held], high[held]
                first, last = texts.starts[low], texts.starts[high - 1] + window
                joined = b" ".join(texts.words)
                offset = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts.words), np.int64, len(texts.words)) + 1)])
                begin = first - texts.begins[doc]
                short = np.flatnonzero(salt == 0)
                a, b = offset[first[short]].tolist(), offset[spots[short]].tolist()
                c, d = offset[spots[short] + ANCHOR].tolist(), (offset[last[short]] - 1).tolist()
                own = [joined[w:x] + b"\n" + (b" " + joined[y:z] if z > y else b"") for w, x, y, z in zip(a, b, c, d)]
                keys, nos, versions = (part.column(n) for n in ("key", "no_id", "version"))

                def out(prefix, rows, start, words, deep):
                    rows = pa.array(rows)
                    return pa.RecordBatch.from_arrays([
                        pa.array(prefix, pa.int64()), nos.take(rows), keys.take(rows), versions.take(rows), pa.array(start.astype(np.int32)),
                        pa.array(words, pa.binary()), pa.array(deep, pa.binary()),
                    ], schema=schema)

                yield out(texts.grams[spots[short]].view(np.int64), doc[short], begin[short], own, [None] * len(own))
                long = np.flatnonzero(salt)
                row = np.repeat(long, (high - low)[long])
                if len(row):
                    step = np.arange(len(row)) - np.repeat(np.cumsum((high - low)[long]) - (high - low)[long], (high - low)[long])
                    start = first[row] + step
                    deep = [hashlib.md5(joined[x:y]).digest() for x, y in zip(offset[start].tolist(), (offset[start + window] - 1).tolist())]
                    spread = (keys.take(pa.array(doc[row])).to_numpy() * 0x9E3779B1 >> 7) % salt[row]
                    mixed = np.frombuffer(b"".join(deep), np.int64)[::2] + spread * np.int64(0x1003F)
                    yield out(mixed, doc[row], start - texts.begins[doc[row]], [b""] * len(row), deep)

    return run


FOUND = "deep BINARY, no_id BOOLEAN, key BIGINT, version BIGINT, start INT, stop INT"


def repeats(prefix: np.ndarray, windows: np.ndarray, order_of: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of suffixes cut at window depth those that start earlier elsewhere, and the first of each node.

    ``prefix`` numbers the subtree, ``windows`` the words below it; ``order_of`` ranks places in the
    corpus, ``place`` numbers them. Suffixes are put in an order in which equal paths are
    neighbours (children of a node by hash): the leaves of the tree from left to right. The words
    that neighbours share are the depth of the node that joins them; nodes as deep as the
    window are the repeats.
    """
    depth = windows.shape[1]
    path = np.zeros(len(windows), np.uint64)
    half = path
    for k in range(depth):
        path = (path + windows[:, k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        path ^= path >> np.uint64(31)
        half = path if k == depth // 2 else half
    order = np.lexsort((order_of, path, half, prefix))
    leaves, tree = windows[order], prefix[order]
    same = leaves[1:] == leaves[:-1]
    shared = np.where(same.all(axis=1), depth, same.argmin(axis=1)) if len(same) else np.zeros(0, np.int64)
    first = np.r_[True, (shared < depth) | (tree[1:] != tree[:-1])]
    head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    repeated, heads = np.zeros(len(order), bool), np.zeros(len(order), bool)
    repeated[order] = place[order] != place[head]
    heads[order[first]] = True
    return repeated, heads


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def _tree(window: int):
    schema = pa.schema([
        ("deep", pa.binary()), ("no_id", pa.bool_()), ("key", pa.int64()), ("version", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()),
    ])
    width = window - ANCHOR + 1  # words of a window, its anchor being one

    def run(table: pa.Table) -> pa.Table:
        numbers = _Numbers()
        table = table.combine_chunks()
        deep = table.column("deep")
        long = pc.is_valid(deep).to_numpy()
        short, long = np.flatnonzero(~long), np.flatnonzero(long)
        words = table.column("words").take(pa.array(short)).to_pylist()
        flat = np.fromiter(map(numbers.__getitem__, b" ".join(words).split(b" ")), np.int64, sum(w.count(b" ") + 1 for w in words)) if words else np.zeros(0, np.int64)
        sizes = np.array([w.count(b" ") + 1 for w in words], np.int64)
        begins, counts = np.cumsum(sizes) - sizes, sizes - width + 1
        local = np.repeat(np.arange(len(sizes)), counts)
        step = np.arange(len(local)) - np.repeat(np.cumsum(counts) - counts, counts)
        windows = flat[(begins[local] + step)[:, None] + np.arange(width)] if len(local) else np.zeros((0, width), np.int64)
        row = np.concatenate([short[local], long])
        step = np.concatenate([step, np.zeros(len(long), np.int64)])
        windows = np.concatenate([windows, np.zeros((len(long), width), np.int64)])
        digests = np.array([numbers[d] for d in deep.take(pa.array(long)).to_pylist()], np.int64)
        subtree = np.unique(table.column("prefix").to_numpy()[short], return_inverse=True)[1]
        prefix = np.concatenate([subtree[local], len(sizes) + digests])
        no_id, key, version = (table.column(c).to_numpy()[row] for c in ("no_id", "key", "version"))
        start = table.column("start").to_numpy()[row] + step
        order = np.lexsort((start, version, key, no_id))
        moved = reduce(np.logical_or, (x[order][1:] != x[order][:-1] for x in (no_id, key, version, start)))
        rank, place = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        rank[order], place[order] = np.arange(len(order)), np.cumsum(np.r_[True, moved])
        repeated, heads = repeats(prefix, windows, rank, place)
        # neighbouring windows of one suffix group make one span
        at = np.flatnonzero(repeated)
        cut = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(row[at]) != 0)][: len(at)])
        a, b = at[cut], at[np.r_[cut[1:], len(at)][: len(cut)] - 1]
        # the first of a salt is still to be compared with those of the others
        firsts = np.flatnonzero(heads & (prefix >= len(sizes)))
        every, ends = np.concatenate([a, firsts]), np.concatenate([b, firsts])
        label = pa.concat_arrays([pa.nulls(len(a), pa.binary()), deep.take(pa.array(row[firsts])).combine_chunks().cast(pa.binary())])
        return pa.Table.from_arrays([
            label, pa.array(no_id[every]), pa.array(key[every]), pa.array(version[every]), pa.array(start[every].astype(np.int32)),
            pa.array((start[ends] + window).astype(np.int32)),
        ], schema=schema)

    return run


def _kept(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            names = ("text", "copy", "spans")
            for text, copy, spans in zip(*(batch.column(c).to_pylist() for c in names)):
                own = _words(text)
                if not spans and copy == 1:
                    out.append((len(own), 0, hashlib.sha256(b" ".join(own)).hexdigest(), text if with_text else None))
                    continue
                gone = np.zeros(len(own) + 1, np.int64)
                for s in spans or ():
                    gone[s["start"]] += 1
                    gone[s["stop"]] -= 1
                covered = np.cumsum(gone)[:-1] > 0
                if copy > 1 and len(own) >= window:
                    covered[:] = True
                removed = int(covered.sum())
                kept = b" ".join(w for w, c in zip(own, covered.tolist()) if not c) if removed else b" ".join(own)
                out.append((len(own), removed, hashlib.sha256(kept).hexdigest(), (text if not removed else kept.decode()) if with_text else None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *(pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.int64(), pa.int64(), pa.string(), pa.string())))],
                ["doc", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Each row of ``docs``, as struct ``doc`` of its columns but ``text``, with ``n_words, n_removed,
    kept_sha256, kept_text``: words covered by a window that also starts earlier are removed.

    Earlier is a smaller doc_id, or the same document and an earlier start; windows are judged on the
    input. Documents without an id come last, by a hash of their text; rows with the same id by that
    hash too; of rows alike in id and text the first is the original and the others repeat all of it. A null
    text has no words; texts shorter than a window lose nothing. ``kept_text`` (if asked for) is the text itself
    where nothing is removed, else the kept words with single spaces. An empty table gives no rows.
    """
    others = [c for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    version = F.xxhash64(text)
    rows = docs.select(
        F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("bigint"), version).alias("key"), version.alias("version"),
        F.struct(*(F.col(f"`{c}`") for c in others)).alias("doc"), F.col("text"),
    )
    own = ["no_id", "key", "version"]  # a text: rows of one id may have several
    spots = rows.select(*own, "text").mapInArrow(_anchor_rows(window), "prefix BIGINT, no_id BOOLEAN, key BIGINT, version BIGINT, at INT")
    often = materialise(spots.groupBy("prefix").count().where("count > 1"), "repeated-prefixes")
    salts = F.when(F.col("count") > FREQUENT, F.ceil(F.col("count") / FREQUENT)).otherwise(0).cast("int")
    often = often.select("prefix", salts.alias("salts"), "count")
    amount = often.agg(F.sum(F.when(F.col("salts") > 0, F.col("count") * 8).otherwise(F.col("count")))).first()[0] or 0
    bins = max(1, -(-amount // BIN_ROWS))
    places = (
        spots.join(often.select("prefix", "salts"), "prefix").groupBy(*own)
        .agg(F.collect_set(F.struct("at", "salts")).alias("spots"))
        .select(*own, F.col("spots.at").alias("places"), F.col("spots.salts").alias("salts"))
    )
    suffixes = rows.join(places, own).mapInArrow(_suffix_rows(window), SUFFIXES)
    found = suffixes.groupBy(F.pmod("prefix", F.lit(bins))).applyInArrow(_tree(window), FOUND)
    # of the first ones of all salts of a lengthened prefix only the very first is no repeat
    # (other rows are dealt by their document here, and pass)
    firsts = Window.partitionBy("deep", F.when(F.col("deep").isNull(), F.col("key"))).orderBy("no_id", "key", "version", "start")
    found = found.withColumn("leader", F.first(F.struct("no_id", "key", "version", "start")).over(firsts))
    spans = (
        found.where(F.col("deep").isNull() | (F.col("leader") != F.struct("no_id", "key", "version", "start")))
        .groupBy(*own).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )
    # by the keys of the joins, so that texts are dealt out once for all of them
    copy = F.row_number().over(Window.partitionBy(*own).orderBy("version"))
    result = rows.withColumn("copy", copy).join(spans, own, "left")
    kind = rows.schema["doc"].dataType.simpleString()
    return result.select("doc", "text", "copy", "spans").mapInArrow(
        _kept(window, with_text), f"doc {kind}, n_words BIGINT, n_removed BIGINT, kept_sha256 STRING, kept_text STRING"
    )

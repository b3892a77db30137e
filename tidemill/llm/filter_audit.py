"""What each text filter removes, alone and in every order, with duplicates found by radix tries.

A first pass judges every text by itself and inserts it into a compressed trie per block of texts, whose terminals
hold the smallest id: rows above it are duplicates at once, and each distinct text goes on with one id. These texts
are range-partitioned by prefixes that are lengthened until the texts under one fit into memory; below each prefix
a trie takes the full texts, and a traversal flags what has a smaller id elsewhere. What is left are masks of
failed filters, at most 32 for each part, from which all orders are counted.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemill.session import materialise

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
# Bytes of texts of a first trie, and about so many in a partition; below one prefix come fewer where that leaves at
# most so many long prefixes, so that a frequent beginning of texts is dealt over partitions.
BLOCK_BYTES, GROUP_BYTES, LONG_PREFIXES = 32 << 20, 1 << 20, 10_000
# Bytes of a prefix at first, and how much longer the next one is.
PREFIX, LONGER = 16, 4
# Fixed values of the failure conditions.
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 3
SYMBOLS, CAPITALS = re.compile(rb"[#$%&*|]"), b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
JUDGED = "doc_id BIGINT, part STRING, mask INT, n BIGINT"


class Node:
    """A trie node: the bytes that lead to it, its children by first byte and, at a terminal, the smallest id and
    the rows that end here."""

    __slots__ = ("label", "children", "least", "rows")

    def __init__(self, label: bytes):
        self.label, self.children, self.least, self.rows = label, {}, None, None


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


class RadixTrie:
    """Compressed trie over whole texts."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def insert(self, text: bytes, key: int | None, row: tuple) -> Node:
        """Adds a row under its text; the terminal keeps the smallest key (null keys do not count)."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.size += len(child.label)
            elif not text.startswith(child.label, at):
                shared = common(child.label, text[at : at + len(child.label)])
                upper = node.children[text[at]] = Node(child.label[:shared])
                child.label = child.label[shared:]
                upper.children[child.label[0]] = child
                child = upper
            node, at = child, at + len(child.label)
        if node.rows is None:
            node.rows = {}
        node.rows[row] = node.rows.get(row, 0) + 1
        if key is not None and (node.least is None or key < node.least):
            node.least = key
        return node

    def terminals(self) -> Iterator[tuple[bytes, Node]]:
        """Terminals with their whole texts."""
        open_nodes = [(self.root, b"")]
        while open_nodes:
            node, before = open_nodes.pop()
            text = before + node.label
            if node.rows:
                yield text, node
            open_nodes.extend((child, text) for child in node.children.values())


def own_mask(text: bytes, code_points: int) -> int:
    """Bits of the failure conditions that a text shows by itself."""
    words = text.split()  # at \\x20 and \\x09-\\x0D
    capitals = len(text) - len(text.translate(None, CAPITALS))
    failed = (
        len(words) < LEAST_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * len(words),
        100 * capitals > UPPER_PERCENT * code_points, SYMBOLS.search(text) is not None,
    )
    return sum(1 << i for i, f in enumerate(failed) if f)


def _judge(block_bytes: int):
    """Rows of known fate, without a text, and one row per distinct text of a block that may be met elsewhere."""

    def closed(trie: RadixTrie) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for text, node in trie.terminals():
            for (key, part, mask), n in node.rows.items():
                if key is None or key != node.least:
                    out.append((key, part, mask | (DUPLICATE if key is not None else 0), n, None))
                else:
                    out.append((key, part, mask, n, text))
                    held += len(text)
            if held > block_bytes // 4:
                yield packed(out)
                out, held = [], 0
        if out:
            yield packed(out)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays([*columns, pc.is_valid(columns[4])], ["doc_id", "part", "mask", "n", "text", "open"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = RadixTrie()
        for batch in batches:
            points = pc.utf8_length(batch.column(2)).to_pylist()
            texts = batch.column(2).cast(pa.binary())
            for i, (key, part) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                text = texts[i].as_py()
                trie.insert(text, key, (key, part, own_mask(text, points[i])))
                if trie.size > block_bytes:
                    yield from closed(trie)
                    trie = RadixTrie()
        yield from closed(trie)

    return run


def prefix_keys(texts: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Adds ``prefix``: the shortest of the tried lengths below which the texts fit into ``group_bytes``, or the longest
    if these are copies of one text, which share a terminal.

    Every length is counted on all texts that are still too many, so a group is as large as counted."""
    length, keyed = PREFIX, texts.withColumn("prefix", F.expr(f"substring(text, 1, {PREFIX})"))
    while True:
        under = keyed.where(F.octet_length("prefix") == length).groupBy("prefix").agg(
            F.sum(F.octet_length("text").cast("bigint")).alias("b"), F.max(F.octet_length("text")).alias("longest")
        )
        heavy = materialise(under.where((F.col("b") > group_bytes) & (F.col("longest") > length)).select(F.col("prefix").alias("_heavy")), "heavy-prefixes")
        if heavy.isEmpty():
            return keyed
        length *= LONGER
        joined = keyed.join(heavy, F.col("prefix") == F.col("_heavy"), "left")  # as broadcast if Spark finds it small
        keyed = joined.withColumn(
            "prefix", F.when(F.col("_heavy").isNotNull(), F.expr(f"substring(text, 1, {length})")).otherwise(F.col("prefix"))
        ).drop("_heavy")


def _flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A trie for each prefix in turn; rows come sorted by prefix."""

    def closed(trie: RadixTrie) -> list[tuple]:
        return [
            (key, part, mask | (DUPLICATE if key > node.least else 0), n * times)
            for _, node in trie.terminals() for (key, part, mask, n), times in node.rows.items()
        ]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "part", "mask", "n"])

    trie, now, out = RadixTrie(), None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for i, (key, part, mask, n) in enumerate(zip(*columns)):
            prefix = batch.column(5)[i].as_py()
            if prefix != now:
                out += closed(trie)
                trie, now = RadixTrie(), prefix
                if len(out) > 50_000:
                    yield packed(out)
                    out = []
            trie.insert(batch.column(4)[i].as_py(), key, (key, part, mask, n))
    out += closed(trie)
    if out:
        yield packed(out)


def masks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", group_bytes: int = GROUP_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, part, mask, n``: how many rows of an id fail just the filters of ``mask`` (bit 0 is A).

    A null text is the empty one, a null part the empty string. A row without an id is no duplicate of another, nor
    does it make another one a duplicate; rows of the same id and text are no duplicates of each other."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    judged = materialise(rows.mapInArrow(_judge(block_bytes), f"{JUDGED}, text BINARY, open BOOLEAN"), "judged-texts")
    texts = judged.where("open").drop("open")
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    group_bytes = max(group_bytes, min(block_bytes, size // LONG_PREFIXES))
    ranged = prefix_keys(texts, group_bytes).repartitionByRange(max(1, -(-size // block_bytes)), "prefix").sortWithinPartitions("prefix")
    flagged = ranged.select("doc_id", "part", "mask", "n", "text", "prefix").mapInArrow(_flag, JUDGED)
    return judged.where("NOT open").select("doc_id", "part", "mask", "n").unionByName(flagged)


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
    group_bytes: int = GROUP_BYTES, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` for each part and
    each step of each of the 120 orders of the filters, zeros included.

    An id that has several labels is good or toxic if any of them says so; one without a label is neither. Repeated
    rows count each. Parts are those of ``docs``; an empty table gives no rows. Texts are judged whole.
    """
    failed = masks(docs, id_col, text_col, part_col, group_bytes, block_bytes).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
    )
    counts = failed.join(known, F.col("doc_id") == F.col("_id"), "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    steps = [
        {"filter_order": "".join(order), "step": i + 1, "bit": 1 << FILTERS.index(f), "before": sum(1 << FILTERS.index(x) for x in order[:i])}
        for order in itertools.permutations(FILTERS) for i, f in enumerate(order)
    ]
    all_steps = F.from_json(F.lit(json.dumps(steps)), "ARRAY<STRUCT<filter_order: STRING, step: INT, bit: INT, before: INT>>")
    each = counts.select("*", F.explode(all_steps).alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    count = lambda which, n="n": F.sum(F.when(which, F.col(n)).otherwise(0)).cast("bigint")
    # of the orders of all filters, a failing one comes first of m failing ones in one of m
    share = F.when(fails, F.col("n") * F.expr("120 div bit_count(mask)")).otherwise(0)
    return each.groupBy("part", "filter_order", "step").agg(
        count(~fails & ~earlier).alias("kept"), count(fails & ~earlier).alias("removed"),
        count(fails & earlier).alias("redundant"), count(F.col("mask") == F.col("bit")).alias("unique_fails"),
        count(fails & ~earlier, "good").alias("good_lost"), count(fails & ~earlier, "toxic").alias("toxic_lost"),
        F.sum(share).cast("bigint").alias("shapley"),
    )

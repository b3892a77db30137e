"""Exact n-gram Jaccard join that skips by set relations.

Sets are word shingles. Equal sets are one vertex. An index by token (the smallest hashes of a set, in
one order for all) is kept in blocks by set size and with positions, so that whole blocks and entries
are skipped where size or position rules a link out. Sets found highly similar to a hub first take
over its answers: lists whose sets are all in one component are skipped whole, and only links between
components are searched further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.llm.common import WORD, text_bytes
from tidemill.llm.components import components
from tidemill.llm.shingles import WordHashes, runs
from tidemill.session import materialise

WORDS = 5
PERCENT = 80
HUB_ORDERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
SPREAD = 128  # classes of shingles, by which sets are counted to bound what two of them can share
LONG_LIST = 8  # entries from which a token counts as frequent and comes last in the order
# Tables are broadcast only if counted and at most so many narrow rows.
FEW_ROWS = 500_000
# Rows of whole texts in one Arrow batch to Python: a text may be some 100 KB, and a batch of Spark's usual
# 10,000 rows (two texts each, for pairs) would hold a worker's memory by the size of the texts.
TEXT_ROWS = 64
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def text_batches(spark, rows: int = TEXT_ROWS):
    """Within it, Arrow batches to Python hold at most ``rows`` rows; the setting before is restored after."""
    before = spark.conf.get(ARROW_ROWS, None)
    now = int(before) if before is not None else 10_000
    spark.conf.set(ARROW_ROWS, str(rows if now <= 0 else min(now, rows)))
    try:
        yield
    finally:
        spark.conf.unset(ARROW_ROWS) if before is None else spark.conf.set(ARROW_ROWS, before)


def shingle_set(text: str | None, memo: WordHashes, k: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``k`` lower-cased words; of a shorter text the whole sequence
    is the one shingle; without words there is none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if len(words) >= k:
        return np.unique(runs(memo.of(words), k))
    if not words:
        return np.zeros(0, np.uint64)
    return runs(memo.of(words), len(words)) ^ np.uint64(len(words) * 0xA24BAED4963EE407 % 2**64)


def prefix_size(n, percent: int = PERCENT):
    """Sets of Jaccard ``percent`` or more share one of each one's so many first tokens."""
    return n - -(-percent * n // 100) + 1


def region_size(n: int, percent: int = PERCENT) -> int:
    """Tokens indexed: the prefix, and some more to make up for frequent tokens moved last."""
    p = prefix_size(n, percent)
    return n if n <= 128 else min(n, p + 24 + p // 2)


def spread_of(own: np.ndarray) -> bytes:
    """How many shingles of a set fall into each class, in as few bytes as hold the largest number."""
    n = np.bincount((own & np.uint64(SPREAD - 1)).astype(np.int64), minlength=SPREAD)
    return n.astype(np.uint8 if n.max() < 256 else np.uint32).tobytes()


def most_shared(a: bytes, b: bytes) -> int:
    """What two sets share at most: in each class the smaller count."""
    x, y = (np.frombuffer(s, np.uint8 if len(s) == SPREAD else np.uint32).astype(np.int64) for s in (a, b))
    return int(np.minimum(x, y).sum())


def _sets(shift: int, k: int, percent: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
        ("hubs", pa.list_(pa.int64())), ("region", pa.list_(pa.int64())), ("spread", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, out = batch.slice(at, 500), []
                for text in part.column("text"):
                    own = shingle_set(text.as_py(), memo, k)
                    if not len(own):
                        out.append((0, None, None, None, None))
                        continue
                    hubs = [(own * m).min().view(np.int64) for m in HUB_ORDERS]
                    region = (own[: region_size(len(own), percent)] >> np.uint64(shift)).view(np.int64)
                    out.append((len(own), hashlib.md5(own.tobytes()).digest(), hubs, region, spread_of(own)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("th"), *(pa.array(c, t) for c, t in zip(zip(*out), schema.types[2:]))], schema=schema
                )

    return run


def _linked(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, last, other = WordHashes(), None, None
        for batch in batches:
            mask, a_text, b_text = [], batch.column("text_a"), batch.column("text_b")
            for i, b in enumerate(batch.column("b").to_pylist()):
                if b != last:
                    last, other = b, shingle_set(b_text[i].as_py(), memo, k)
                own = shingle_set(a_text[i].as_py(), memo, k)
                common = len(np.intersect1d(own, other, assume_unique=True))
                mask.append(100 * common >= percent * (len(own) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    return run


def _may_link(percent: int):
    """Drops pairs whose sets cannot share enough by their counts per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("spread_a"), batch.column("spread_b")
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            needed = -(-percent * n // (100 + percent))
            small = (pc.binary_length(a).to_numpy() == SPREAD) & (pc.binary_length(b).to_numpy() == SPREAD)
            most = np.zeros(batch.num_rows, np.int64)
            places = np.flatnonzero(small)
            if len(places):
                x, y = (np.frombuffer(b"".join(c.take(pa.array(places)).to_pylist()), np.uint8).reshape(-1, SPREAD) for c in (a, b))
                most[places] = np.minimum(x, y).sum(axis=1, dtype=np.int64)
            for i in np.flatnonzero(~small):
                most[i] = most_shared(a[i].as_py(), b[i].as_py())
            yield batch.select(["a", "b"]).filter(pa.array(most >= needed))

    return run


def that_may_link(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` that can link by what the stored sets say, so that few texts have to be met again."""
    side = lambda c: sets.select(F.col("rid").alias(c), F.col("n").alias(f"n_{c}"), F.col("spread").alias(f"spread_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "n_a", "n_b", "spread_a", "spread_b").mapInArrow(_may_link(percent), "a BIGINT, b BIGINT")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a, b`` by row number) whose sets, made anew from the texts, link."""
    pairs = materialise(that_may_link(pairs, sets, percent), "pairs-to-verify")
    ends = materialise(
        pairs.select(F.col("a").alias("rid")).unionByName(pairs.select(F.col("b").alias("rid"))).distinct()
        .join(sets.select("rid", "doc_id", "th"), "rid"), "pair-ends",
    )
    few = ends.count() <= FEW_ROWS
    wanted = F.broadcast(ends) if few else ends
    rows = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    texts = rows.join(wanted, "th").where(F.col("_id").eqNullSafe(F.col("doc_id"))).select("rid", "text")
    a = texts.select(F.col("rid").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("rid").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    with text_batches(docs.sparkSession):
        return materialise(both.mapInArrow(_linked(k, percent), "a BIGINT, b BIGINT").distinct(), "links")


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Shared tokens that a link takes at least."""
    return F.ceil(percent * (a + b) / (100 + percent) - 1e-9)


def hub_pairs(sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Each set with the first set that has the same smallest hash, in four orders and by size class."""
    rows = sets.select("rid", "n", "hubs").join(reps.select("rid"), "rid", "left_semi")
    rows = rows.select("rid", "n", F.posexplode("hubs").alias("j", "least"))
    size = F.floor(F.log(F.col("n")) / np.log(100 / percent) + F.col("j") / len(HUB_ORDERS))
    rows = rows.withColumn("size", size)
    hubs = rows.groupBy("j", "least", "size").agg(F.min(F.struct("rid", "n")).alias("hub"), F.count("*").alias("m")).where("m > 1")
    pairs = rows.join(hubs, ["j", "least", "size"]).where(F.col("rid") != F.col("hub.rid"))
    return pairs.where(_sizes_fit(F.col("n"), F.col("hub.n"), percent)).select(F.col("rid").alias("a"), F.col("hub.rid").alias("b")).distinct()


def _marked_entries(marks: np.ndarray):
    """One row for each indexed token that the filter lets through."""
    bits = len(marks).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region = batch.column("region")
            sizes = pc.fill_null(pc.list_value_length(region), 0).to_numpy()
            tokens = region.flatten().to_numpy().view(np.uint64)
            slots = (tokens & np.uint64(len(marks) - 1)).astype(np.int64)
            at = np.flatnonzero(marks[slots] >> ((tokens >> np.uint64(bits)) & np.uint64(63)) & np.uint64(1))
            row = np.repeat(np.arange(batch.num_rows), sizes)[at]
            place = at - (np.cumsum(sizes) - sizes)[row]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[at].view(np.int64)), batch.column("rid").take(take), batch.column("n").take(take), pa.array(sizes[row].astype(np.int32)), pa.array(place.astype(np.int32))],
                ["token", "rid", "n", "r", "i"],
            )

    return run


def token_marks(tokens: DataFrame) -> np.ndarray:
    """A filter that lets all the tokens through, and few others: its size follows their number, up to 4 MB."""
    bits = min(19, max(4, (tokens.count() // 4).bit_length()))
    mark = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(token, {bits}) & 63L as int))")
    found = tokens.groupBy(F.col("token").bitwiseAND((1 << bits) - 1).alias("slot")).agg(F.bit_or(mark).alias("marks")).toArrow()
    marks = np.zeros(1 << bits, np.uint64)
    marks[found.column("slot").to_numpy()] = found.column("marks").to_numpy().view(np.uint64)
    return marks


def token_index(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Entries ``token, rid, n, r, i, p`` of the tokens that more than one different set has, for the first of equal sets:
    the set's size, the size of its region, the token's place, and the size of its prefix. ``members``: ``rid, component``.

    Most tokens are in one set only. They are found by token and a number of the set, and left out by a filter of bounded
    size where the sets are stored, so the regions themselves are never moved."""
    own = sets.where("n > 0").select(F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("bigint").alias("own"), F.explode("region").alias("token"))
    shared = own.groupBy("token").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low <> high")
    marks = token_marks(materialise(shared.select("token"), "shared-tokens"))
    entries = sets.where("n > 0").select("rid", "n", "region").mapInArrow(_marked_entries(marks), "token BIGINT, rid BIGINT, n BIGINT, r INT, i INT")
    p = F.col("n") - F.ceil(percent * F.col("n") / 100 - 1e-9) + 1
    index = entries.join(members.select("rid"), "rid", "left_semi")
    return materialise(index.select("token", "rid", "n", "r", "i", p.alias("p")), "index-entries")


def _in_several(entries: DataFrame) -> DataFrame:
    """Tokens with entries of more than one component; lists of one component are skipped whole."""
    lists = entries.groupBy("token").agg(F.count("*").alias("m"), F.min("component").alias("low"), F.max("component").alias("high"))
    return lists.where("low <> high").select("token", "m")


def star_pairs(index: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The first set of each component in a list with the first of the list, where they meet often. Whole
    components become one by these few pairs, before any are searched further."""
    first = index.join(members, "rid").groupBy("token", "component").agg(F.min(F.struct("rid", "n", "p")).alias("one"))
    hubs = first.groupBy("token").agg(F.min("one").alias("hub"))
    pairs = first.join(hubs, "token").where(F.col("one.rid") != F.col("hub.rid"))
    pairs = pairs.where(_sizes_fit(F.col("one.n"), F.col("hub.n"), percent))
    met = pairs.groupBy(F.col("one.rid").alias("a"), F.col("hub.rid").alias("b"), F.col("one.p").alias("p")).agg(F.count("*").alias("met"))
    return met.where("4 * met >= p").select("a", "b")


def index_pairs(index: DataFrame, members: DataFrame, percent: int, long_list: int) -> DataFrame:
    """All pairs of sets in different components that can link; none that does is missed.

    Sets that link share a token of their prefixes in the order by hash. Tokens with long lists come
    last in the order instead; a set whose region then holds too few others keeps the plain order,
    and so meets the long lists.
    """
    entries = index.join(members, "rid")
    tokens = materialise(_in_several(entries).select("token", (F.col("m") > long_list).alias("frequent")), "lists")
    index = materialise(entries.join(tokens, "token"), "lists-of-several")
    moved = index.where("frequent").groupBy("rid").agg(F.count("*").alias("f"))
    index = index.join(moved, "rid", "left").withColumn("f", F.coalesce("f", F.lit(0)))
    index = index.withColumn("plain", (F.col("r") < F.col("n")) & (F.col("p") + F.col("f") > F.col("r")) | (F.col("r") == F.col("n")) & (F.col("n") - F.col("f") < F.col("p")))
    index = index.where((F.col("i") < F.col("p")) | ~F.col("frequent") & (F.col("i") < F.col("p") + F.col("f")))
    index = index.withColumn("block", F.floor(F.log(F.col("n")) / np.log(100 / percent)))

    def side(name: str, rows: DataFrame) -> DataFrame:
        return rows.select("token", *(F.col(c).alias(f"{c}_{name}") for c in ("rid", "n", "component", "i", "p", "f", "plain", "block")))

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        near = F.explode(F.array(F.col("block_b") - 1, F.col("block_b"), F.col("block_b") + 1))
        both = side("a", left).withColumnRenamed("block_a", "block").join(side("b", right).withColumn("block", near), ["token", "block"])
        at_most = F.least("i_a", "i_b") + 1 + F.least(F.col("n_a") - F.col("i_a") - 1, F.col("n_b") - F.col("i_b") - 1)
        return both.where(
            (F.col("component_a") != F.col("component_b")) & _sizes_fit(F.col("n_a"), F.col("n_b"), percent)
            & (at_most >= _needed(F.col("n_a"), F.col("n_b"), percent))
        )

    usual, long = index.where("NOT frequent"), index.where(F.col("frequent") & (F.col("i") < F.col("p")))
    pairs = met(usual, usual).where("rid_a > rid_b").unionByName(
        met(long.where("plain"), long).where("NOT plain_b OR rid_a > rid_b")
    )
    shared = F.sum(((F.col("i_a") < F.col("p_a")) & (F.col("i_b") < F.col("p_b"))).cast("int"))
    rest = F.greatest(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b")) + F.least("f_a", "f_b")
    pairs = pairs.groupBy(F.greatest("rid_a", "rid_b").alias("a"), F.least("rid_a", "rid_b").alias("b")).agg(
        shared.alias("shared"), F.max(rest).alias("rest"), F.max(_needed(F.col("n_a"), F.col("n_b"), percent)).alias("needed")
    )
    return pairs.where("shared + rest >= needed").select("a", "b")


def _members(reps: DataFrame, links: DataFrame) -> DataFrame:
    """``rid, component`` of each distinct set by the links found so far."""
    found = reps.join(components(links), F.col("rid") == F.col("node"), "left")
    return materialise(found.select("rid", F.coalesce("component", "rid").alias("component")), "set-components")


def grouped(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, long_list: int = LONG_LIST) -> DataFrame:
    """``doc_id, th, rid, n, component`` for each row of ``docs``: hash of its text, a number of its own, size of
    its set, and the number that its component has (null without shingles)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    bits = min(62, max(24, int(np.ceil(np.log2(text_bytes(docs) / 25 + 2))) + 16))  # of a token: so many that few meet by chance
    sets = rows.mapInArrow(
        _sets(64 - bits, k, percent), "doc_id BIGINT, th BIGINT, n BIGINT, digest BINARY, hubs ARRAY<BIGINT>, region ARRAY<BIGINT>, spread BINARY"
    )
    with text_batches(docs.sparkSession):
        sets = materialise(sets.withColumn("rid", F.monotonically_increasing_id()), "shingle-sets")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first")
    reps = sets.where("n > 0").groupBy("digest").agg(first).select("digest", F.col("first.rid").alias("rid"))
    reps = materialise(reps, "distinct-sets")
    links = verified(hub_pairs(sets, reps, percent), sets, rows, k, percent)
    own = _members(reps, links)
    index = token_index(sets, own, percent)
    for find in (lambda: star_pairs(index, own, percent), lambda: index_pairs(index, own, percent, long_list)):
        links = links.unionByName(verified(find(), sets, rows, k, percent))
        own = _members(reps, links)
    of_set = reps.join(own, "rid").select("digest", "component")
    return sets.select("doc_id", "th", "rid", "n", "digest").join(of_set, "digest", "left").drop("digest")


def near_copies(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, long_list: int = LONG_LIST) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``: documents link when 100 * shared >=
    ``percent`` * all their shingles, and a component's id is the smallest doc_id reachable by links.

    Null and empty texts have no shingles and are components of their own. Rows without an id link as
    others do; their component's id is the smallest id there is in it, or null. Rows with equal texts
    or equal ids count each. No link between different sets is lost: hubs only save work. An
    empty table gives no rows.
    """
    found = grouped(docs, k, percent, long_list)
    ids = found.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    return found.join(ids, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, long_list: int = LONG_LIST) -> DataFrame:
    """Of each component of near copies one row, all columns: that with the smallest id (rows without an
    id last). Rows without shingles all stay."""
    kept = grouped(docs, k, percent, long_list).where("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid", "th")).alias("first")
    ).select(F.col("first.doc_id").alias("_tidemill_id"), F.col("first.th").alias("_tidemill_th"), F.lit(True).alias("_tidemill_kept"))
    of_text = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.withColumn("_tidemill_own", of_text)
    rows = rows.join(kept, (F.col("_tidemill_own") == F.col("_tidemill_th")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("_tidemill_id")), "left")
    rows = rows.withColumn("_tidemill_copy", F.row_number().over(Window.partitionBy("_tidemill_own", "doc_id").orderBy("_tidemill_own")))
    empty = F.col("text").isNull() | ~F.col("text").rlike(WORD)
    return rows.where(empty | F.col("_tidemill_kept") & (F.col("_tidemill_copy") == 1)).select(*(F.col(f"`{c}`") for c in docs.columns))

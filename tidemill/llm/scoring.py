"""Language-model scores by a probabilistic suffix tree over words.

Frequent words are symbols of their own, the others share symbols by their last letters. Contexts of
one or two symbols are kept where their next-symbol distribution diverges from that of the context one
symbol shorter; each kept distribution is smoothed by the shorter one's, and a symbol is scored in the
state of the longest kept suffix before it. Within its symbol a word has its share of the counts plus
one, so the root of the tree alone is the add-one model of single words.

Below that lies a tree over whole words, kept as a table: contexts of any words, up to ``longest`` of them as
the tree's order, with the counts of the words after them; each that passes the test is kept. Words go by
64-bit hashes of their bytes, made for a whole batch of texts at once, and so do contexts and pairs of
context and next word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.llm.common import text_bytes
from tidemill.session import materialise

DEPTH = 2
BITS = 8  # of a symbol
SYMBOLS = 1 << BITS
OWN = 128  # words with a symbol of their own, the most frequent
LONGEST = 3  # words in the longest context: the order of the tree
BLOCK_BYTES = 8 << 20  # texts scored together by one task
CHUNK_BYTES = 2 << 20  # texts hashed together
FETCH = 8192  # states whose distributions come to the driver at once, 1 KB each
_SLOT_BITS = 19  # 64 marks in each slot of the largest filter; full filters let more rows through to the joins
END = np.uint64(1)  # stands for the end of a text
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D
# White space of the contract, and A-Z in lower case.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS


@dataclass(frozen=True)
class Line:
    """The words of several texts in a row, each text with ends before it and one after: hashes, for each how many words
    or ends of its text are before it, a number made of its last two bytes, and where texts begin."""

    h: np.ndarray
    before: np.ndarray
    tail: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of(texts: list[bytes], pad: int = 1) -> Line:
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        lower, space = _LOWER[raw], _SPACE[raw]
        word = ~space
        first = np.flatnonzero(word & np.r_[True, space[:-1]]) if len(raw) else np.zeros(0, np.int64)
        last = np.flatnonzero(word & np.r_[space[1:], True]) if len(raw) else first
        up, down = _powers(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
        h = (sums[last + 1] - sums[first]) * down[first] + (last - first).astype(np.uint64)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = np.maximum(h ^ (h >> np.uint64(32)), np.uint64(2))
        tail = lower[last].astype(np.int64) << 8 | np.where(last > first, lower[np.maximum(last - 1, 0)], 0)
        ends = np.cumsum([len(t) + 1 for t in texts])
        done = np.searchsorted(first, ends)  # words up to the end of each text
        n = np.diff(np.r_[0, done])
        sizes = n + pad + 1
        starts = np.cumsum(sizes) - sizes
        flat, tails = np.full(sizes.sum(), END, np.uint64), np.zeros(sizes.sum(), np.int64)
        place = np.arange(len(first)) + np.repeat((pad + 1) * np.arange(1, len(texts) + 1) - 1, n)
        flat[place], tails[place] = h, tail
        return Line(flat, np.arange(len(flat)) - np.repeat(starts, sizes), tails, starts)


def lines(column: pa.Array | pa.ChunkedArray, pad: int = 1) -> Iterator[Line]:
    """A column of texts in chunks of bounded size, or of one long text; nulls are empty."""
    held, size = [], 0
    for text in column.cast(pa.binary()):
        held.append(text.as_py() or b"")
        size += len(held[-1])
        if size > CHUNK_BYTES or len(held) >= 10_000:
            yield Line.of(held, pad)
            held, size = [], 0
    if held:
        yield Line.of(held, pad)


class Symbols:
    """Symbol by word: 0 for the end, then the own ones, then by the last two bytes."""

    def __init__(self, own: tuple[int, ...]):
        self._own = np.sort(np.array(own, np.uint64))
        self._first = len(own) + 1

    def of(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        found = self._first + (tail * 40503 >> 3) % (SYMBOLS - self._first)
        if len(self._own):
            at = np.minimum(np.searchsorted(self._own, h), len(self._own) - 1)
            found = np.where(self._own[at] == h, at + 1, found)
        return np.where(h == END, 0, found)


def contexts(symbols: np.ndarray) -> np.ndarray:
    """For each symbol, those before it as one number, the latest in the lowest place."""
    code = np.zeros(len(symbols), np.int64)
    for back in range(1, DEPTH + 1):
        code[back:] |= symbols[:-back] << (BITS * (back - 1))
    return code


class Sums:
    """Counts by key, sent on when there are too many to hold; what belongs to a key comes with it."""

    def __init__(self, names: list[str], most: int = 2_000_000):
        self._names, self._most, self._parts, self._size = names, most, [], 0

    def add(self, n: np.ndarray, key: np.ndarray, *more: np.ndarray) -> Iterator[pa.RecordBatch]:
        self._parts.append((key, *more, n))
        self._size += len(key)
        if self._size > self._most:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._parts:
            key, *more, n = (np.concatenate(c) for c in zip(*self._parts))
            self._parts, self._size = [], 0
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(key) else order
            at = order[first]
            sums = np.add.reduceat(n[order], first) if len(first) else n
            arrays = [pa.array(c[at].view(np.int64)) for c in (key, *more)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sums.astype(np.int64))], [*self._names, "n"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = Sums(["word", "tail"])
    for batch in batches:
        for line in lines(batch.column("text"), 0):
            key, first, n = np.unique(line.h, return_index=True, return_counts=True)
            yield from sums.add(n, key, line.tail[first])
    yield from sums.rest()


def _symbol_masses(own: tuple[int, ...]):
    """Counts plus one of the known words, summed by symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(own)
        for batch in batches:
            word, tail, c = (batch.column(n).to_numpy() for n in ("word", "tail", "c"))
            sums = np.bincount(symbols.of(word.view(np.uint64), tail), weights=c + 1.0, minlength=SYMBOLS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(SYMBOLS)), pa.array(sums)], ["symbol", "mass"])

    return run


def _code_counts(own: tuple[int, ...]):
    """Counts of symbols after contexts, as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, sums = Symbols(own), Sums(["code"], 4_000_000)
        for batch in batches:
            for line in lines(batch.column("text"), DEPTH):
                found = symbols.of(line.h, line.tail)
                codes, n = np.unique((contexts(found) << BITS | found)[line.before >= DEPTH], return_counts=True)
                yield from sums.add(n, codes)
        yield from sums.rest()

    return run


@dataclass(frozen=True)
class Tree:
    """``kept``: (depth, context) of each state after the root; ``logp``: log10 of the next symbol by
    state, which is broadcast once; ``mass``: counts plus one of each symbol's words, and one for its unknown ones."""

    name: str
    own: tuple[int, ...]
    kept: np.ndarray
    table: Broadcast
    mass: np.ndarray

    @property
    def logp(self) -> np.ndarray:
        return self.table.value

    def state_of(self) -> np.ndarray:
        """The longest kept suffix of every context: the tree as a table of 256 x 256 places."""
        table = np.zeros(SYMBOLS**DEPTH, np.int32)
        for state, (depth, context) in enumerate(self.kept, 1):
            table.reshape(-1, SYMBOLS**depth)[:, context] = state
        return table


@dataclass(frozen=True)
class Model:
    """Counts of training words and contexts stay a table; the tree is small by its documented capacity."""

    train_tokens: int
    distinct: int
    tree: Tree
    states: DataFrame  # key, n, kinds: of contexts all occurrences and kinds of next words, of words and pairs the occurrences
    filters: list[tuple[np.ndarray, np.ndarray]]  # by length, of kept contexts and of those with longer ones


def grow_tree(counts: DataFrame, own: tuple[bytes, ...], mass: np.ndarray, least: int = 30, bits: float = 1.0) -> Tree:
    """``counts``: ``code, n``. A context of at least ``least`` occurrences is kept if the divergence of
    its next symbols from those of its suffix, times its occurrences, is above what its parameters cost
    (``bits`` times half the logarithm of all symbols each). Suffixes of kept contexts are kept too.
    Counts of the deepest contexts, up to 256 times 256 times 256, stay in tasks; their distributions are fetched
    ``FETCH`` states at a time, and are at most 67 MB.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    # one row per depth, context and next symbol
    places = reduce(DataFrame.unionByName, (
        counts.select(
            F.lit(d).alias("depth"), F.shiftright("code", BITS).bitwiseAND(SYMBOLS**d - 1).alias("context"),
            F.col("code").bitwiseAND(SYMBOLS - 1).alias("next"), "n",
        ) for d in range(DEPTH + 1)
    )).groupBy("depth", "context", "next").agg(F.sum("n").alias("n"))
    # a context has at most as many rows as there are symbols
    places = places.withColumn("total", F.sum("n").over(Window.partitionBy("depth", "context")))
    places = materialise(places.where((F.col("total") >= least) | (F.col("depth") == 0)), "tree-places")
    shorter = places.select(
        (F.col("depth") + 1).alias("depth"), F.col("context").alias("suffix"), "next", F.col("n").alias("sn"), F.col("total").alias("stotal")
    )
    suffix = F.col("context") % F.pow(F.lit(SYMBOLS), F.col("depth") - 1).cast("bigint")
    gain = F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / (F.col("sn") / F.col("stotal"))))
    gains = (
        places.where("depth > 0").withColumn("suffix", suffix).join(shorter, ["depth", "suffix", "next"])
        .groupBy("depth", "context").agg(gain.alias("gain"), F.count("*").alias("symbols"))
    )
    cost = bits * 0.5 * float(np.log(max(total, 2)))
    kept = gains.where(F.col("gain") > F.col("symbols") * cost).select("depth", "context").collect()
    states = sorted({(d, r["context"] % SYMBOLS**d) for r in kept for d in range(1, r["depth"] + 1)})
    spark, kept_array = counts.sparkSession, np.array(states, np.int64).reshape(-1, 2)
    short = [s for s in states if s[0] < DEPTH]
    named = spark.createDataFrame([(0, 0, 0), *((i, *s) for i, s in enumerate(states, 1))], "state INT, depth INT, context BIGINT")
    rows = places.join(F.broadcast(named), ["depth", "context"])
    p = _smoothed(short, rows.where(F.col("depth") < DEPTH).select("depth", "context", "next", "n").toPandas(), mass / mass.sum())
    logp = np.zeros((1 + len(states), SYMBOLS), np.float32)
    logp[: len(p)] = np.log10(p)
    if len(short) < len(states):
        # a context has one row for each symbol after it at most
        deep = rows.where(F.col("depth") == DEPTH).groupBy("state", "context").agg(F.collect_list(F.struct("next", "n")).alias("seen"))
        deep = materialise(deep.mapInArrow(_deepest(short, p), "state INT, logp BINARY"), "tree-states")
        for low in range(len(p), len(logp), FETCH):
            part = deep.where((F.col("state") >= low) & (F.col("state") < low + FETCH)).toArrow()
            for state, line in zip(part.column("state").to_numpy(), part.column("logp")):
                logp[state] = np.frombuffer(line.as_py(), np.float32)
    return Tree(uuid.uuid4().hex, own, kept_array, spark.sparkContext.broadcast(logp), mass)


def _smoothed(states: list[tuple[int, int]], rows, root: np.ndarray) -> np.ndarray:
    """Each state's counts mixed with its suffix's distribution, by the number of symbols seen after it."""
    number = {s: i for i, s in enumerate(states, 1)} | {(0, 0): 0}
    counts = np.zeros((len(number), SYMBOLS))
    at = [number[d, c] for d, c in zip(rows["depth"], rows["context"])]
    np.add.at(counts, (at, rows["next"].to_numpy(int)), rows["n"].to_numpy(float))
    p = np.empty_like(counts)
    p[0] = root
    for (depth, context), i in sorted(number.items()):
        if depth:
            kinds = max(1, np.count_nonzero(counts[i]))
            p[i] = (counts[i] + kinds * p[number[depth - 1, context % SYMBOLS ** (depth - 1)]]) / (counts[i].sum() + kinds)
    return p


def _deepest(short: list[tuple[int, int]], p: np.ndarray):
    """The same for the deepest states, each from its own row; ``p`` has the root and the ``short`` states."""
    of_suffix = np.zeros(SYMBOLS ** (DEPTH - 1), np.int64)
    for i, (depth, context) in enumerate(short, 1):
        if depth == DEPTH - 1:
            of_suffix[context] = i

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                seen = part.column("seen")
                nexts, n = (c.to_numpy(zero_copy_only=False) for c in seen.flatten().flatten())
                counts = np.zeros((part.num_rows, SYMBOLS))
                counts[np.repeat(np.arange(part.num_rows), seen.value_lengths().to_numpy()), nexts] = n
                kinds = np.maximum(1, np.count_nonzero(counts, axis=1))[:, None]
                suffix = of_suffix[part.column("context").to_numpy() % len(of_suffix)]
                found = (counts + kinds * p[suffix]) / (counts.sum(axis=1)[:, None] + kinds)
                lines = [line.tobytes() for line in np.log10(found).astype(np.float32)]
                yield pa.RecordBatch.from_arrays([part.column("state"), pa.array(lines, pa.binary())], ["state", "logp"])

    return run


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _FACTOR + b
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return ~_joined(context, word)


def _single(word: np.ndarray) -> np.ndarray:
    """The pair of the empty context and a word: the key of its own count."""
    return _pair(np.zeros_like(word), word)


def _marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a filter lets hashes through; its length is a power of two."""
    bits = len(marks).bit_length() - 1
    slots = (hashes & np.uint64(len(marks) - 1)).astype(np.int64)
    return (marks[slots] >> ((hashes >> np.uint64(bits)) & np.uint64(63)) & np.uint64(1)).astype(bool)


def _marks(rows: DataFrame, name: str) -> np.ndarray:
    """A filter that lets all hashes of the column through, and few others; its size follows their number, up to 4 MB."""
    bits = min(_SLOT_BITS, max(4, (rows.count() // 4).bit_length()))
    slot = F.col(name).bitwiseAND((1 << bits) - 1)
    mark = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({name}, {bits}) & 63L as int))")
    found = rows.groupBy(slot.alias("slot")).agg(F.bit_or(mark).alias("marks")).toArrow()
    marks = np.zeros(1 << bits, np.uint64)
    marks[found.column("slot").to_numpy()] = found.column("marks").to_numpy().view(np.uint64)
    return marks


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _single(batch.column("word").to_numpy().view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(keys), batch.column("c")], ["word", "key", "n"])


def _context_counts(frequent: np.ndarray, twos: np.ndarray | None, filters: list[tuple[np.ndarray, np.ndarray]]):
    """Counts of words after contexts one word longer than the last filter's; ``below`` is the pair of the
    suffix with the same word. A context can only occur often enough if its words do, and each two in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, depth = Sums(["key", "ctx", "below"]), len(filters) + 1
        for batch in batches:
            for line in lines(batch.column("text")):
                h, at = line.h, np.flatnonzero(line.before >= depth)
                at = at[_marked(frequent, h[at - depth])]
                for d in range(1, depth):
                    one = _joined(np.zeros(len(at), np.uint64), h[at - d - 1])
                    at = at[_marked(twos, _pair(one, h[at - d]))]
                ctx = np.zeros(len(at), np.uint64)
                for d, (_, open_) in enumerate(filters, 1):
                    ctx = _joined(ctx, h[at - d])
                    held = _marked(open_, ctx)
                    at, ctx = at[held], ctx[held]
                longer = _joined(ctx, h[at - depth])
                key, first, n = np.unique(_pair(longer, h[at]), return_index=True, return_counts=True)
                yield from sums.add(n, key, longer[first], _pair(ctx[first], h[at[first]]))
        yield from sums.rest()

    return run


def grow_words(
    rows: DataFrame, counts: DataFrame, total: int, least: int = 30, bits: float = 1.0, longest: int = LONGEST,
) -> tuple[DataFrame, list[tuple[np.ndarray, np.ndarray]]]:
    """All word contexts of up to ``longest`` words that pass the test of ``grow_tree``, however many.

    Longer contexts are counted where one can still pass: what all of them together gain over a context
    is at most its occurrences times the entropy of its next words, which must exceed the cost of one.
    """
    cost = bits * 0.5 * float(np.log(max(total, 2)))
    single = materialise(counts.mapInArrow(_word_keys, "word BIGINT, key BIGINT, n BIGINT"), "lm-word-keys")
    frequent, twos, filters = _marks(single.where(F.col("n") >= least), "word"), None, []
    states = single.limit(0).select("key", "n", F.col("n").alias("kinds"))
    level = single.select("key", "n", F.lit(total).cast("bigint").alias("total"))
    gain = F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / (F.col("sn") / F.col("stotal"))))
    passes, opens = F.col("gain") > F.col("kinds") * cost, F.col("total") * F.log("total") - F.col("spread") > cost
    of_context = Window.partitionBy("ctx")
    while len(filters) < longest:
        found = rows.mapInArrow(_context_counts(frequent, twos, list(filters)), "key BIGINT, ctx BIGINT, below BIGINT, n BIGINT")
        # dealt by context once, for the sums by pair and by context; tasks have summed theirs before
        found = found.repartition("ctx").groupBy("ctx", "key", "below").agg(F.sum("n").alias("n")).select(
            "*", F.sum("n").over(of_context).alias("total"), F.count("*").over(of_context).alias("kinds"),
            F.sum(F.col("n") * F.log("n")).over(of_context).alias("spread"),
        )
        found = materialise(found.where(F.col("total") >= least), "lm-contexts")
        if twos is None:
            twos = _marks(found.where(F.col("n") >= least), "key")
        shorter = level.select(F.col("key").alias("below"), F.col("n").alias("sn"), F.col("total").alias("stotal"))
        tested = found.join(shorter, "below").groupBy("ctx", "total", "kinds", "spread").agg(gain.alias("gain"))
        last = len(filters) + 1 == longest
        tested = tested.select("ctx", "total", "kinds", passes.alias("kept"), (F.lit(False) if last else opens).alias("open"))
        tested = materialise(tested.where("kept OR open"), "lm-tested")
        if tested.isEmpty():
            return states, filters
        pairs = materialise(found.join(tested.select("ctx", "kept", "open"), "ctx").select("key", "n", "total", "kept", "open"), "lm-pairs")
        states = states.unionByName(pairs.where("kept").select("key", "n", F.lit(0).cast("bigint").alias("kinds")))
        states = states.unionByName(tested.where("kept").select(F.col("ctx").alias("key"), F.col("total").alias("n"), "kinds"))
        level = pairs.where("open").select("key", "n", "total")
        filters.append((_marks(tested.where("kept"), "ctx"), _marks(tested.where("open"), "ctx")))
        if not filters[-1][1].any():
            break
    return states, filters


def fit(docs: DataFrame, keep: Column | None = None, longest: int = LONGEST, **tree) -> Model:
    """Counts over all texts of ``docs`` for which ``keep`` holds; null texts count as empty."""
    rows = (docs if keep is None else docs.where(keep)).select("text")
    counts = rows.mapInArrow(_word_counts, "word BIGINT, tail BIGINT, n BIGINT").groupBy("word").agg(F.min("tail").alias("tail"), F.sum("n").alias("c"))
    counts = materialise(counts, "lm-words")
    sums = counts.agg(F.sum("c").alias("tokens"), F.count("*").alias("distinct")).first()
    first = counts.where(F.col("word") != int(END)).orderBy(F.desc("c"), "word").limit(OWN).collect()
    own = tuple(r["word"] % (1 << 64) for r in first)
    mass = np.ones(SYMBOLS)
    for r in counts.mapInArrow(_symbol_masses(own), "symbol BIGINT, mass DOUBLE").groupBy("symbol").agg(F.sum("mass").alias("mass")).collect():
        mass[r["symbol"]] += r["mass"]
    codes = materialise(rows.mapInArrow(_code_counts(own), "code BIGINT, n BIGINT").groupBy("code").agg(F.sum("n").alias("n")), "lm-codes")
    states, filters = grow_words(rows, counts, sums["tokens"] or 0, longest=longest, **tree)
    single = counts.mapInArrow(_word_keys, "word BIGINT, key BIGINT, n BIGINT").select("key", "n", F.lit(0).cast("bigint").alias("kinds"))
    return Model(sums["tokens"] or 0, sums["distinct"], grow_tree(codes, own, mass, **tree), states.unionByName(single), filters)


_LOADED: dict[str, tuple[np.ndarray, Symbols]] = {}


@dataclass(frozen=True)
class Known:
    """What a block needs of the table, by key."""

    keys: np.ndarray
    n: np.ndarray
    kinds: np.ndarray

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys and whether they are there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def counts(self, keys: np.ndarray) -> np.ndarray:
        at, there = self.find(keys)
        return np.where(there, self.n[at], 0).astype(float) if len(self.keys) else np.zeros(len(keys))


def tree_scores(line: Line, counts: np.ndarray, tree: Tree) -> np.ndarray:
    """log10 probability of each word and end of the texts, which have ``DEPTH`` ends before them; ``counts`` are theirs."""
    if tree.name not in _LOADED:  # one table per worker process
        _LOADED.clear()
        _LOADED[tree.name] = tree.state_of(), Symbols(tree.own)
    states, symbols = _LOADED[tree.name]
    found, scored = symbols.of(line.h, line.tail), line.before >= DEPTH
    each = tree.logp[states[contexts(found)], found][scored].astype(float)
    return each + np.log10((counts + 1) / tree.mass[found[scored]])


def word_scores(line: Line, pad: int, below: np.ndarray, known: Known, filters: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """``below`` carried on through the kept contexts of each word, shortest first. One of the ``pad`` ends before a text
    belongs to contexts."""
    h, at = line.h, np.flatnonzero(line.before >= pad)
    p, place, ctx = 10.0**below, np.arange(len(at)), np.zeros(len(at), np.uint64)
    for depth, (_, open_) in enumerate(filters, 1):
        deep = line.before[at] - (pad - 1) >= depth
        at, place, ctx = at[deep], place[deep], ctx[deep]
        ctx = _joined(ctx, h[at - depth])
        state, there = known.find(ctx)
        held = np.flatnonzero(there)
        state, spot = state[held], place[held]
        seen, n, kinds = known.counts(_pair(ctx[held], h[at[held]])), known.n[state], known.kinds[state]
        p[spot] = (seen + kinds * p[spot]) / (n + kinds)
        longer = _marked(open_, ctx)
        at, place, ctx = at[longer], place[longer], ctx[longer]
    return np.log10(p)


def _evidence(filters: list[tuple[np.ndarray, np.ndarray]]):
    """Keys of the distinct words of a block, and of its contexts and pairs that may be kept."""

    def run(table: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for line in lines(table.column("text")):
            h, at = line.h, np.flatnonzero(line.before > 0)
            found.append(np.unique(_single(h[at])))
            ctx = np.zeros(len(at), np.uint64)
            for depth, (kept, open_) in enumerate(filters, 1):
                deep = line.before[at] >= depth
                at, ctx = at[deep], ctx[deep]
                ctx = _joined(ctx, h[at - depth])
                held, longer = _marked(kept, ctx), _marked(open_, ctx)
                found.extend((np.unique(ctx[held]), np.unique(_pair(ctx[held], h[at[held]]))))
                at, ctx = at[longer], ctx[longer]
        keys = np.unique(np.concatenate(found)).view(np.int64)
        return pa.table({"block": pa.array(np.full(len(keys), table.column("block")[0].as_py(), np.int64)), "key": pa.array(keys)})

    return run


def _score_block(train_tokens: int, distinct: int, tree: Tree, filters: list[tuple[np.ndarray, np.ndarray]]):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64()),
    ])

    def run(docs: pa.Table, rows: pa.Table) -> pa.Table:
        keys = rows.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        known = Known(keys[order], *(rows.column(c).to_numpy()[order] for c in ("n", "kinds")))
        mass, parts = train_tokens + distinct + 1, []
        for line in lines(docs.column("text"), DEPTH):
            scored = line.before >= DEPTH
            counts = known.counts(_single(line.h[scored]))
            starts = line.starts - DEPTH * np.arange(len(line.starts))
            each = word_scores(line, DEPTH, tree_scores(line, counts, tree), known, filters)
            parts.append((
                np.diff(np.r_[starts, len(counts)]), np.add.reduceat((counts > 0).astype(np.int64), starts),
                np.add.reduceat(np.log10((counts + 1) / mass), starts), np.add.reduceat(each, starts),
            ))
        found = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0)] * 4
        return pa.Table.from_arrays(
            [docs.column("doc_id"), docs.column("held_out"), *(pa.array(c).cast(t) for c, t in zip(found, schema.types[2:]))], schema=schema
        )

    return run


def score(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row.

    Texts are dealt to blocks by a hash of the row; each block gets the counts of its own distinct
    words and contexts only, so neither is ever sent whole anywhere. A null or empty text is one token, its
    end. Null and repeated ids give a row each. With nothing to learn from, every symbol is equally
    likely and ``base_score`` is 0. An empty table gives no rows.
    """
    blocks = max(1, -(-text_bytes(docs) // BLOCK_BYTES))
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"), F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out.alias("held_out"), "text",
    )
    evidence = rows.groupBy("block").applyInArrow(_evidence(model.filters), "block BIGINT, key BIGINT")
    known = evidence.join(model.states, "key").select("block", "key", "n", "kinds")
    scored = rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _score_block(model.train_tokens, model.distinct, model.tree, model.filters),
        "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE",
    )
    return scored.withColumn("train_tokens", F.lit(model.train_tokens).cast("bigint"))

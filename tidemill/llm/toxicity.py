"""Toxicity by a weighted finite-state grammar over clauses.

A lexical transducer (a trie of stems) turns words into classes with weights; small machines for
negation, reported speech, targets and threats are composed into one table; clauses run through it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemill.llm.common import bounded_sample

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# Starting lexicon: plain words of the four languages of the corpus; fitting adds stems with weights.
INSULTS = (
    "idiot idiots moron morons scum trash worthless pathetic stupid loser losers disgusting clown imbecile dumb "
    "garbage filth vermin idiota estúpido basura imbécil asqueroso abschaum dummkopf trottel widerlich nutzlos "
    "stupide crétin ordure minable dégoûtant"
).split()
THREATS = "kill hurt destroy stab shoot beat burn murder matar töten umbringen tuer frapper".split()
FUNCTION_WORDS = {
    TARGET: "you your yours yourself u ur he she they them him her tu te ti usted vous toi du dich dir ihr euch",
    NEGATION: "not no never neither nor isn't aren't don't doesn't wasn't without nicht kein keine nie pas jamais sin nunca",
    REPORT: "said says say called calls wrote writes quoted quote claimed told reported sagte schrieb dit écrit dijo escribió",
}
CLASSES = {w: c for c, words in FUNCTION_WORDS.items() for w in words.split()}
WORD_IN_CLAUSE = re.compile(r"[^\W_]+(?:'[^\W_]+)*|[\"“”«»]")
QUOTES = "\"“”«»"
CLAUSE_END = re.compile(r"[.!?;:\n|]+")


@dataclass(frozen=True)
class Machine:
    """A transducer over word classes: ``step`` moves, ``factor`` weighs a hit read in a state, and
    ``closing`` is what a class adds for a hit that came just before."""

    states: int
    step: dict[tuple[int, int], int]
    factor: dict[tuple[int, int], float]
    closing: dict[tuple[int, int], float] = field(default_factory=dict)


def countdown(opener: int, reach: int, hits: dict[int, float], otherwise: dict[int, float] | None = None) -> Machine:
    """``opener`` puts the machine in state ``reach``; each other word takes one step down to 0."""
    step = {(s, c): reach if c == opener else max(0, s - 1) for s in range(reach + 1) for c in range(6)}
    factor = {(s, c): w for s in range(1, reach + 1) for c, w in hits.items()}
    factor |= {(0, c): w for c, w in (otherwise or {}).items()}
    return Machine(reach + 1, step, factor)


NEGATED = countdown(NEGATION, 3, {INSULT: 0.25, THREAT: 0.25})
REPORTED = Machine(
    2, {(s, c): int(s == 1 or c == REPORT) for s in (0, 1) for c in range(6)}, {(1, INSULT): 0.6, (1, THREAT): 0.4}
)
TARGETED = countdown(TARGET, 4, {INSULT: 1.5, THREAT: 1.0}, {THREAT: 0.3})
# an insult with the target after it ("pathetic, you are") gains as well
BEFORE_TARGET = Machine(
    3, {(s, c): 2 if c in (INSULT, THREAT) else max(0, s - 1) for s in range(3) for c in range(6)}, {},
    {(s, TARGET): 0.4 for s in (1, 2)},
)


@lru_cache(maxsize=1)
def composed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The product of all machines: next state, factor and closing weight by state and class."""
    machines = (NEGATED, REPORTED, TARGETED, BEFORE_TARGET)
    states = list(product(*(range(m.states) for m in machines)))
    number = {s: i for i, s in enumerate(states)}
    step = np.zeros((len(states), 6), int)
    factor, closing = np.ones((len(states), 6)), np.zeros((len(states), 6))
    for s, i in number.items():
        for c in range(6):
            step[i, c] = number[tuple(m.step[x, c] for m, x in zip(machines, s))]
            for m, x in zip(machines, s):
                factor[i, c] *= m.factor.get((x, c), 1.0)
                closing[i, c] += m.closing.get((x, c), 0.0)
    return step, factor, closing


def clause_score(tokens: list[tuple[int, float]]) -> tuple[float, float]:
    """Weight of insults and of threats in a clause given as (class, weight) pairs."""
    step, factor, closing = composed()
    state, sums, last = 0, [0.0, 0.0], 0.0
    for kind, weight in tokens:
        if kind in (INSULT, THREAT):
            last = weight * factor[state, kind]
            sums[kind - INSULT] += last
        elif kind == TARGET and closing[state, kind]:
            sums[0] += last * closing[state, kind]
        state = step[state, kind]
    return sums[0], sums[1]


@dataclass(frozen=True)
class Model:
    """``stems``: (stem, class, weight), a stem ending in ``$`` being a whole word; ``weights``: of
    the features, the last being the constant."""

    stems: tuple[tuple[str, int, float], ...]
    weights: tuple[float, ...] = ()


def _word_char(c: str) -> bool:
    return c.isalnum() or c == "_"


_AUTOMATA: dict[tuple, object] = {}


def automaton(model: Model):
    """The lexical transducer; one per worker process."""
    import ahocorasick

    if model.stems not in _AUTOMATA:
        _AUTOMATA.clear()
        trie = ahocorasick.Automaton()
        by_stem: dict[str, list] = {}
        for stem, kind, weight in model.stems:
            by_stem.setdefault(stem.rstrip("$"), []).append((stem.endswith("$"), kind, weight))
        for stem, entries in by_stem.items():
            trie.add_word(stem, (len(stem), entries))
        if len(trie):
            trie.make_automaton()
        _AUTOMATA[model.stems] = trie
    return _AUTOMATA[model.stems]


def hits(text: str, model: Model) -> dict[int, tuple[int, float]]:
    """Class and weight by start of word; the longest stem counts, a whole word before a stem."""
    trie, found = automaton(model), {}
    if not len(trie):
        return {}
    for end, (size, entries) in trie.iter(text):
        start = end - size + 1
        if start and _word_char(text[start - 1]):
            continue
        whole = end + 1 == len(text) or not _word_char(text[end + 1])
        for exact, kind, weight in entries:
            if exact and not whole:
                continue
            rank = (size, exact)
            if start not in found or rank > found[start][0]:
                found[start] = (rank, kind, weight)
    return {at: (kind, weight) for at, (_, kind, weight) in found.items()}


FEATURES = 6


def features(text: str | None, model: Model) -> tuple[float, ...]:
    """What is known of a text: sums, rate, strongest clause and number of scored clauses. All zero
    without a hit, so for null and empty texts."""
    text = (text or "").lower()
    found = hits(text, model)
    if not found:
        return (0.0,) * FEATURES
    ends = [m.start() for m in CLAUSE_END.finditer(text)]
    touched = sorted({bisect_left(ends, at) for at in found})
    insults = threats = strongest = 0.0
    for clause in touched:
        begin = ends[clause - 1] + 1 if clause else 0
        end = ends[clause] if clause < len(ends) else len(text)
        tokens = []
        for word in WORD_IN_CLAUSE.finditer(text, begin, end):
            if word.start() in found:
                tokens.append(found[word.start()])
            else:
                w = word.group()
                tokens.append((CLASSES.get(w, REPORT if w in QUOTES else OTHER), 0.0))
        a, b = clause_score(tokens)
        insults, threats, strongest = insults + a, threats + b, max(strongest, a + b)
    words = text.count(" ") + text.count("\n") + 1
    total = insults + threats
    return (
        math.log1p(total), math.log1p(1000.0 * total / words), math.log1p(strongest), math.log1p(len(touched)),
        math.log1p(threats), math.log1p(1000.0 * len(found) / words),
    )


WORDS = re.compile(r"[^\W_]+")


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and texts of every word and word beginning, by label."""
    for batch in batches:
        counts: dict[tuple[str, int], list[int]] = {}
        words_of = Counter()
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            own, texts = Counter(WORDS.findall((text or "").lower())), set()
            words_of[label] += sum(own.values())
            for word, n in own.items():
                for stem in {word[:k] for k in range(4, min(len(word), 12))} | {word + "$"}:
                    entry = counts.setdefault((stem, label), [0, 0])
                    entry[0] += n
                    entry[1] += stem not in texts
                    texts.add(stem)
        rows = [(s, label, n, d) for (s, label), (n, d) in counts.items()] + [("", label, n, 0) for label, n in words_of.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int64(), pa.int64()))] if rows
            else [pa.array([], t) for t in (pa.string(), pa.int32(), pa.int64(), pa.int64())],
            names=["stem", "label", "n", "texts"],
        )


def learn_stems(rows: DataFrame, least_texts: int = 6, least_gain: float = 1.5, most: int = 3000) -> list[tuple[str, int, float]]:
    """Words and beginnings of words that toxic texts have more often, with their log-odds.

    ``rows``: ``text, label``, a bounded sample. Of stems that occur in the same places the longest is
    kept, and otherwise a longer stem only where it says more than the shorter one it begins with. ``most`` bounds the lexicon, the strongest first.
    """
    counts = (
        rows.mapInArrow(_stem_counts, "stem STRING, label INT, n BIGINT, texts BIGINT").groupBy("stem")
        .agg(*(F.sum(F.when(F.col("label") == k, F.col(c)).otherwise(0)).alias(f"{c}{k}") for c in ("n", "texts") for k in (0, 1)))
    ).where((F.col("texts1") >= least_texts) | (F.col("stem") == ""))
    total = counts.where("stem = ''").first()
    if not total or not total["n0"] or not total["n1"]:
        return []
    gain = F.log((F.col("n1") + 0.5) / float(total["n1"])) - F.log((F.col("n0") + 0.5) / float(total["n0"]))
    strong = (
        counts.where("stem <> ''").withColumn("gain", gain).where((F.col("gain") >= least_gain) & (F.col("texts1") > F.col("texts0") / 2))
        .orderBy(F.desc(F.col("gain") * F.col("texts1")), "stem").limit(most).collect()
    )
    n1 = {r["stem"]: r["n1"] for r in strong}
    shadowed = {s.rstrip("$")[:-1] for s, n in n1.items() if n1.get(s.rstrip("$")[:-1]) == n}
    gains = {r["stem"]: r["gain"] for r in strong if r["stem"] not in shadowed}
    kept = []
    for stem, weight in gains.items():
        bare = stem.rstrip("$")
        shorter = max((gains[bare[:k]] for k in range(4, len(bare) + stem.endswith("$")) if bare[:k] in gains), default=0.0)
        if weight > shorter + 0.4:
            kept.append((stem, INSULT, float(weight)))
    return kept


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Newton's method; ``x`` has its constant column last."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, keep: Column, most: int) -> DataFrame:
    """``text, label`` of at most about ``most`` labelled documents for which ``keep`` holds.

    Of several labels for an id the largest counts; null labels and ids are left out. The sample's
    ids are few by construction, so they are broadcast and no text is moved.
    """
    known = (
        labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & keep)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    chosen = bounded_sample(known, F.col("doc_id"), most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


START = tuple((w + "$", INSULT, 5.0) for w in INSULTS) + tuple((w + "$", THREAT, 2.0) for w in THREATS)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", keep: Column | None = None, most: int = 20_000) -> Model:
    """Learns stems and feature weights from at most about ``most`` labelled documents.

    Without labels of both kinds, the starting lexicon with fixed weights is the model.
    """
    rows = labelled(docs, labels, label_col, F.lit(True) if keep is None else keep, most)
    learned = learn_stems(rows)
    known = {s for s, _, _ in learned}
    model = Model(tuple(learned) + tuple(s for s in START if s[0] not in known))
    sample = rows.mapInArrow(_features_of(model, ["label"]), "label INT, f ARRAY<DOUBLE>").toPandas()
    if sample["label"].nunique() < 2:
        return Model(model.stems, (1.0, 0.5, 0.5, 0.0, 0.0, 0.0, -5.0))
    x = np.c_[np.array(sample["f"].tolist()), np.ones(len(sample))]
    return Model(model.stems, tuple(fit_logistic(x, sample["label"].to_numpy(float))))


def _features_of(model: Model, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, model) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(found, pa.list_(pa.float64()))], [*carried, "f"]
            )

    return run


def with_score(rows: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``rows`` with the score of ``text`` (0 to 1) in one more column; nothing is joined or shuffled.

    Whole texts are scored. Null and empty texts get the score of a text without hits; an empty
    table gives no rows.
    """
    weights = np.array(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([features(t, model) for t in batch.column("text").to_pylist()]).reshape(-1, FEATURES)
            p = 1 / (1 + np.exp(-np.clip(found @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, column])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(column, T.DoubleType())]))

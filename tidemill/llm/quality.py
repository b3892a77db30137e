"""Text quality by a byte-level convolutional network in numpy.

Texts are cut into overlapping chunks that cover them whole. In each chunk two layers look for the
strongest place: learned filters over embedded bytes, and the agreement of bytes with those some
steps before, which shows repetition. Chunk maxima are averaged and maximised over the text and
combined into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemill.llm.toxicity import labelled

CHUNK, OVERLAP = 512, 64
EMBED, WIDTH, STRIDE, FILTERS = 6, 12, 4, 24
LAGS = tuple(range(2, 25))
HIDDEN = 16
PER_CHUNK = FILTERS + len(LAGS)
BATCH_CHUNKS = 2048  # chunks convolved at once: bounds memory whatever the texts' length


def chunks_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks as rows of bytes, padded with zeros, and the index of each chunk's text. A null or empty
    text is one chunk of zeros."""
    parts, owner, step = [], [], CHUNK - OVERLAP
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace")
        n = max(1, -(-(len(raw) - OVERLAP) // step))
        flat = np.zeros((n - 1) * step + CHUNK, np.uint8)
        flat[: len(raw)] = np.frombuffer(raw, np.uint8)
        parts.append(np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::step])
        owner.extend([i] * n)
    return np.concatenate(parts), np.array(owner)


def agreement(chunks: np.ndarray) -> np.ndarray:
    """Per chunk and lag, the largest share of 32 bytes in a row that equal the byte ``lag`` before."""
    found = np.zeros((len(chunks), len(LAGS)), np.float32)
    filled = chunks != 0
    for k, lag in enumerate(LAGS):
        same = np.zeros(chunks.shape, np.uint8)
        np.logical_and(chunks[:, lag:] == chunks[:, :-lag], filled[:, lag:], out=same[:, lag:].view(bool))
        eights = (same.view(np.uint64) * np.uint64(0x0101010101010101)) >> np.uint64(56)
        found[:, k] = (eights[:, :-3] + eights[:, 1:-2] + eights[:, 2:-1] + eights[:, 3:]).max(axis=1) / 32
    return found


class Network:
    """Weights, the forward pass and the gradient. Filters see ``WIDTH`` bytes every ``STRIDE``."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        self.w = {
            "embed": draw(256, EMBED, scale=0.5), "filter": draw(WIDTH * EMBED, FILTERS, scale=0.2),
            "filter_0": np.zeros(FILTERS, np.float32), "dense": draw(2 * PER_CHUNK, HIDDEN, scale=0.15),
            "dense_0": np.zeros(HIDDEN, np.float32), "out": draw(HIDDEN, scale=0.3), "out_0": np.zeros(1, np.float32),
        }
        self.w["embed"][0] = 0

    def _convolved(self, chunks: np.ndarray) -> np.ndarray:
        groups = self.w["embed"][chunks].reshape(len(chunks), CHUNK // STRIDE, STRIDE * EMBED)
        taps = self.w["filter"].reshape(WIDTH // STRIDE, STRIDE * EMBED, FILTERS)
        places = CHUNK // STRIDE - WIDTH // STRIDE + 1
        flat = groups.reshape(-1, STRIDE * EMBED)
        out = (flat @ taps[0]).reshape(len(chunks), -1, FILTERS)[:, :places]
        for k in range(1, len(taps)):
            out = out + (flat @ taps[k]).reshape(len(chunks), -1, FILTERS)[:, k : places + k]
        return out

    def chunk_vectors(self, chunks: np.ndarray, places: bool = False):
        """Maxima per chunk, and for training the places of the filters' maxima."""
        out = np.empty((len(chunks), PER_CHUNK), np.float32)
        where = np.empty((len(chunks), FILTERS), np.int32)
        for at in range(0, len(chunks), 256):
            conv = self._convolved(chunks[at : at + 256])
            if places:
                where[at : at + 256] = conv.argmax(axis=1)
            out[at : at + 256, :FILTERS] = np.maximum(conv.max(axis=1) + self.w["filter_0"], 0)
        out[:, FILTERS:] = agreement(chunks)
        return (out, where) if places else out

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(pooled @ self.w["dense"] + self.w["dense_0"], 0)
        return hidden, 1 / (1 + np.exp(-np.clip(hidden @ self.w["out"] + self.w["out_0"][0], -30, 30)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities of a batch of texts. A text of any length passes in groups of chunks."""
        total, most, n = np.zeros((len(texts), PER_CHUNK)), np.zeros((len(texts), PER_CHUNK), np.float32), np.zeros(len(texts))
        for group in _groups(texts):
            chunks, owner = chunks_of([texts[i] for i in group])
            for at in range(0, len(chunks), BATCH_CHUNKS):
                vectors, own = self.chunk_vectors(chunks[at : at + BATCH_CHUNKS]), np.array(group)[owner[at : at + BATCH_CHUNKS]]
                np.add.at(total, own, vectors)
                np.maximum.at(most, own, vectors)
                np.add.at(n, own, 1)
        return self.head(np.c_[total / np.maximum(n, 1)[:, None], most].astype(np.float32))[1]

    def gradient(self, chunks: np.ndarray, owner: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss, over texts with labels ``y``; ``owner`` is sorted and has every text."""
        w = self.w
        vectors, where = self.chunk_vectors(chunks, places=True)
        starts = np.searchsorted(owner, np.arange(len(y)))
        n = np.diff(np.append(starts, len(owner)))
        mean = np.add.reduceat(vectors, starts) / n[:, None]
        most = np.maximum.reduceat(vectors, starts)
        pooled = np.c_[mean, most]
        hidden, p = self.head(pooled)
        d_out = ((p - y) / len(y)).astype(np.float32)
        d_hidden = np.outer(d_out, w["out"]) * (hidden > 0)
        d_pooled = d_hidden @ w["dense"].T
        is_most = (vectors == most[owner]).astype(np.float32)
        is_most /= np.add.reduceat(is_most, starts)[owner]  # overlapping chunks may share a maximum
        d_vectors = (d_pooled[:, :PER_CHUNK] / n[:, None])[owner] + d_pooled[:, PER_CHUNK:][owner] * is_most
        d_conv = d_vectors[:, :FILTERS] * (vectors[:, :FILTERS] > 0)
        spots = where[:, :, None] * STRIDE + np.arange(WIDTH)
        seen = chunks[np.arange(len(chunks))[:, None, None], spots]  # chunk, filter, byte
        d_filter, d_embed = np.zeros_like(w["filter"]), np.zeros_like(w["embed"])
        for f in range(FILTERS):
            window = w["embed"][seen[:, f]].reshape(len(chunks), -1)
            d_filter[:, f] = window.T @ d_conv[:, f]
            np.add.at(d_embed, seen[:, f], (d_conv[:, f][:, None] * w["filter"][:, f]).reshape(len(chunks), WIDTH, EMBED))
        d_embed[0] = 0
        return {
            "embed": d_embed, "filter": d_filter, "filter_0": d_conv.sum(axis=0), "dense": pooled.T @ d_hidden,
            "dense_0": d_hidden.sum(axis=0), "out": hidden.T @ d_out, "out_0": np.array([d_out.sum()]),
        }


def _groups(texts: list[str | None], most_bytes: int = 4 << 20) -> Iterator[list[int]]:
    group, size = [], 0
    for i, text in enumerate(texts):
        group.append(i)
        size += len(text or "")
        if size >= most_bytes:
            yield group
            group, size = [], 0
    if group:
        yield group


def train(pieces: list[np.ndarray], labels: np.ndarray, epochs: int = 14, seed: int = 7) -> Network:
    """Adam on small batches of texts given as their chunks."""
    network, rng = Network(seed), np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    network.w["out_0"][0] = np.log(share / (1 - share))
    first = {k: np.zeros_like(v) for k, v in network.w.items()}
    second = {k: np.zeros_like(v) for k, v in network.w.items()}
    step = 0
    for epoch in range(epochs if 0 < y.sum() < len(y) else 0):
        rate = 4e-3 * (1 - epoch / epochs) + 2e-4
        order = rng.permutation(len(y))
        for at in range(0, len(y), 64):
            own = order[at : at + 64]
            chunks = np.concatenate([pieces[i] for i in own])
            owner = np.repeat(np.arange(len(own)), [len(pieces[i]) for i in own])
            step += 1
            for k, g in network.gradient(chunks, owner, y[own]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
                network.w[k] = (network.w[k] - rate * move).astype(np.float32)
    return network


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", keep: Column | None = None, most: int = 3000) -> Network:
    """Trains on at most about ``most`` labelled documents, of each at most ``per_text`` chunks.

    The chunks are cut on the executors, so the driver gets at most ``most * per_text`` chunks of
    512 bytes however long the texts are. Without labels of both kinds the share of label 1 is the score.
    """
    rows = labelled(docs, labels, label_col, F.lit(True) if keep is None else keep, most)
    sample = rows.mapInArrow(_spread, "label INT, pieces BINARY").orderBy("label", "pieces").toPandas()
    pieces = [np.frombuffer(p, np.uint8).reshape(-1, CHUNK) for p in sample["pieces"]]
    return train(pieces, sample["label"].to_numpy())


def _spread(batches: Iterator[pa.RecordBatch], per_text: int = 10) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text in batch.column("text").to_pylist():
            chunks, _ = chunks_of([text])
            found.append(chunks[np.unique(np.linspace(0, len(chunks) - 1, min(per_text, len(chunks))).astype(int))].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.binary())], ["label", "pieces"])


def with_score(rows: DataFrame, network: Network, column: str = "score") -> DataFrame:
    """``rows`` with the score of ``text`` (0 to 1) in one more column; nothing is joined or shuffled.

    Whole texts are scored; null and empty texts as one empty chunk. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = network.scores(batch.column("text").to_pylist()).astype(float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*batch.schema.names, column])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(column, T.DoubleType())]))

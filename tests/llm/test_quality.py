import numpy as np
import pytest

from tests.llm.helpers import documents
from tidemill.llm import quality as Q, queries


@pytest.mark.parametrize("size", [0, 1, 63, 511, 512, 513, 900, 5000, 300_000])
def test_chunks_cover_whole_texts(size):
    raw = "".join(chr(97 + i % 25) for i in range(size))
    chunks, owner = Q.chunks_of([raw, None])
    own, step = chunks[owner == 0], Q.CHUNK - Q.OVERLAP
    joined = own[0].tobytes() + b"".join(c[Q.OVERLAP :].tobytes() for c in own[1:])
    assert joined.rstrip(b"\0").decode() == raw and (owner == 1).sum() == 1
    assert len(own) == max(1, -(-(size - Q.OVERLAP) // step))


def test_agreement_shows_repetition():
    plain, again = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(512)), "word, " * 86
    a, b = Q.agreement(Q.chunks_of([plain, again])[0])[[0, 1]]
    assert b[Q.LAGS.index(6)] == 1.0 and a.max() < 0.6 and Q.agreement(Q.chunks_of([""])[0]).max() == 0


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(2)
    network = Q.Network(3)
    texts = ["".join(map(chr, rng.integers(97, 110, n))) for n in (700, 100, 1500)]
    chunks, owner = Q.chunks_of(texts)
    y = np.array([1.0, 0.0, 1.0], np.float32)

    def loss():
        vectors = network.chunk_vectors(chunks)
        pooled = np.array([np.r_[vectors[owner == i].mean(axis=0), vectors[owner == i].max(axis=0)] for i in range(3)])
        p = network.head(pooled)[1]
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    slopes = network.gradient(chunks, owner, y)
    for name in ("filter", "dense", "out", "filter_0", "dense_0", "out_0", "embed"):
        at = np.unravel_index(np.abs(slopes[name]).argmax(), slopes[name].shape)
        kept = network.w[name][at]
        network.w[name][at] = kept + 3e-4
        up = loss()
        network.w[name][at] = kept - 3e-4
        slope = (up - loss()) / 6e-4
        network.w[name][at] = kept
        assert slope == pytest.approx(slopes[name][at], rel=0.15, abs=2e-3), name


def test_scores_of_any_text(spark):
    docs = documents(spark, [(1, "fine words all along " * 20), (2, None), (3, ""), (None, "x"), (1, "é" * 200_000), (4, "|| ** " * 40)])
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (9, 0), (3, None)], "doc_id BIGINT, quality INT")
    network = Q.fit(docs, labels)
    got = Q.with_score(docs, network, "quality").collect()
    assert len(got) == 6 and all(0 <= r["quality"] <= 1 for r in got)
    assert len({r["quality"] for r in got if not r["text"]}) == 1
    assert Q.with_score(documents(spark, [], 1), network, "quality").count() == 0
    alone = Q.fit(docs, spark.createDataFrame([], "doc_id BIGINT, quality INT"))
    assert Q.with_score(docs, alone, "quality").count() == 6


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    scored = queries.op7_quality(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in scored) >= 0.9 * len(scored)

import numpy as np
from pyspark import cloudpickle

from tests.llm.helpers import documents, prose
from tidemill.llm import scoring as L


def test_counts_of_the_deepest_contexts_stay_in_tasks(spark, monkeypatch):
    seen, keep = [], L._smoothed
    monkeypatch.setattr(L, "_smoothed", lambda states, rows, root: seen.append((states, len(rows))) or keep(states, rows, root))
    monkeypatch.setattr(L, "FETCH", 7)
    codes, n, rng = {}, 40, np.random.default_rng(5)
    for a in range(n):
        for b in range(n):
            codes.update({(a << 16) | (b << 8) | int(c): int(k) for c, k in zip(rng.choice(n, 4, False), rng.integers(20, 90, 4))})
    counts = spark.createDataFrame(list(codes.items()), "code BIGINT, n BIGINT").repartition(4)
    mass = np.arange(1.0, L.SYMBOLS + 1)
    tree = L.grow_tree(counts, (), mass)

    (states, rows), = seen
    assert {d for d, _ in states} == {1} and rows <= L.SYMBOLS * (len(states) + 1)
    deep = [(i, int(c)) for i, (d, c) in enumerate(tree.kept, 1) if d == L.DEPTH]
    assert len(deep) > 1000
    assert len(cloudpickle.dumps(tree)) < 100_000  # one line of the table has 1 KB

    def line(depth, context):
        if not depth:
            return mass / mass.sum()
        own = np.zeros(L.SYMBOLS)
        for code, k in codes.items():
            if (code >> 8) % L.SYMBOLS**depth == context:
                own[code & 255] += k
        kinds = np.count_nonzero(own)
        return (own + kinds * line(depth - 1, context % L.SYMBOLS ** (depth - 1))) / (own.sum() + kinds)

    for i, context in deep[::97] + [deep[-1]]:
        assert np.array_equal(tree.logp[i], np.log10(line(L.DEPTH, context)).astype(np.float32))
    assert np.allclose((10 ** tree.logp.astype(float)).sum(axis=1), 1, atol=1e-5)


def test_a_tree_without_deep_states(spark):
    model = L.fit(documents(spark, [(1, " ".join(prose(1, 5)))]))
    assert len(model.tree.kept) == 0 and model.tree.logp.shape == (1, L.SYMBOLS)

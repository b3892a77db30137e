import numpy as np
import pytest

from tidemill.llm import neighbours as N

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, query BIGINT, v INT, leaf STRING, rank INT"


def table(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x", 4) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, k=20, every=20):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    found = {}
    for q, x in usable:
        if q % every == 0:
            others = sorted((-float(np.einsum("j,j->", x, y)), i) for i, y in usable if i != q)[:k]
            found[q] = [(i, -s) for s, i in others]
    return found


def by_query(frame):
    found = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(found.setdefault(r["query_id"], [])) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    return found


def random_rows(n, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((9, dim)) * 2
    return [(int(i), (centres[i % 9] + rng.standard_normal(dim)).tolist()) for i in rng.permutation(n)]


def test_recall_against_brute_force(spark):
    rows = random_rows(4000)
    got, wanted = by_query(N.nearest(table(spark, rows))), brute(rows)
    assert got.keys() == wanted.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * 20 * len(wanted)
    exact = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    assert all(s == pytest.approx(exact[q] @ exact[i], abs=1e-12) for q, v in got.items() for i, s in v)


def test_full_visits_are_exact_with_copies_and_ties(spark, monkeypatch):
    monkeypatch.setattr(N, "BIN_ROWS", 60)
    rows = random_rows(500, 5) + [(1000 + i, [1.0, 2.0, 0.0, -1.0, 3.0]) for i in range(300)] + [(2000 + i, [float(i % 3), 1.0, 0.0, 0.0, 0.0]) for i in range(60)]
    got = by_query(N.nearest(table(spark, rows), recall=2.0))
    wanted = brute(rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in wanted.items()}


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [1.0, inf]), (100, [1.0, None]), (None, [1.0, 1.0]), (120, [1.0, 2.0, 3.0]), (2, []), (1, [0.5, 0.5])]
    got = by_query(N.nearest(table(spark, rows)))
    assert got == {0: [(1, 0.5)]}


def test_empty_and_single(spark):
    assert N.nearest(table(spark, [], 1)).count() == 0
    assert N.nearest(table(spark, [(20, [1.0])])).count() == 0
    assert N.nearest(table(spark, [(20, None)])).count() == 0
    assert by_query(N.nearest(table(spark, [(20, [1.0]), (3, [-2.0])]))) == {20: [(3, -2.0)]}


def test_leaves_are_visited_best_first():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((800, 6))
    tree = N.grow(x)
    leaf = tree.place(x)
    assert leaf.min() >= 0 and leaf.max() < tree.leaves
    order = tree.visits(x[:5], tree.leaves)
    assert all(sorted(o) == list(range(tree.leaves)) for o in order)
    assert np.mean([leaf[i] in o[:3] for i, o in enumerate(order)]) > 0.7


def test_large_leaves_get_several_bins():
    assert N._bins({0: 5, 1: 5, 2: 25, 3: 4}, 10) == {0: (0, 1), 1: (0, 1), 2: (1, 3), 3: (4, 1)}


def test_queries_of_a_bin_come_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "QUERY_ROWS", 10, raising=False)
    whole = N._search

    def bounded(k, dim):
        run = whole(k, dim)

        def checked(queries, rows):
            if queries.num_rows > 40:
                raise ValueError(f"{queries.num_rows} queries at once")
            return run(queries, rows)

        return checked

    monkeypatch.setattr(N, "_search", bounded)
    rows = random_rows(600, 5)
    got, wanted = by_query(N.nearest(table(spark, rows), every=2, recall=2.0)), brute(rows, every=2)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in wanted.items()}


def test_visits_go_on_until_the_leaves_hold_enough(spark):
    tree = N.Tree(np.array([[0.0], [1.0], [2.0], [9.0]]), [[1, 2, 3], [], [], []])
    assert tree.visits(np.array([[9.0]]), 1, np.array([30, 4, 1]), 21) == [[2, 1, 0]]
    assert tree.visits(np.array([[1.0]]), 1, np.array([30, 4, 1]), 21) == [[0]]
    rows = random_rows(60, 5)
    got = by_query(N.nearest(table(spark, rows), every=2, recall=0.0))
    assert len(got) == 30 and all(len(v) == 20 for v in got.values())


def test_calibration_leaves_the_query_itself_out(spark):
    # each query's nearest other vector is in the other leaf
    tree = N.Tree(np.array([[0.0, 0.0], [0.0, 0.0], [5.0, 0.0]]), [[1, 2], [], []])
    candidates = spark.createDataFrame([(0, [1.0], 0), (1, [1.0], 1)], "vec_id BIGINT, v ARRAY<DOUBLE>, leaf BIGINT")
    queries = spark.createDataFrame([(0, [1.0])], "query BIGINT, v ARRAY<DOUBLE>")
    assert N.calibrated_visits(tree, candidates, queries, 1, 1, 0.9) == (2, 1.0)

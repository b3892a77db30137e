import pytest

from tests.llm.helpers import Sets, documents, prose
from tidemill.llm import jaccard as J
from tidemill.llm.components import components


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    if len(words) >= k:
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    groups, ids = Sets(sets), sorted(sets)
    for x in ids:
        for y in ids:
            common = len(sets[x] & sets[y])
            if x < y and common and 100 * common >= 80 * (len(sets[x]) + len(sets[y]) - common):
                groups.join(x, y)
    return sorted((i, len(sets[i]), groups.find(i)) for i in sets)


def changed(words, *places):
    words = list(words)
    for p in places:
        words[p] = f"changed{p}"
    return words


LINE = "one line that is found in very many of all documents here".split()
A = prose(1, 200)
# a chain whose ends are far apart, sets on both sides of the threshold, copies, short and empty texts
CHAIN = [changed(A, *range(3, 3 + 3 * i)) for i in range(12)]
TEXTS = [" ".join(t) for t in CHAIN] + [" ".join(A).upper(), " ".join(A), "", None, "  \n", "two words", "Two  words", "a b c d", "a b c d e", "é " * 30, "É " * 30]
TEXTS += [" ".join(prose(7, 30) + LINE + prose(s, 2)) for s in range(6)] + [" ".join(LINE + prose(100 + s, 25)) for s in range(40)]
TEXTS += [" ".join(prose(9, n)) for n in (100, 104, 116, 121, 123, 124, 125, 126, 130)] + [" ".join(prose(11, 3000, 900)), " ".join(changed(prose(11, 3000, 900), 5, 900))]


def result(frame):
    return sorted(tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize("long_list", [200, 8, 1])
def test_by_brute_force(spark, long_list):
    rows = [(1000 - 3 * i, t) for i, t in enumerate(TEXTS)]
    assert result(J.near_copies(documents(spark, rows), long_list=long_list)) == brute(rows)


def test_without_hubs_nothing_is_lost(spark, monkeypatch):
    """Links between components are found by the index alone."""
    monkeypatch.setattr(J, "hub_pairs", lambda sets, reps, percent: sets.selectExpr("rid AS a", "rid AS b").limit(0))
    monkeypatch.setattr(J, "star_pairs", lambda index, members, percent: index.selectExpr("rid AS a", "rid AS b").limit(0))
    rows = list(enumerate(TEXTS))
    assert result(J.near_copies(documents(spark, rows), long_list=5)) == brute(rows)


def test_ids_missing_or_repeated(spark):
    near = " ".join(changed(A, 3))
    rows = [(None, " ".join(A)), (9, near), (9, near), (4, "alone in the world today yes"), (None, "x y z"), (None, None), (4, " ".join(prose(50, 80)))]
    got = sorted([tuple(r) for r in J.near_copies(documents(spark, rows)).collect()], key=repr)
    n = len(shingles(near))
    assert got == sorted([(None, len(shingles(rows[0][1])), 9), (9, n, 9), (9, n, 9), (4, 2, 4), (None, 1, None), (None, 0, None), (4, len(shingles(rows[6][1])), 4)], key=repr)


def test_one_row_of_each_group_stays(spark):
    rows = [(1000 - 3 * i, t) for i, t in enumerate(TEXTS)] + [(1000, TEXTS[0]), (None, TEXTS[0]), (None, None), (None, "")]
    kept = J.one_of_each(documents(spark, rows))
    wanted = {c for _, n, c in brute(rows[: len(TEXTS)]) if n}
    with_words = [r for r in kept.collect() if (r["text"] or "").split()]
    assert sorted(r["doc_id"] for r in with_words) == sorted(wanted)
    assert kept.columns == documents(spark, []).columns and kept.count() == len(wanted) + 5


def test_empty_table(spark):
    assert J.near_copies(documents(spark, [], 1)).count() == 0


def test_components(spark, rows_of):
    links = [(i + 1, i) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (300, 200), (200, 300)]
    got = dict(rows_of(components(spark.createDataFrame(links, "a BIGINT, b BIGINT"))))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 300: 200, 200: 200}


def test_bounds_by_class_lose_no_link(spark):
    memo = J.WordHashes()
    texts = [" ".join(t) for t in CHAIN] + [" ".join(prose(21, 40_000, 90_000)), " ".join(changed(prose(21, 40_000, 90_000), *range(0, 40_000, 90))), " ".join(prose(22, 9, 9))]
    sets = [J.shingle_set(t, memo) for t in texts]
    assert max(len(J.spread_of(s)) for s in sets) == 4 * J.SPREAD
    rows = spark.createDataFrame([(i, len(s), J.spread_of(s)) for i, s in enumerate(sets)], "rid BIGINT, n BIGINT, spread BINARY")
    pairs = [(a, b) for a in range(len(sets)) for b in range(a)]
    got = {tuple(r) for r in J.that_may_link(spark.createDataFrame(pairs, "a BIGINT, b BIGINT"), rows, 80).collect()}
    for a, b in pairs:
        common = len(J.np.intersect1d(sets[a], sets[b]))
        assert common <= J.most_shared(J.spread_of(sets[a]), J.spread_of(sets[b]))
        assert (a, b) in got or 100 * common < 80 * (len(sets[a]) + len(sets[b]) - common)
    assert len(got) < 0.6 * len(pairs)

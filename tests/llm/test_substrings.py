import hashlib

import numpy as np
import pytest

from tests.llm.helpers import documents, prose
from tidemill.llm import substrings as S

LINE = "the same passage of more than twenty words that many of the documents share with each other in full every single time here".split()
A, B, C = prose(1, 60), prose(2, 90), prose(3, 30)
TEXTS = [
    " ".join(A), " ".join(B), " ".join(A[:40] + C), "\t ".join(B[10:70]) + "\n", None, "", "   ", "few words only", " ".join(C + LINE), " ".join(LINE + A[5:30]),
    " ".join(["in."] * 50), " ".join(["in."] * 25 + A[30:55]), " ".join(A[:19]), " ".join(A[:20]), "Ünïcode   words " * 15, " ".join(prose(4, 6000, 9000) + B),
    " ".join(w.upper() for w in A), "x" * 5000,
]


def brute(rows, window=20):
    """Windows that start earlier, word by word, in plain Python."""
    seen, found = set(), []
    for doc_id, text in sorted(rows):
        words = (text or "").encode().split()
        covered = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                covered[s : s + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, c in zip(words, covered) if not c)
        found.append((doc_id, len(words), sum(covered), hashlib.sha256(kept).hexdigest()))
    return found


def result(frame):
    return sorted(tuple(r) for r in frame.select("doc.doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_by_brute_force(spark):
    rows = list(enumerate(TEXTS))
    assert result(S.remove_repeats(documents(spark, rows))) == brute(rows)


@pytest.mark.parametrize("frequent,bin_rows", [(4, 3), (1, 1)])
def test_lengthened_prefixes_and_many_bins(spark, monkeypatch, frequent, bin_rows):
    monkeypatch.setattr(S, "FREQUENT", frequent)
    monkeypatch.setattr(S, "BIN_ROWS", bin_rows)
    rows = [(100 - i, " ".join(prose(i, 12) + LINE + prose(-i - 1, 8))) for i in range(40)] + [(200 + i, t) for i, t in enumerate(TEXTS)]
    assert result(S.remove_repeats(documents(spark, rows))) == brute(rows)


def test_rows_alike_and_rows_without_id(spark):
    rows = [(5, " ".join(A)), (5, " ".join(A)), (7, " ".join(A[:30])), (None, " ".join(B)), (None, " ".join(B)), (3, " ".join(B)), (5, "short one"), (5, "short one")]
    got = [tuple(r) for r in S.remove_repeats(documents(spark, rows)).select("doc.doc_id", "n_words", "n_removed").collect()]
    assert sorted(got, key=repr) == sorted(
        [(5, 60, 0), (5, 60, 60), (7, 30, 30), (None, 90, 90), (None, 90, 90), (3, 90, 0), (5, 2, 0), (5, 2, 0)], key=repr
    )


@pytest.mark.parametrize("seed", range(3))
def test_long_copies_and_short_texts_of_one_id(spark, seed):
    long = prose(50 + seed, 900, 9000)
    shorts = [prose(100 * (seed + 1) + i, 25 + i, 9000) for i in range(12)]
    rows = [(5, " ".join(long)), (5, " ".join(long)), *((5, " ".join(s)) for s in shorts)]
    others = [(9 + i, " ".join(s)) for i, s in enumerate(shorts)] + [(40, " ".join(long[100:700]))]
    got = [tuple(r) for r in S.remove_repeats(documents(spark, rows + others, 1)).select("doc.doc_id", "n_words", "n_removed").collect()]
    first = [(5, 900, 0), (5, 900, 900), *((5, len(s), 0) for s in shorts)]
    assert sorted(got) == sorted(first + [(9 + i, len(s), len(s)) for i, s in enumerate(shorts)] + [(40, 600, 600)])


def test_texts_and_columns_are_kept(spark):
    rows = {r["doc"]["doc_id"]: r for r in S.remove_repeats(documents(spark, enumerate(TEXTS)), with_text=True).collect()}
    assert rows[4]["kept_text"] is None and rows[6]["kept_text"] == "   " and rows[1]["kept_text"] == TEXTS[1]
    assert rows[2]["kept_text"] == " ".join(C) and rows[2]["doc"]["key"] == "k"


def test_empty_table(spark):
    assert S.remove_repeats(documents(spark, [], 1)).count() == 0


def test_leaves_and_depths():
    windows, prefix = np.array([[1, 2], [1, 3], [1, 2], [0, 9], [1, 2], [1, 2]]), np.array([0, 0, 0, 0, 0, 1])
    ranks = np.array([4, 1, 2, 0, 3, 5])
    repeated, heads = S.repeats(prefix, windows, ranks, ranks)
    assert repeated.tolist() == [True, False, False, False, True, False] and heads.tolist() == [False, True, True, True, False, True]


@pytest.mark.parametrize("width", range(1, 18))
def test_smallest_in_a_row(width):
    values = np.random.default_rng(width).integers(0, 9, 60)
    assert S._smallest(values, width).tolist() == [values[i : i + width].min() for i in range(61 - width)]


def test_pieces_of_very_long_texts(monkeypatch):
    hashes = np.random.default_rng(3).integers(0, 50, 900).astype(np.uint64)
    whole = S.anchors(hashes)[1]
    monkeypatch.setattr(S, "_PLACE_BITS", 7)
    assert (S.anchors(hashes)[1] == whole).mean() > 0.99


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 40, 3000).astype(np.uint64)
    grams, at = S.anchors(np.concatenate([hashes, hashes[500:900]]))
    assert (at[3000:3381] - 3000 == at[500:881] - 500).all()
    assert (np.diff(at) >= 0).all() and (at[:50] == [i + (grams[i : i + 15] >> np.uint64(24)).argmin() for i in range(50)]).all()

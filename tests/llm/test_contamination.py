import hashlib
import re

import pytest

from tests.llm.helpers import documents, prose
from tidemill.llm import contamination as C

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A = prose(1, 40)
ITEMS = [(1, " ".join(A)), (2, "Short item, here!"), (10, " ".join(prose(2, 10))), (3, None), (4, "?!"), (1, " ".join(A)), (None, " ".join(prose(3, 12))), (5, "été ÉTÉ x"), (6, " ".join(A[:25]))]
TEXTS = [
    " ".join(A), " ".join(prose(5, 8) + A[3:13] + prose(6, 5)), " ".join(A[3:12]), "A short ITEM here and a short item... here", None, "", "?? !!", " ".join(A[:25] + A[20:40]),
    ", ".join(prose(2, 10)).upper(), " ".join(prose(3, 12)), "ÉTÉ été x; été ÉTÉ x", " ".join(prose(9, 4000) + A[10:30] + prose(10, 2000)), " ".join(A), "short item", "short item here",
]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, items=ITEMS):
    windows = set()
    for item, text in items:
        words = WORD.findall(lower(text))
        for s in range(max(1, len(words) - 9)) if words else ():
            windows.add((item, tuple(words[s : s + 10])))
    found = []
    for doc_id, text in rows:
        words, hit, own = WORD.findall(lower(text)), set(), set()
        for item, w in windows:
            for s in range(len(words) - len(w) + 1):
                if tuple(words[s : s + len(w)]) == w:
                    hit.update(range(s, s + len(w)))
                    own |= {str(item)} - {"None"}
        found.append((doc_id, len(words), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=repr)


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(*i, "x", 3) for i in items], "item_id BIGINT, text STRING, word STRING, n INT")


@pytest.mark.parametrize("few", [200_000, 0])
def test_by_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(C, "FEW_WINDOWS", few)
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[0]), (2, TEXTS[3])]
    assert sorted([tuple(r) for r in C.contaminated(documents(spark, rows), benchmark(spark)).collect()], key=repr) == brute(rows)


def test_clean_rows_stay_as_they_are(spark):
    rows = list(enumerate(TEXTS))
    docs = documents(spark, rows)
    kept = C.clean(docs, benchmark(spark))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in brute(rows) if not r[-1])


def test_without_items_or_documents(spark):
    assert {r["n_hit"] for r in C.contaminated(documents(spark, [(1, "a b"), (2, None)]), benchmark(spark, [])).collect()} == {0}
    assert C.contaminated(documents(spark, [], 1), benchmark(spark)).count() == 0


def test_no_python_and_no_cross_join(spark):
    plan = C.contaminated(documents(spark, list(enumerate(TEXTS))), benchmark(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

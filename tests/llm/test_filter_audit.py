import itertools
import re

import pytest

from tests.llm.helpers import documents, prose
from tidemill.llm import filter_audit as A

LONG = " ".join(prose(1, 5000, 4000))
TEXTS = [
    None, "", "short", "SHORT CAPS", "a $ b", LONG, LONG, LONG + " x", LONG[:-3], " ".join(prose(2, 300, 3000)), "a " * 300, "a " * 300,
    "a\u00a0b " * 100, "É" * 50 + " " + " ".join(prose(3, 250, 9000)), "  \t\n ", "Ab|c", "prefix " * 40 + "1", "prefix " * 40 + "2", "prefix " * 40, "\x0b\x1f x",
]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(None, ""), (None, LONG), (3, LONG), (3, LONG), (99, "short"), (99, "short"), (98, "short"), (50, None)]


def mask(row, rows):
    key, text = row[0], row[1] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    others = [r[0] for r in rows if (r[1] or "") == text and r[0] is not None]
    failed = (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        bool(re.search(r"[#$%&*|]", text)), key is not None and any(o < key for o in others),
    )
    return {f for f, x in zip("ABCDE", failed) if x}


def brute(rows, labels):
    found, alone = [], {}
    for part in {r[2] or "" for r in rows}:
        own = [(mask(r, rows), r[0]) for r in rows if (r[2] or "") == part]
        for order in itertools.permutations("ABCDE"):
            for i, f in enumerate(order):
                here = [(m, k) for m, k in own if f in m and not m & set(order[:i])]
                alone[part, f] = alone.get((part, f), 0) + len(here)
                lost = [sum(k is not None and any(l[0] == k and l[c] == 1 for l in labels) for _, k in here) for c in (1, 2)]
                found.append((part, "".join(order), i + 1, sum(not m & set(order[: i + 1]) for m, _ in own), len(here),
                              sum(f in m and bool(m & set(order[:i])) for m, _ in own), sum(m == {f} for m, _ in own), *lost))
    return sorted((*r, alone[r[0], r[1][r[2] - 1]]) for r in found)


def labelled(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id BIGINT, quality INT, toxic INT, part STRING")


@pytest.mark.parametrize("group_bytes, block_bytes", [(1 << 20, 32 << 20), (40, 3_000)])
def test_by_brute_force(spark, group_bytes, block_bytes):
    rows = [(k, t, [None, "", "en", "de"][i % 4]) for i, (k, t) in enumerate(ROWS)]
    docs = documents(spark, rows)
    labels = [(2, 1, 0), (2, 0, 1), (6, 1, 1), (99, None, 1), (None, 1, 1), (11, 0, 0)]
    got = A.audit(docs, labelled(spark, labels), part_col="source", group_bytes=group_bytes, block_bytes=block_bytes)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, labels)


def test_prefixes_grow_until_groups_fit(spark):
    texts = spark.createDataFrame([(b"same start of all " + str(i).encode() * 9,) for i in range(200)] + [(b"other",)], "text BINARY")
    keys = {bytes(r[0]) for r in A.prefix_keys(texts, 400).select("prefix").collect()}
    assert b"other" in keys and len(keys) == 201
    assert len({bytes(r[0]) for r in A.prefix_keys(texts, 1 << 20).select("prefix").collect()}) == 2


def test_trie_holds_whole_texts():
    trie, texts = A.RadixTrie(), [b"", b"a", b"ab", b"abc", b"abd", b"b" * 5000, b"b" * 4999 + b"c", b"ab"]
    for i, text in enumerate(texts):
        trie.insert(text, i, (i,))
    assert {t: (n.least, len(n.rows)) for t, n in trie.terminals()} == {t: (texts.index(t), texts.count(t)) for t in texts}
    assert trie.size < sum(map(len, texts)) / 1.9


def test_empty_tables(spark):
    assert A.audit(documents(spark, [], 1), labelled(spark, [])).count() == 0
    rows = [(1, "a", "en"), (2, "a", "en")]
    docs = documents(spark, rows)
    assert sorted(tuple(r) for r in A.audit(docs, labelled(spark, []), part_col="source").collect()) == brute(rows, [])

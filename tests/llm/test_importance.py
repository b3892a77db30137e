import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tests.llm.helpers import documents, prose
from tidemill.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    " ".join(prose(1, 40)), " ".join(prose(2, 20)).upper(), " ".join(prose(3, 19)), "", None, "?!, .", "  été, ÉTÉ--x  a\tb ", "  a b ",
    " ".join(prose(4, 30_000)), "w" * 3_000, ", ".join(prose(5, 60)), " ".join(prose(5, 60)),
] + [" ".join(prose(10 + i, 25 + i)) for i in range(30)]
TARGET = [" ".join(prose(50, 200, 30)), None, "", "W1 w2"]


def grams(text, lo, hi):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, lo, hi, buckets, percent, least, seed):
    key = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(key(g) for _, text in rows for g in grams(text, lo, hi)[1])
    t = Counter(key(g) for text in target for g in grams(text, lo, hi)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)}
    found = []
    for doc_id, text in rows:
        words, own = grams(text, lo, hi)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[key(g)] for g in own)
        found.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words) >= least))
    able = sorted((f for f in found if f[4]), key=lambda f: (-f[3], f[0] is None, f[0] or 0, f[1], f[2]))
    drawn = [(*f[:4], i + 1) for i, f in enumerate(able[: len(able) * percent // 100])]
    return sorted(drawn + [(*f[:4], None) for f in able[len(drawn) :]] + [(*f[:4], None) for f in found if not f[4]], key=repr)


def target(spark, texts=TARGET):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "item_id BIGINT, text STRING, n INT")


@pytest.mark.parametrize("lo, hi, ranked", [(1, 1, 50_000), (1, 3, 7), (2, 2, 5)])
def test_by_brute_force(spark, monkeypatch, lo, hi, ranked):
    monkeypatch.setattr(I, "RANKED_ROWS", ranked)
    rows = [*enumerate(TEXTS), (None, TEXTS[0]), (None, TEXTS[0]), (2, TEXTS[0]), (0, TEXTS[0]), (0, TEXTS[0])]
    got = I.resample(documents(spark, rows), target(spark), 40, 20, 7, lo, hi, 97)
    assert [k for _, k in got.dtypes] == ["bigint"] * 5
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows, TARGET, lo, hi, 97, 40, 20, 7)


def test_overlapping_runs():
    found = [m.group() for m in I.pattern(2).finditer(I.collapsed("A b--c  b c"), overlapped=True)]
    assert found == ["a b", "b c", "c b", "b c"]


def test_draws_what_is_like_the_target(spark):
    rows = [(i, " ".join(prose(i, 50, 30 if i % 5 == 0 else 4000))) for i in range(200)]
    drawn = I.resample(documents(spark, rows), target(spark, [" ".join(prose(50, 6000, 30))])).where("rank IS NOT NULL").collect()
    assert len(drawn) == 20 and all(r["doc_id"] % 5 == 0 for r in drawn)


def test_empty_tables(spark):
    assert I.resample(documents(spark, [], 1), target(spark)).count() == 0
    rows = list(enumerate(TEXTS[:6]))
    got = I.resample(documents(spark, rows), target(spark, []), 40, 20, 7, 1, 1, 97).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows, [], 1, 1, 97, 40, 20, 7)

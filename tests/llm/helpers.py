"""Small tables and brute-force versions for the tests of the training-data operators."""

from __future__ import annotations

import random

CLASHING = "doc STRING, size INT, score DOUBLE, digest STRING, n INT, key STRING, rank INT, label INT, word STRING, target STRING"
EXTRA = ("x", 1, 0.5, "d", 2, "k", 3, 4, "w", "t")
SCHEMA = f"doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, {CLASHING}"


def documents(spark, rows, parts=3):
    """``rows``: (doc_id, text) or (doc_id, text, source); with more columns whose names clash."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def prose(seed, n, words=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(words)}" for _ in range(n)]


class Sets:
    """Union-find that keeps the smallest member as the root."""

    def __init__(self, members):
        self.of = {m: m for m in members}

    def find(self, x):
        while self.of[x] != x:
            x = self.of[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.of[max(a, b)] = min(a, b)

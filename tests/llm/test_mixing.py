from collections import Counter, defaultdict

from tests.llm.helpers import documents, prose
from tidemill.llm import mixing as M


def rows(spark):
    made = [(i, " ".join(prose(i, 5 + i % 90)), ["b", "a", "Z", None, "ä", "hot"][min(5, i % 16)]) for i in range(400)]
    made += [(400, None, "a"), (401, "", "b"), (None, "one two", "a"), (None, "one two", "a"), (402, " ".join(prose(1, 9000)), "long"), (403, None, "none"), (7, made[7][1], made[7][2])]
    return documents(spark, made, 4)


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Shares by weight; what is above a source's most is shared again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, found = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not above:
            found |= {s: weight[s] * level for s in open_}
            break
        found |= {s: float(most * sizes[s]) for s in above}
        left -= sum(most * sizes[s] for s in above)
        open_ -= above
    return found


def test_targets_and_amounts(spark):
    got = M.mix(rows(spark), shard_words=2000).collect()
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    wanted = targets(dict(sizes))
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - wanted[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert len(got) == 407 and all(abs(taken[s] - wanted[s]) <= 3 * M.BLOCK_WORDS for s in sizes)


def test_reruns_agree_and_seeds_differ(spark):
    docs = rows(spark)
    key = lambda seed, parts: sorted(map(repr, M.mix(docs.repartition(parts), seed=seed, shard_words=3000).collect()))
    assert key(11, 2) == key(11, 7) != key(12, 2)


def sainte_lague(votes, total):
    seats = dict.fromkeys(votes, 0)
    for _ in range(total):
        seats[max(votes, key=lambda p: (votes[p] / (2 * seats[p] + 1), -p))] += 1
    return seats


def test_seats_by_highest_quotients(spark):
    elections = {1: ({1: 530, 2: 240, 3: 120, 4: 70, 5: 40}, 37), 2: ({1: 10, 2: 10, 3: 10}, 4), 3: ({1: 0, 2: 5}, 3), 4: ({i: 1000 // i for i in range(1, 40)}, 11), 5: ({1: 9}, 0)}
    parties = spark.createDataFrame([(e, p, v, n) for e, (votes, n) in elections.items() for p, v in votes.items()], "e INT, p INT, v BIGINT, n BIGINT")
    got = defaultdict(dict)
    from pyspark.sql import functions as F

    for r in M.seats(parties, ["e"], ["p"], "v", F.col("n")).collect():
        got[r["e"]][r["p"]] = r["seats"]
    for e, (votes, n) in elections.items():
        wanted = sainte_lague({p: v for p, v in votes.items() if v}, n)
        assert {p: s for p, s in got[e].items() if votes[p]} == wanted and all(got[e][p] == 0 for p, v in votes.items() if not v)


def test_columns_come_along(spark):
    docs = rows(spark)
    carried = M.mix(docs, carry=True).select("doc.*")
    assert sorted(map(repr, carried.collect())) == sorted(map(repr, docs.collect()))


def test_empty(spark):
    assert M.mix(documents(spark, [], 1)).count() == 0
    assert [r["taken"] for r in M.mix(documents(spark, [(1, None), (2, " ")])).collect()] == [0, 0]


def test_many_sources_are_joined_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(M, "FEW_SOURCES", 0)
    assert M.mix(rows(spark)).count() == 407

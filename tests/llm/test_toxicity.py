import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, prose
from tidemill.llm import queries, toxicity as X
from tidemill.llm.toxicity import INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT

PLAIN = X.Model(X.START, (1.0, 0.5, 0.5, 0.0, 0.0, 0.0, -5.0))


def clause(*kinds):
    return X.clause_score([(k, 2.0 if k in (INSULT, THREAT) else 0.0) for k in kinds])


def test_machines_are_composed():
    alone = clause(INSULT)[0]
    assert clause(TARGET, OTHER, INSULT)[0] > alone > clause(NEGATION, OTHER, INSULT)[0] > 0
    assert alone > clause(REPORT, OTHER, OTHER, INSULT)[0] > clause(REPORT, NEGATION, INSULT)[0]
    assert clause(NEGATION, OTHER, OTHER, OTHER, INSULT)[0] == alone
    assert clause(INSULT, OTHER, TARGET)[0] > alone
    assert clause(TARGET, THREAT)[1] > clause(THREAT)[1] and clause(OTHER, TARGET) == (0, 0) == clause()


def test_clauses_not_words():
    score = lambda text: sum(X.features(text, PLAIN)[:1])
    assert score("You are an idiot.") > score("You left. Somebody met an idiot.") > score("He is not an idiot.")
    assert score("Somebody said that is an idiot.") < score("Somebody knows that is an idiot.")
    assert score("I will kill you!") > score("Please kill the process.")
    for clean in (None, "", "  ", "idiotic things", "A morons-free text?".replace("morons", "moronsx"), "." * 3000):
        assert X.features(clean, PLAIN) == (0.0,) * X.FEATURES


def test_longest_stem_at_word_start_counts():
    model = X.Model((("abcd", INSULT, 1.0), ("abcdef", INSULT, 3.0), ("abcd$", INSULT, 5.0)))
    assert X.hits("abcdx xabcd abcdefg abcd", model) == {0: (INSULT, 1.0), 12: (INSULT, 3.0), 20: (INSULT, 5.0)}
    assert X.hits("anything", X.Model(())) == {}


def labelled(spark, n=240):
    rng, rows, labels = random.Random(4), [], []
    for i in range(n):
        words, toxic = prose(i, 40 + i % 50), i % 3 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["grumblefex", "snarkolid", "snarkolids"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), "x"))
    labels += [(None, 1, "x"), (5, None, "x"), (n + 9, 1, "x"), (3, 0, "x")]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id BIGINT, toxic INT, text STRING")


def test_learns_stems_and_scores(spark):
    docs, labels = labelled(spark)
    model = X.fit(docs, labels, keep=F.col("doc_id") % 4 != 0)
    assert any("snarkolids$".startswith(s) and w > 1 for s, _, w in model.stems)
    scored = X.with_score(documents(spark, [(1, "w1 grumblefex w2"), (2, "w1 w2"), (3, None), (4, ""), (None, "w3"), (2, "w1 w2")]), model, "toxicity")
    got = {r["doc_id"]: r["toxicity"] for r in scored.collect()}
    assert scored.count() == 6 and got[1] > 0.5 > 0.3 > got[2] == got[3] == got[4] == got[None] > 0
    held = X.with_score(docs.where("doc_id % 4 = 0"), model, "toxicity").collect()
    assert sum((r["toxicity"] >= 0.3) == (r["doc_id"] % 3 == 0) for r in held) >= 0.95 * len(held)


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1), (2, 1)]])
def test_few_labels(spark, labels):
    docs = documents(spark, [(1, "you idiot, you pathetic moron"), (2, "a calm text")])
    model = X.fit(docs, spark.createDataFrame(labels, "doc_id BIGINT, toxic INT"))
    got = {r["doc_id"]: r["s"] for r in X.with_score(docs, model, "s").collect()}
    assert got[1] > 0.3 > got[2]
    assert X.with_score(documents(spark, [], 1), model, "s").count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    scored = queries.op1_toxicity(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in scored)
    assert right >= 0.97 * len(scored) and all(0 <= r["score"] <= 1 for r in scored)

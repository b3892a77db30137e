import pytest

import corpus_pipeline as P
from tests.llm import test_contamination, test_jaccard, test_substrings
from tests.llm.helpers import documents, prose
from tidemill.llm import queries
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_agrees_with_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name]) is None


def test_all_ten_are_registered():
    import __spark_entry__ as entry

    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in entry.queries())] == []
    assert entry.queries()["pipeline"] is P.run and [n for n, _ in P.STAGES] == ["toxicity", "near_copies", "substrings", "decontamination", "mixing"]


def folder_of(spark, tmp_path, rows, items):
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, 1, 1)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    test_contamination.benchmark(spark, items).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_decisions_by_brute_force(spark, tmp_path):
    """Every stage against a plain version of its own decision, each judged on what the one before kept."""
    passage, item = prose(500, 30), prose(501, 15)
    rows = [(i, " ".join(prose(i, 60, 4000))) for i in range(20)]
    rows += [(20, rows[3][1]), (21, " ".join(test_jaccard.changed(rows[4][1].split(), 2))), (22, "you idiot! you worthless pathetic moron. you scum"), (23, None), (24, "")]
    rows += [(30 + i, " ".join(prose(600 + i, 20, 4000) + passage)) for i in range(4)] + [(40, " ".join(prose(700, 9, 4000) + item))]
    folder = folder_of(spark, tmp_path, rows, [(1, " ".join(item))])
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), dict(rows)
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        if name != "mixing":
            assert out.columns == docs.columns
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "toxicity":
            del kept[22]
        elif name == "near_copies":
            kept = {i: kept[i] for i, n, c in test_jaccard.brute(list(kept.items())) if not n or c == i}
        elif name == "substrings":
            for i, n, removed, _ in test_substrings.brute(list(kept.items())):
                if removed:
                    words = kept[i].split()
                    kept[i] = " ".join(words[: n - removed])  # the passage stands last in each
        elif name == "decontamination":
            kept = {r[0]: kept[r[0]] for r in test_contamination.brute(list(kept.items()), [(1, " ".join(item))]) if not r[-1]}
        if name != "mixing":
            assert got == kept, name
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in docs.collect()}
    assert set(taken) <= set(kept) and all(0 < t <= 2 * s and s == len(kept[i].split()) for i, (t, s) in taken.items())
    total = sum(len((t or "").split()) for t in kept.values())
    assert abs(sum(t for t, _ in taken.values()) - 1.5 * total) <= 16


def test_whole_run_and_empty_table(spark, tmp_path):
    assert P.run(spark, FOLDER).count() > 0
    assert P.run(spark, folder_of(spark, tmp_path, [], [])).count() == 0

import re

import pytest

from tests.llm.helpers import documents
from tests.llm.test_contamination import TEXTS, benchmark
from tidemill.llm import contamination as C
from tidemill.llm.common import ALNUM_WORD, WORD, lowered


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def no_small_tables(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_are_cut_once_a_pass_and_not_moved(spark, monkeypatch, no_small_tables):
    passes, keep = {}, C.materialise
    monkeypatch.setattr(C, "materialise", lambda df, kind: passes.setdefault(kind, (plan(df), df._jdf.queryExecution().executedPlan().toString())) and keep(df, kind))
    docs = documents(spark, list(enumerate(TEXTS)))
    kept = C.clean(docs, benchmark(spark))
    for kind in ("item-word-counts", "window-hits"):
        logical, physical = passes[kind]
        assert logical.count("regexp_extract_all") == 1 and "SortMergeJoin" not in physical, kind
    assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()


def test_copies_and_rows_without_id_keep_their_own_hits(spark, monkeypatch):
    rows = [(1, TEXTS[0]), (1, TEXTS[0]), (None, TEXTS[0]), (None, None), (1, "none of it"), (2, "")]
    found = []
    for few in (200_000, 0):
        monkeypatch.setattr(C, "FEW_WINDOWS", few)
        found.append(sorted(map(tuple, C.contaminated(documents(spark, rows), benchmark(spark)).collect()), key=repr))
    assert found[0] == found[1] and len(found[0]) == len(rows)
    assert sorted(r[5] for r in found[0]) == [False] * 3 + [True] * 3


def test_word_classes_are_those_of_the_contracts():
    for listed, ranges in ((WORD, r"[^\x20\x09-\x0D]+"), (ALNUM_WORD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        assert all(bool(re.match(listed, chr(c))) == bool(re.match(ranges, chr(c))) for c in range(0x3000))


def test_only_a_to_z_are_lowered(spark):
    texts = ["".join(map(chr, range(0x20, 0x7F))), "ÀÉ AİZ ΣK", "", None, "\u0000AZ[`{@"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING").orderBy("i").select(lowered(C.F.col("t"))).collect()]
    assert got == [t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in texts]

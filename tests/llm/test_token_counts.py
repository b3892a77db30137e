import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemill.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
SCHEMA = "doc_id BIGINT, text STRING, content STRING, n_tokens INT"
TEXTS = [
    None, "", " ", "\n\n  a", "a<|endoftext|>b", "don't  stop\t\tnow  x", "é" * 500, "word " * 5000, "same", "same", "a" * 9000, "　 \x1c b",
]


def length(text):
    return len(PLAIN.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'st1!. \n\t\r\x1c\x85\xa0 　é漢😀<|>")), max_size=40) | st.text(max_size=30))
def test_pieces_add_up(text):
    assert T.load(PATH).counts([text]) == [length(text)]


def test_rows_and_cache(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i if i != 3 else None, t, "c", 1) for i, t in enumerate(TEXTS)] + [(8, "same", "c", 1)], SCHEMA).repartition(4)
    wanted = sorted(((i if i != 3 else None), len((t or "").encode()), length(t), length(t) > 1024) for i, t in [*enumerate(TEXTS), (8, "same")] if i != 3)
    for _ in range(2):
        rows = T.count_tokens(docs, PATH, str(tmp_path / "cache")).collect()
        assert sorted(tuple(r) for r in rows if r["doc_id"] is not None) == wanted
        assert [r["n_tokens"] for r in rows if r["doc_id"] is None] == [length(TEXTS[3])]
        stored = spark.read.parquet(str(tmp_path / "cache"))
        assert stored.count() == stored.select("content").distinct().count() == len({t or "" for t in TEXTS})


def test_stored_counts_are_used(spark, tmp_path):
    import hashlib

    cache = str(tmp_path / "cache")
    docs = spark.createDataFrame([(1, "stored"), (2, "new")], "doc_id INT, text STRING")
    key = bytearray(hashlib.sha256(b"stored").digest())
    rows = [(key, 77, T.version_digest(PATH)), (key, 77, T.version_digest(PATH)), (key, 5, "another version")]
    spark.createDataFrame(rows, T.CACHE).write.partitionBy("tokenizer").parquet(cache)
    assert {r["doc_id"]: r["n_tokens"] for r in T.count_tokens(docs, PATH, cache).collect()} == {1: 77, 2: length("new")}


def test_empty_table(spark):
    assert T.count_tokens(spark.createDataFrame([], SCHEMA), PATH).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies(spark, name):
    path = public_tokenizers.path(name)
    texts = [t or "" for t in TEXTS if t != "a<|endoftext|>b"]
    if name.endswith(".json"):
        wanted = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in texts]
    else:
        import sentencepiece

        wanted = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)]
    assert T.load(path).counts(texts) == wanted


def test_given_texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in T.count_tokens(rows, PATH).collect()}
    assert got == {r["doc_id"]: (len(r["text"].encode()), length(r["text"])) for r in rows.collect()}

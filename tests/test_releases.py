"""Tables committed together, files rewritten alone, loads behind a gate, folded micro-batches."""

import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.jobs import popularity_mart
from tidemill.operators import changes as C, quality as V
from tidemill.sources import releases as L
from tidemill.streaming import folding, messages as SM

PAIR = "id BIGINT, v STRING"


def pairs(spark, n, start=0, v="a"):
    return spark.range(start, start + n).select("id", F.lit(v).alias("v"))


def files(root) -> set[str]:
    return {str(p) for p in Path(root).rglob("*.parquet")}


def test_readers_see_all_of_a_record_or_nothing(spark, tmp_path):
    root = str(tmp_path)
    first = L.draft(spark, root).replaced("a", pairs(spark, 3)).replaced("b", pairs(spark, 4)).saved()
    draft = first.replaced("a", pairs(spark, 30)).marked(src=7)
    assert [L.current(spark, root).read(t, PAIR).count() for t in "ab"] == [3, 4]
    draft = draft.saved(final=False)
    assert L.current(spark, root).read("a", PAIR).count() == 3 and L.current(spark, root).marks == {}
    again = L.draft(spark, root)
    assert again.marks == {"src": "7"} and not again.final and again.read("a", PAIR).count() == 30
    again.replaced("b", pairs(spark, 40)).saved()
    assert [L.current(spark, root).read(t, PAIR).count() for t in "ab"] == [30, 40]
    assert first.read("a", PAIR).count() == 3  # a reader of the old state goes on


def test_empty_and_unknown_tables(spark, tmp_path):
    release = L.current(spark, str(tmp_path))
    assert release.read("none", PAIR).count() == 0 and release.number == 0
    release = release.replaced("a", pairs(spark, 0)).replaced("p", pairs(spark, 0), part="v").saved()
    assert [L.current(spark, str(tmp_path)).read(t, PAIR).count() for t in "ap"] == [0, 0]
    assert release.rows_deleted("none", PAIR, F.col("id") > 0) is release
    added = release.rows_replaced("a", PAIR, pairs(spark, 2), ["id"])
    assert added.read("a", PAIR).count() == 2


def test_two_writers_of_one_number(spark, tmp_path, monkeypatch):
    one, two = (L.draft(spark, str(tmp_path)).replaced("a", pairs(spark, n)) for n in (1, 2))
    monkeypatch.setattr(L, "newest", lambda *_: 0)
    one.saved()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        two.saved()


def test_upserts_touch_their_parts_only(spark, tmp_path, rows_of):
    schema = "id BIGINT, v STRING, p INT"
    rows = pairs(spark, 100).withColumn("p", (F.col("id") / 10).cast("int"))
    start = L.draft(spark, str(tmp_path)).replaced("t", rows, part="p").saved()
    new = pairs(spark, 7, 95, "b").withColumn("p", (F.col("id") / 10).cast("int"))
    done = start.upserted("t", schema, new, ["id"], ["v"], part="p").saved()
    assert {p for p in start.paths("t")} - set(done.paths("t")) == {start.places["t"]["9"][0]}
    assert done.parts("t") == sorted(str(i) for i in range(11))
    assert rows_of(done.read("t", schema)) == rows_of(C.upsert(rows, new, ["id"], ["v"]))
    assert done.upserted("t", schema, new.limit(0), ["id"], ["v"], part="p") is done
    with pytest.raises(ValueError, match="parts must be"):
        start.replaced("t", pairs(spark, 2, v="a/b"), part="v")


@pytest.fixture(scope="module")
def hundred(spark, tmp_path_factory):
    """A table of 100 files with ten keys each."""
    root = str(tmp_path_factory.mktemp("hundred"))
    rows = pairs(spark, 1_000).repartitionByRange(100, "id")
    release = L.draft(spark, root).replaced("t", rows).saved()
    assert len(spark.read.parquet(*release.paths("t")).inputFiles()) == 100
    return release


def read_files(release) -> set[str]:
    return set(release.read("t", PAIR).inputFiles())


def test_ten_updates_rewrite_ten_files_at_most(spark, hundred, rows_of):
    listed = spark.createDataFrame([(k, f"new{k}", 1) for k in (1, 2, 3, 250, 251, 600, 777, 998, 999, 5_000)], "id BIGINT, v STRING, step INT")
    done, report = hundred.rows_updated("t", PAIR, listed, "id", "v", ["step"])
    gone = read_files(hundred) - read_files(done)
    assert 0 < len(gone) <= 9 and len(read_files(hundred) & read_files(done)) == 100 - len(gone)
    whole, plain_report = C.batch_update(pairs(spark, 1_000), listed, "id", "v", ["step"])
    assert rows_of(done.read("t", PAIR)) == rows_of(whole)
    assert rows_of(report) == rows_of(plain_report) and C.update_counts(report).first()["n_unknown"] == 1
    again, _ = done.rows_updated("t", PAIR, listed.limit(1), "id", "v", ["step"])  # in a table of folders and files
    assert again.read("t", PAIR).count() == 1_000
    nothing, report = hundred.rows_updated("t", PAIR, listed.filter("id = 5000"), "id", "v", ["step"])
    assert nothing is hundred and [r["updated"] for r in report.collect()] == [False]


def test_deletes_and_replacements_leave_other_files(spark, hundred, rows_of):
    condition = F.col("id").between(100, 104)
    done = hundred.rows_deleted("t", PAIR, condition)
    assert len(read_files(hundred) - read_files(done)) <= 2
    assert rows_of(done.read("t", PAIR)) == rows_of(C.delete_where(pairs(spark, 1_000), condition))
    new = spark.createDataFrame([(5, "x"), (5, "y"), (2_000, "z")], PAIR)
    done = hundred.rows_replaced("t", PAIR, new, ["id"])
    assert len(read_files(hundred) - read_files(done)) == 1
    assert rows_of(done.read("t", PAIR)) == rows_of(C.replace_by_key(pairs(spark, 1_000), new, ["id"]))


def test_changes_by_file_in_parts(spark, tmp_path, rows_of):
    schema = "id BIGINT, v STRING, p INT"
    rows = pairs(spark, 60).withColumn("p", (F.col("id") % 3).cast("int"))
    start = L.draft(spark, str(tmp_path)).replaced("t", rows, part="p").saved()
    done = start.rows_deleted("t", schema, F.col("id") == 4, part="p").saved()
    assert {p: done.places["t"][p] == start.places["t"][p] for p in "012"} == {"0": True, "1": False, "2": True}
    assert rows_of(L.current(spark, str(tmp_path)).read("t", schema, [1])) == rows_of(rows.filter("p = 1 AND id <> 4"))


def test_a_gate_counts_in_the_write(spark, tmp_path):
    rules = [V.required("v"), V.positive_int("id")]
    gate = L.Gate(rules, least=2)
    release = L.draft(spark, str(tmp_path)).replaced("a", pairs(spark, 5, 1), gate=gate).saved()
    assert gate.seen == {"rows": 5, "v is required": 0, "id must be a whole number above 0": 0}
    bad = pairs(spark, 3).withColumn("v", F.when(F.col("id") > 0, F.col("v")))
    with pytest.raises(L.GateError, match=r"v is required \(1 rows\); id must be a whole number above 0 \(1 rows\)"):
        release.replaced("a", bad, gate=L.Gate(rules))
    with pytest.raises(L.GateError, match="1 rows, at least 2"):
        release.appended("a", pairs(spark, 1, 1), gate=gate)
    assert L.current(spark, str(tmp_path)).read("a", PAIR).count() == 5
    assert release.replaced("a", bad, gate=L.Gate(rules, most=1)).read("a", PAIR).count() == 3


def test_the_gate_needs_one_scan(spark, tmp_path):
    src = str(tmp_path / "src")
    pairs(spark, 50, 1).write.parquet(src)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("gated", "gated")
    L.draft(spark, str(tmp_path / "r"))
    before = len(tracker.getJobIdsForGroup("gated"))
    L.Release(spark, str(tmp_path / "r")).replaced("a", spark.read.schema(PAIR).parquet(src), gate=L.Gate([V.required("v")]))
    assert len(tracker.getJobIdsForGroup("gated")) - before == 1
    spark.sparkContext.setJobGroup("", "")


def test_expiry_keeps_what_records_name(spark, tmp_path):
    root = str(tmp_path)
    release = L.draft(spark, root).replaced("keep", pairs(spark, 2)).saved()
    for i in range(5):
        release = release.replaced("a", pairs(spark, i + 1)).saved()
    release.replaced("a", pairs(spark, 9))  # never named
    assert L.expire(spark, root, keep=2) == 4 + 4
    assert L.current(spark, root).read("a", PAIR).count() == 5 and L.current(spark, root).read("keep", PAIR).count() == 2
    assert L.expire(spark, root, keep=2) == 0


def landed(tmp_path, n, items):
    src = tmp_path / "in"
    src.mkdir(exist_ok=True)
    (src / f"raw_products_{n}.csv").write_text(f"product_id,product_name\n1,tea{n}\n2,milk{n}\n")
    (src / f"raw_orders_{n}.csv").write_text("order_id,order_date\n1,2025-07-15\n2,2025-07-14\n")
    (src / f"raw_order_items_{n}.csv").write_text("order_id,product_id,quantity,price\n" + items)
    return str(src)


@pytest.mark.parametrize("where", ["order_items", "catalog"])
def test_a_failed_load_changes_nothing_and_a_repeat_completes_it(spark, tmp_path, monkeypatch, where):
    root, database = str(tmp_path / "out"), f"failed_{where}"
    src = landed(tmp_path, 1, "1,1,2,10.00\n")
    popularity_mart.run(spark, src, root, database)
    old = {(1, "tea1", 2)}
    seen = lambda rows: {(r["product_id"], r["product_name"], r["total_quantity_sold"]) for r in rows.collect()}
    assert seen(popularity_mart.mart(spark, root)) == old
    landed(tmp_path, 2, "1,1,5,10.00\n2,2,1,4.00\n")

    def fail(*_, **__):
        raise RuntimeError("cut off")

    def at(table):
        if table == where:
            fail()

    with monkeypatch.context() as patch:
        if where == "catalog":
            patch.setattr(L, "follow", fail)
        with pytest.raises(RuntimeError):
            popularity_mart.run(spark, src, root, database, before_table=at)
    new = {(1, "tea2", 5), (2, "milk2", 1)}
    assert seen(popularity_mart.mart(spark, root)) == (new if where == "catalog" else old)
    if where != "catalog":
        assert {r["product_name"] for r in L.current(spark, root).read("products", "product_id INT, product_name STRING").collect()} == {"tea1", "milk1"}
    assert seen(popularity_mart.run(spark, src, root, database)) == new
    assert seen(spark.table(f"{database}.product_popularity")) == new
    assert spark.table(f"{database}.order_items").count() == 2
    number = L.current(spark, root).number
    assert seen(popularity_mart.run(spark, src, root, database)) == new and L.current(spark, root).number == number


def test_the_mart_recounts_touched_products_only(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    popularity_mart.run(spark, landed(tmp_path, 1, "1,1,2,10.00\n2,2,7,1.00\n"), root, "touched")
    counted = []
    keep = popularity_mart.popularity
    monkeypatch.setattr(popularity_mart, "popularity", lambda items, *a, **k: counted.append(items.count()) or keep(items, *a, **k))
    (tmp_path / "in" / "raw_order_items_9.csv").write_text("order_id,product_id,quantity,price\n2,1,1,1.00\n")
    found = popularity_mart.run(spark, str(tmp_path / "in"), root, "touched")
    assert counted == [2] and {r["product_id"]: r["total_quantity_sold"] for r in found.collect()} == {1: 3, 2: 7}


READING = StructType().add("id", "long", False).add("value", "double")


def test_a_thousand_batches_end_in_few_files(spark, tmp_path):
    table = str(tmp_path / "t")
    for part in range(10):
        rows = spark.range(part * 300, part * 300 + 300).select("id", F.lit(1.0).alias("value"), (F.col("id") / 3).cast("int").alias("batch_id"))
        rows.repartition(4, "batch_id").write.mode("append").partitionBy("batch_id").parquet(table)
        folding.fold(spark, table, READING, at_least=50, merged=4)
        if part == 4:
            assert folding.read(spark, table, READING).agg(F.count("*"), F.sum("id")).first() == ((part + 1) * 300, sum(range((part + 1) * 300)))
    assert folding.drop_folded(spark, table, keep=1) >= 999
    assert len(files(table)) == 1 and len(files(folding.records(table) + "/data")) <= 10
    assert folding.read(spark, table, READING).agg(F.count("*"), F.sum("id")).first() == (3_000, sum(range(3_000)))


def test_a_repeated_batch_is_seen_once_beside_folded_ones(spark, tmp_path, rows_of):
    src, table, rejects = tmp_path / "topic", str(tmp_path / "t"), str(tmp_path / "r")
    src.mkdir()

    def run():
        source = SM.message_source(spark, "text", str(src), maxFilesPerTrigger=1)
        SM.ingest_stream(source, READING, table, rejects, fold_every=2).awaitTermination()

    for i in range(7):
        (src / f"{i}.txt").write_text(f'{{"id":{i},"value":1}}\noops{i}\n')
    run()
    assert int(L.current(spark, folding.records(table)).marks["folded"]) == 5
    assert rows_of(SM.stored_records(spark, table, READING)) == [(i, 1.0) for i in range(7)]
    commits = Path(table) / "_checkpoint" / "commits"
    for name in ("6", ".6.crc"):  # the last batch was written, but the run ended before its commit
        os.remove(commits / name)
    run()
    folding.fold(spark, table, READING)
    folding.drop_folded(spark, table)
    assert rows_of(SM.stored_records(spark, table, READING)) == [(i, 1.0) for i in range(7)]
    assert len(rows_of(SM.stored_rejects(spark, rejects))) == 7
    (src / "8.txt").write_text('{"id":8,"value":1}\n')
    run()
    assert SM.stored_records(spark, table, READING).count() == 8
    shutil.rmtree(folding.records(table) + "/records/number=1")  # an old record is not needed
    assert SM.stored_records(spark, table, READING).count() == 8

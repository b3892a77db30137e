"""Inputs that once gave a wrong answer, stopped a job, or changed nothing."""

import os

import pytest
from pyspark.sql import functions as F

from tests.test_ingest import write
from tidemill.functions import scalar as S
from tidemill.jobs import graph_transactions, normalised_layer, popularity_mart, session_stats
from tidemill.operators import aggregates as A, changes as C, joins as J, modelling as M, ordering as O, quality as V
from tidemill.sources import sinks as K
from tidemill.streaming import messages as SM


def fresh(name):
    return f"tidemill_{os.urandom(5).hex()}.{name}"


def test_one_bad_cell_does_not_stop_the_load(spark, tmp_path):
    src, root, database = tmp_path / "in", str(tmp_path / "out"), fresh("x").split(".")[0]
    write(src / "raw_products_1.csv", "product_id,product_name\n1,pen\n")
    write(src / "raw_orders_1.csv", "order_id,order_date\n1,2024-01-01\n2,2024-01-02\n")
    for i, (quantity, price) in enumerate([("3000000000", "1.00"), ("1", "NaN"), ("1", "1e12"), ("1", "Infinity")]):
        write(src / f"raw_order_items_bad{i}.csv", f"order_id,product_id,quantity,price\n1,1,{quantity},{price}\n")
    popularity_mart.run(spark, str(src), root, database)
    write(src / "raw_order_items_good.csv", "order_id,product_id,quantity,price\n2,1,4,2.50\n")
    mart = popularity_mart.run(spark, str(src), root, database).collect()
    assert [(r["product_id"], r["total_quantity_sold"], str(r["total_revenue"])) for r in mart] == [(1, 4, "10.00")]
    rejected = {os.path.basename(r["file_path"]) for r in spark.read.parquet(f"{root}/rejects/order_items").collect()}
    assert rejected == {f"raw_order_items_bad{i}.csv" for i in range(4)}


def test_empty_files_are_recorded(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "out")
    write(src / "raw_products_a.csv", "product_id,product_name\n")
    write(src / "raw_products_b.csv", "")
    write(src / "raw_products_c.csv", "product_id,product_name\n1,pen\n")
    write(src / "raw_orders_a.csv", "order_id,order_date\n")
    write(src / "raw_order_items_a.csv", "order_id,product_id,quantity,price\n")
    for _ in range(2):
        popularity_mart.load_raw(spark, str(src), root)
    rows = spark.read.parquet(f"{root}/rejects/products").collect()
    assert sorted((os.path.basename(r["file_path"]), r["errors"]) for r in rows) == [
        ("raw_products_a.csv", ["the file is empty"]), ("raw_products_b.csv", ["the file is empty"])
    ]


def test_rejected_users_and_cards_are_stored(spark, tmp_path):
    schema = "user_id STRING, name STRING, surname STRING, age STRING, email STRING, phone STRING, card_number STRING"
    raw = spark.createDataFrame([("u1", "A", "B", "30", "e", "p", "c1"), ("u2", "A", "B", None, "e", "p", None)], schema)
    orders = "order_id INT, quantity INT, price_per_unit DOUBLE, total_price DOUBLE, card_number STRING, user_id STRING, product STRING"
    database = fresh("x").split(".")[0]
    for _ in range(2):
        normalised_layer.run(spark, raw, spark.createDataFrame([(1, 1, 1.0, 1.0, "c1", "u1", "pen")], orders), str(tmp_path), database)
    assert [r["user_id"] for r in spark.table(f"{database}.rejected_users").collect()] == ["u2"]
    assert "age" in spark.table(f"{database}.rejected_users").first()["errors"]
    assert [(r["card_number"], r["user_id"]) for r in spark.table(f"{database}.rejected_cards").collect()] == [(None, "u2")]
    assert spark.table(f"{database}.users").count() == 1


def test_sums_before_with_weights_below_zero(spark, rows_of):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 500, -1).when(F.col("id") % 7 == 0, None).otherwise(1).alias("w"))
    both = [rows_of(O.prefix_sum(rows, [], [O.asc("id")], F.col("w"), max_group_rows=m), "id", "before") for m in (None, 100)]
    assert both[0] == both[1] and dict(both[0])[500] == -500


@pytest.mark.parametrize("limit", [None, 3])
def test_groups_of_nulls_have_a_null_median(spark, rows_of, limit):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", None), ("b", None), (None, 5.0), ("c", 0.0), ("c", -4.0), ("c", -1.0), ("c", 9.0)], "k STRING, v DOUBLE")
    got = dict(rows_of(O.median_by(rows, ["k"], "v", max_group_rows=limit)))
    assert got == {"a": 1.5, "b": None, None: 5.0, "c": -0.5}


def test_wide_rows_are_split_by_bytes(spark, monkeypatch, rows_of):
    rows = spark.range(200).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert O.chunks_needed(rows, [], 1000) == 0
    monkeypatch.setattr(O, "MAX_GROUP_BYTES", 50_000)
    assert O.chunks_needed(rows, [], 1000) == 5
    assert rows_of(O.number_rows(rows, [O.asc("id")]), "id", "row_number") == sorted([(i, i + 1) for i in range(200)], key=repr)


def test_partitioned_tables_are_replaced(spark, tmp_path, rows_of):
    name = fresh("t")
    K.ensure_table(spark, name, "id INT, p INT", str(tmp_path), ["p"])
    K.append(spark.createDataFrame([(1, 1), (2, 2)], "id INT, p INT"), name)
    K.overwrite(spark.table(name).filter("p = 2").withColumn("id", F.col("id") * 10), name, str(tmp_path))
    assert rows_of(spark.table(name), "id", "p") == [(20, 2)]
    for _ in range(2):
        K.upsert_table(spark, name, spark.createDataFrame([(20, 3, 1), (5, 1, 1)], "id INT, p INT, at INT"), ["id"], ["at"], str(tmp_path))
    assert rows_of(spark.table(name), "id", "p") == [(20, 3), (5, 1)] or rows_of(spark.table(name), "id", "p") == [(5, 1), (20, 3)]


def test_null_keys_are_upserted_once(spark, rows_of):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "k INT, v STRING")
    new = spark.createDataFrame([(None, "c", 1), (2, "d", 1)], "k INT, v STRING, at INT")
    once = C.upsert(target, new, ["k"], ["at"])
    assert rows_of(once) == rows_of(C.upsert(once, new, ["k"], ["at"])) == sorted([(1, "a"), (None, "c"), (2, "d")], key=repr)
    assert C.new_rows(target, new, ["k"], ["at"]).count() == 1


def test_rerun_without_statistics_adds_nothing(spark, tmp_path):
    sessions = spark.createDataFrame([], "session_id STRING, duration_sec DOUBLE, at INT")
    events = spark.createDataFrame([], "session_id STRING, event_id INT")
    database = fresh("x").split(".")[0]
    for _ in range(3):
        found = session_stats.run(spark, sessions, events, str(tmp_path), database, ["at"])
    assert found.count() <= 1


def test_only_mergeable_aggregates_get_grouping_sets(spark, rows_of):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("a", "y", 5), ("b", "x", 7)], "g STRING, h STRING, v INT")
    got = A.grouping_sets(rows, ["g", "h"], [["g"], []], {"most": ("max", "v"), "least": ("min", F.col("v") + 1), "n": ("count", "*"), "s": ("sum", F.col("v") * 2)})
    assert rows_of(got, "g", "most", "least", "n", "s") == sorted([("a", 5, 2, 3, 18), ("b", 7, 8, 1, 14), (None, 7, 2, 4, 32)], key=repr)
    for other in (("avg", "v"), ("count_distinct", "v"), ("first", "v")):
        with pytest.raises(ValueError, match="cannot be merged"):
            A.grouping_sets(rows, ["g", "h"], [["g"]], {"x": other})


@pytest.mark.parametrize("seconds", [0, 1, 60])
def test_band_join_splits_either_side(spark, rows_of, seconds):
    # one bucket with nearly all rows, before a bucket with a few
    stamps = [10.0 + (i % 40) / 100 for i in range(400)] + [70.5, 71.0, 10.0, 131.0]
    rows = spark.createDataFrame(list(enumerate(stamps)), "id INT, s DOUBLE").withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")))
    pairs = lambda limit: rows_of(J.band_self_join(rows, "id", "ts", seconds, max_bucket_rows=limit), "a_id", "b_id")
    wanted = sorted(
        ((a, b) for a, x in enumerate(stamps) for b, y in enumerate(stamps) if (x, a) < (y, b) and round((y - x) * 1e6) <= seconds * 1e6), key=repr
    )
    assert pairs(50) == pairs(10_000) == wanted


def test_separators_and_white_space(spark):
    row = spark.createDataFrame([("12|34", "a.b . c", " \t\n", " ", "x")], "p STRING, d STRING, w STRING, u STRING, t STRING").select(
        S.part_after("p", "|"), S.split_cells("d", "."), S.blank("w"), S.blank("u"), S.blank("t"), S.part_after("t", "|")
    ).first()
    assert tuple(row) == ("34", ["a", "b", "c"], True, True, False, None)


def test_facts_without_a_name_stay_out_of_the_join(spark, rows_of):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "k LONG, name STRING")
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "zz")], "id INT, raw STRING")
    got = M.with_key(fact, M.Dimension(table, {"raw": "name"}, "k"), table)
    assert rows_of(got, "id", "k") == [(1, 1), (2, None), (3, 2), (4, None)]


def test_repeated_wide_rows(spark, rows_of):
    rows = spark.createDataFrame([("x" * 500, 1), ("x" * 500, 1), (None, None), (None, None), ("y", 1)], "t STRING, n INT")
    assert rows_of(V.check_duplicates(rows, wide=True)) == rows_of(V.check_duplicates(rows))


def test_graph_load_goes_on_from_the_tables_own_mark(spark, tmp_path):
    customers = spark.createDataFrame([("c", "C", "e", "2024-01-01")], "customer_id STRING, name STRING, email STRING, created_at STRING").withColumn("created_at", F.col("created_at").cast("timestamp"))

    def step(*stamps):
        rows = [(f"t{s}", 1.0, "USD", "x", "ok", s) for s in stamps]
        made = spark.createDataFrame([("c", r[0]) for r in rows], "src_id STRING, dst_id STRING")
        moved = spark.createDataFrame(rows, "transaction_id STRING, amount DOUBLE, currency STRING, type STRING, status STRING, timestamp STRING")
        moved = moved.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        return graph_transactions.run(spark, customers, made, moved, table, str(tmp_path), F.lit("2024-02-01").cast("timestamp")).count()

    table = fresh("moves")
    assert step("2024-01-01 10:00:00", "2024-01-01 12:00:00") == 2
    # within the look-back and later ones come in, the known one and one from long ago do not
    assert step("2024-01-01 08:00:00", "2024-01-01 11:58:00", "2024-01-01 12:00:00", "2024-01-01 13:00:00") == 4


def test_temporary_tables_keep_a_users_view(spark):
    spark.range(3).createOrReplaceTempView("tidemill_mine")
    with pytest.raises(Exception):
        with K.temp_table(spark.range(5), "tidemill_mine"):
            pass
    assert spark.table("tidemill_mine").count() == 3
    spark.catalog.dropTempView("tidemill_mine")


def test_backlogs_come_in_parts(spark, tmp_path):
    write(tmp_path / "a.txt", "one\n")
    for i in range(3):
        write(tmp_path / f"b{i}.txt", f"{i}\n")
    sizes = []
    stream = SM.message_source(spark, "text", str(tmp_path), maxFilesPerTrigger=1)
    stream.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count())).trigger(availableNow=True).start().awaitTermination()
    assert sizes == [1, 1, 1, 1] and SM.MAX_FILES and SM.MAX_OFFSETS

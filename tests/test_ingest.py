"""Incremental ingest: once each, restartable, bad input put aside."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.jobs import customer_totals, normalised_layer, object_store_load, popularity_mart, sensor_stream
from tidemill.session import shared_dir
from tidemill.sources import files as R, sinks as K
from tidemill.streaming import files as SF, messages as SM


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_files_are_taken_once_also_empty_ones(spark, tmp_path):
    src, root = tmp_path / "raw", str(tmp_path / "out")
    write(src / "data_1.csv", "id,value\n1,10\n2,20\n")
    write(src / "data_2.csv", "id,value\n")
    assert object_store_load.run(spark, str(src), root).count() == 2
    write(src / "data_3.csv", "id,value\n3,30\n4,oops\n")
    write(src / "data_4.csv", "id,value\n5,50\n")
    assert sorted(r["id"] for r in object_store_load.run(spark, str(src), root).collect()) == [1, 2, 5]
    assert object_store_load.run(spark, str(src), root).count() == 3
    names = [os.path.basename(r["file_path"]) for r in object_store_load.ledger(spark, root).collect()]
    assert sorted(names) == ["data_1.csv", "data_4.csv"]
    errors = spark.read.parquet(f"{root}/rejects").collect()
    assert [(r["id"], r["errors"]) for r in errors] == [("4", ["value must be of type int"])]


def test_wrong_headers_and_lines_are_put_aside(spark, tmp_path):
    src, root = tmp_path / "raw", str(tmp_path / "out")
    write(src / "a.csv", "id,value\n1,10\n")
    write(src / "b.csv", "value,id\n20,2\n")
    write(src / "c.csv", "id,value\n3,30,300\n")
    write(src / "d.csv", "id,value\n4\n")
    write(src / "e.csv", "")
    assert [r["id"] for r in object_store_load.run(spark, str(src), root).collect()] == [1]
    errors = {os.path.basename(r["file_path"]): r["errors"] for r in spark.read.parquet(f"{root}/rejects").collect()}
    assert errors["b.csv"] == ["the header is not id,value"]
    assert errors["c.csv"] == ["the line does not have 2 cells"]
    assert "value is empty" in errors["d.csv"] and set(errors) == {"b.csv", "c.csv", "d.csv"}
    with pytest.raises(Exception):
        R.read_csv(spark, str(src / "b.csv"), "id INT, value INT").collect()


def test_one_file_per_trigger_then_archived(spark, tmp_path):
    src = tmp_path / "in"
    for i in range(3):
        write(src / f"users_{i}.csv", f"id,value\n{i},1\n")
    archive, checkpoint = str(tmp_path / "done"), str(tmp_path / "checkpoint")
    schema = StructType.fromDDL("id INT, value INT")
    options = {"glob": "users_*.csv", "max_files": 1, "archive": archive}
    query = SF.ingest_new_files(spark, str(src), str(tmp_path / "t"), checkpoint, schema, **options)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    moved = sorted(p.name for p in (tmp_path / "done").rglob("*.csv"))
    assert moved and not {p.name for p in src.glob("*.csv")} & set(moved)
    write(src / "users_9.csv", "id,value\n9,1\n")
    SF.ingest_new_files(spark, str(src), str(tmp_path / "t"), checkpoint, schema, **options).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [0, 1, 2, 9]


PRODUCTS = "product_id,product_name\n1,tea\n2,milk\n"
ORDERS = "order_id,order_date\n1,2025-07-15\n2,2025-07-14\n"


def test_popularity_from_landing_files(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "out")
    write(src / "raw_products_1.csv", PRODUCTS)
    write(src / "raw_orders_1.csv", ORDERS)
    write(src / "raw_order_items_1.csv", "order_id,product_id,quantity,price\n1,1,2,10.00\n1,1,3,10.50\n2,2,1,4.00\n")
    write(src / "raw_order_items_2.csv", "order_id,product_id,quantity,price\n2,1,0,9.00\n2,1,1,9.00\n")

    def mart():
        rows = popularity_mart.run(spark, str(src), root, "popularity_test").collect()
        return {r["product_name"]: (r["total_quantity_sold"], str(r["total_revenue"]), r["order_count"]) for r in rows}

    first = {"tea": (3, "31.50", 1), "milk": (1, "4.00", 1)}
    assert mart() == first
    assert mart() == first
    rejects = spark.read.parquet(f"{root}/rejects/order_items").collect()
    assert [r["errors"] for r in rejects] == [["quantity must be a whole number above 0"]]
    write(src / "raw_order_items_3.csv", "order_id,product_id,quantity,price\n2,1,5,2.00\n2,1,5,2.00\n")
    write(src / "raw_order_items_4.csv", "order_id,product_id,quantity,price\n1,1,1,7.00\n")
    assert mart()["tea"] == (1, "7.00", 1)
    for name in ("products", "orders", "order_items", "product_popularity"):
        spark.sql(f"DROP TABLE popularity_test.{name}")
    assert mart() == {"tea": (1, "7.00", 1), "milk": (1, "4.00", 1)}


READING = StructType().add("id", "long", False).add("value", "double")


def test_stream_equals_batch_and_a_restart_adds_nothing(spark, tmp_path, rows_of):
    src = tmp_path / "topic"
    lines = ['{"id":1,"value":2.5}', '{"id":2}', '{"value":1}', '[]', 'oops', '{"id":"x","value":1}']
    write(src / "a.txt", "\n".join(lines) + "\n")
    good, bad = SM.split_bad(spark.read.text(str(src)), READING)
    assert rows_of(good) == [(1, 2.5), (2, None)]
    assert len(rows_of(bad)) == 4
    table, rejects = str(tmp_path / "t"), str(tmp_path / "r")

    def run():
        SM.ingest_stream(SM.message_source(spark, "text", str(src)), READING, table, rejects).awaitTermination()

    run()
    run()
    assert rows_of(SM.stored_records(spark, table, READING)) == rows_of(good)
    assert rows_of(SM.stored_rejects(spark, rejects)) == rows_of(bad)
    write(src / "b.txt", '{"id":3,"value":3}\n')
    run()
    assert rows_of(SM.stored_records(spark, table, READING)) == [(1, 2.5), (2, None), (3, 3.0)]


def test_a_repeated_batch_leaves_no_second_copy(spark, tmp_path):
    src = tmp_path / "topic"
    write(src / "a.txt", '{"sensor_id":"s","timestamp":"2024-01-01T00:00:00","value":1.5}\n')
    root = str(tmp_path / "out")
    messages = lambda: SM.message_source(spark, "text", str(src))
    assert sensor_stream.run(spark, messages(), root).count() == 1
    commit = f"{root}/sensor_readings/_checkpoint/commits/0"
    os.remove(commit)
    crc = f"{root}/sensor_readings/_checkpoint/commits/.0.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert sensor_stream.run(spark, messages(), root).count() == 1
    assert sensor_stream.rejects(spark, root).count() == 0


def test_sync_reads_from_the_target_mark(spark, rows_of):
    rows = spark.sql("SELECT id, timestamp_seconds(id * 60) AS ts FROM range(100)")
    target = rows.filter("id < 50 AND id <> 48")
    assert rows_of(SF.sync_new(rows, target, "ts", ["id"]), "id") == sorted([(48,)] + [(i,) for i in range(50, 100)], key=repr)
    assert SF.sync_new(rows, rows.filter("false"), "ts", ["id"]).count() == 100


def test_overwrite_can_read_its_own_table(spark, tmp_path, rows_of):
    root = str(tmp_path)
    K.ensure_table(spark, "own_test.t", "k INT, v STRING", root)
    K.append(spark.sql("SELECT 1 AS k, 'a' AS v"), "own_test.t")
    before = spark.table("own_test.t")
    K.overwrite(spark.table("own_test.t").withColumn("v", F.lit("b")), "own_test.t", root)
    assert rows_of(spark.table("own_test.t")) == [(1, "b")]
    assert rows_of(before) == [(1, "a")]
    K.ensure_table(spark, "own_test.t", "k INT, v STRING", root)
    assert rows_of(spark.table("own_test.t")) == [(1, "b")]


def test_a_failed_overwrite_changes_nothing(spark, tmp_path, rows_of):
    root = str(tmp_path)
    K.ensure_table(spark, "fail_test.t", "k INT", root)
    K.append(spark.sql("SELECT 1 AS k"), "fail_test.t")
    with pytest.raises(Exception):
        K.overwrite(spark.sql("SELECT cast('x' AS INT) AS k"), "fail_test.t", root)
    assert rows_of(spark.table("fail_test.t")) == [(1,)]


def test_only_named_partitions_are_replaced(spark, tmp_path, rows_of):
    K.ensure_table(spark, "part_test.t", "v INT, day STRING", str(tmp_path), ["day"])
    K.append(spark.sql("SELECT 1 AS v, 'mon' AS day UNION ALL SELECT 2, 'tue'"), "part_test.t")
    K.overwrite_partitions(spark.sql("SELECT 3 AS v, 'tue' AS day"), "part_test.t", ["day"])
    assert rows_of(spark.table("part_test.t")) == [(1, "mon"), (3, "tue")]


def test_upsert_touches_its_partitions_only(spark, tmp_path, rows_of):
    name = "touch_test.t"
    K.ensure_table(spark, name, "k INT, v STRING, part INT", str(tmp_path), ["part"])
    K.append(spark.sql("SELECT id AS k, 'a' AS v, id div 10 AS part FROM range(30)"), name)
    files = lambda part: set(spark.table(name).filter(f"part = {part}").inputFiles())
    untouched, touched = files(0), files(1)
    new = spark.sql("SELECT k, v, 1 AS part, n FROM VALUES (11, 'b', 1), (11, 'c', 2), (19, 'd', 1) AS t(k, v, n)")
    for _ in range(2):
        K.upsert_table(spark, name, new, ["k"], ["n"], str(tmp_path), ["part"])
    assert files(0) == untouched and files(1) != touched
    expected = [(i, {11: "c", 19: "d"}.get(i, "a"), i // 10) for i in range(30)]
    assert rows_of(spark.table(name)) == sorted(expected, key=repr)


def test_customer_totals_rerun(spark, tmp_path, rows_of):
    users = spark.createDataFrame([("Ann", "x", "c", 30, "1"), ("Bo", "y", "c", 31, "2")], customer_totals.USERS)
    orders = spark.sql("SELECT 1 AS id, 'tea' AS name, 2 AS count, 5.00 AS price, 10.00 AS total_cost, '1' AS card_number")
    for _ in range(2):
        mart = customer_totals.run(spark, users, orders, str(tmp_path), "totals_test")
    assert [(n, c, float(s)) for n, c, s in rows_of(mart)] == [("Ann", "1", 10.0), ("Bo", "2", 0.0)]


def test_prefix_slashes_and_row_counts(spark, tmp_path):
    full = write(tmp_path / "raw" / "a.csv", "id,value\n1,2\n")
    empty = write(tmp_path / "raw" / "b.csv", "id,value\n")
    rows = R.read_prefix(spark, f"{tmp_path}//raw", "id INT, value INT")
    assert [os.path.basename(r["file_path"]) for r in rows.collect()] == ["a.csv"]
    scan = R.read_csv(spark, str(tmp_path / "raw"), "id INT, value INT")
    counts = R.rows_per_file(scan, [full, f"file://{empty}"])
    assert {os.path.basename(r["file_path"]): r["n_rows"] for r in counts.collect()} == {"a.csv": 1, "b.csv": 0}


def test_scratch_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == named.rstrip("/") if named else shared_dir(spark)


def test_jobs_by_command_line(spark, tmp_path):
    from tidemill.jobs.__main__ import arguments, run

    write(tmp_path / "raw" / "data_1.csv", "id,value\n1,10\n2,20\n")
    args = ["object_store_load", str(tmp_path / "raw"), "--root", str(tmp_path / "out")]
    assert run(spark, arguments().parse_args(args)).count() == 2
    spark.sql("SELECT 'c1' AS customer_id, 'Ann' AS name, 'a@b' AS email, TIMESTAMP '2024-01-01' AS created_at").write.parquet(str(tmp_path / "c"))
    spark.sql("SELECT 'c1' AS src_id, id AS dst_id FROM VALUES ('t1'), ('t2') AS v(id)").write.parquet(str(tmp_path / "m"))
    spark.sql("""SELECT id AS transaction_id, CAST(NULL AS DOUBLE) AS amount, 'USD' AS currency, 'deposit' AS type, 'completed' AS status, at AS timestamp
                 FROM VALUES ('t1', TIMESTAMP '2024-01-01'), ('t2', TIMESTAMP '2024-03-01') AS v(id, at)""").write.parquet(str(tmp_path / "t"))
    args = ["graph_transactions", *[str(tmp_path / p) for p in "cmt"], "--root", str(tmp_path / "out"),
            "--database", "command_test", "--since", "2024-02-01", "--load-ts", "2024-04-01"]
    for _ in range(2):
        found = run(spark, arguments().parse_args(args)).collect()
        assert [(r["transaction_id"], r["customer_name"], r["amount"]) for r in found] == [("t2", "Ann", 0.0)]


def test_layer_takes_new_raw_rows_only(spark, tmp_path, monkeypatch):
    src, root = tmp_path / "in", str(tmp_path / "out")
    users = "user_id,name,surname,age,email,phone,card_number\n"
    orders = "order_id,product,quantity,price_per_unit,total_price,card_number,user_id\n"
    write(src / "users_1.csv", users + "u1,A,B,30,e,p,c1\nu2,A,B,,e,p,c2\n")
    write(src / "users_2.csv", "name,user_id\nA,u9\n")  # put aside; the others go on
    write(src / "orders_1.csv", orders + "1,pen,1,1.00,1.00,c1,u1\n")
    write(src / "deliveries_1.csv", ",".join(f.split()[0] for f in normalised_layer.RAW["deliveries"][0].split(", ")) + "\n")
    seen = []
    keep = normalised_layer.load_orders
    monkeypatch.setattr(normalised_layer, "load_orders", lambda s, rows, d: seen.append(rows.count()) or keep(s, rows, d))
    assert normalised_layer.run_files(spark, str(src), root, "layer_by_batch").count() == 1
    write(src / "orders_2.csv", orders + "2,pen,1,1.00,1.00,c1,u1\n3,ink,x,1.00,1.00,c1,u1\n")
    write(src / "users_3.csv", users + "u3,A,B,,e,p,c3\n")
    for _ in range(2):
        found = normalised_layer.run_files(spark, str(src), root, "layer_by_batch").collect()
    assert sorted((r["order_id"], r["product_id"]) for r in found) == [(1, 1), (2, 1)] and seen == [1, 1]
    assert sorted(r["user_id"] for r in spark.table("layer_by_batch.rejected_users").collect()) == ["u2", "u3"]
    assert [r["order_id"] for r in spark.read.parquet(f"{root}/rejects/orders").collect()] == ["3"]
    assert {os.path.basename(r["file_path"]) for r in spark.read.parquet(f"{root}/rejects/users").collect()} == {"users_2.csv"}

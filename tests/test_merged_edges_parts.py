"""merged_edges gives its join and merges tasks in proportion to the lines, not the session's shuffle partitions."""

from tidemill.plans import all_queries, storage


def test_merged_edges_tasks_grow_with_the_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "EDGE_ROWS_PER_TASK", 2)
    lines = [(k % 4, p, "A" if p % 2 else "N") for k in range(4) for p in (1, 2, 2, 3)]
    spark.createDataFrame(lines, "l_orderkey LONG, l_partkey LONG, l_returnflag STRING").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(0, 10), (1, 10), (2, 20), (3, None)], "o_orderkey LONG, o_custkey LONG").write.parquet(str(tmp_path / "orders.parquet"))
    found = all_queries()["merged_edges"].run(spark, str(tmp_path))
    assert sorted(found.collect(), key=str) == sorted(
        [(10, 1), (10, 2), (10, 3), (20, 1), (20, 2), (20, 3), (None, 1), (None, 2), (None, 3)], key=str
    )
    assert found.rdd.getNumPartitions() >= 8  # 16 lines, 2 a task

"""Buckets, bloom filters, statistics, day partitions, derived normal forms and lateral table functions, by their plans."""

import pytest
from pyspark.sql import functions as F

from tidemill.operators import changes as C, dependencies as D, modelling as M, shape as P
from tidemill.plans import all_queries
from tidemill.plans.layouts import FOUR_TABLES, analysed
from tidemill.plans.registry import Tables
from tidemill.sources import layouts as L, sinks as K
from tidemill.streaming import files as SF

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sort_merge(spark):
    """Without broadcasts, as for large tables."""
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path, sort_merge):
    left = L.store_bucketed(spark.range(1_000).selectExpr("id AS k", "id % 7 AS a"), "bucketed_left", ["k"], 8, str(tmp_path))
    right = L.store_bucketed(spark.range(0, 1_000, 3).selectExpr("id AS k", "id % 5 AS b"), "bucketed_right", ["k"], 8, str(tmp_path))
    joined = left.join(right, "k")
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    assert joined.count() == 334 and len(left.inputFiles()) == 8


def test_a_bucketed_upsert_moves_the_new_rows_only(spark, tmp_path, rows_of, sort_merge):
    old = spark.range(1_000).select(F.when(F.col("id") % 100 != 0, F.col("id")).alias("k"), F.lit("old").alias("v"), F.lit(0).alias("n"))
    L.store_bucketed(old, "bucketed_target", ["k"], 8, str(tmp_path))
    new = spark.createDataFrame([(5, "a", 1), (5, "b", 2), (2_000, "c", 1), (None, "d", 1)], "k BIGINT, v STRING, n INT")
    merged = plan(L.merged_by_bucket(spark.table("bucketed_target"), new, ["k"], ["n"], 8))
    big = merged[: merged.index("LeftAnti")] if "LeftAnti" in merged else merged
    scan = [line for line in big.splitlines() if "FileScan" in line]
    assert scan and "Bucketed: true" in scan[0]
    before = big[: big.index(scan[0])].splitlines()
    depth = len(scan[0]) - len(scan[0].lstrip(" :+-"))
    above = [line for line in before if len(line) - len(line.lstrip(" :+-")) < depth]
    assert "SortMergeJoin" in "".join(above) and not any("Exchange" in line for line in above)
    done = L.upsert_bucketed(spark, "bucketed_target", new, ["k"], ["n"], 8, str(tmp_path))
    assert rows_of(done) == rows_of(C.upsert(old, new, ["k"], ["n"]))
    again = L.upsert_bucketed(spark, "bucketed_target", new, ["k"], ["n"], 8, str(tmp_path))
    assert rows_of(again) == rows_of(C.upsert(old, new, ["k"], ["n"]))


def rows_scanned(df) -> int:
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    rows = spark.range(100_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("k"))
    value = rows.filter("id = 4321").first()["k"]
    plain = L.write_with_blooms(rows, str(tmp_path / "plain"), {}, ["id"], 128 * 1024)
    bloom = L.write_with_blooms(rows, str(tmp_path / "bloom"), {"k": 10_000}, ["id"], 128 * 1024)
    found = [spark.read.schema("id BIGINT, k BIGINT").parquet(p).filter(F.col("k") == value) for p in (plain, bloom)]
    scanned = [rows_scanned(df) for df in found]
    assert scanned[1] < scanned[0] / 3 and found[0].collect() == found[1].collect() != []


def test_joins_are_ordered_by_statistics(spark, sort_merge):
    names = analysed(Tables(spark, FOLDER))
    sql = FOUR_TABLES.format(**names)
    order = lambda df: [line.split("FileScan parquet ")[1].split("[")[0].split(".")[-1] for line in plan(df).splitlines() if "FileScan" in line]
    plain, by_cost = order(spark.sql(sql)), order(L.by_statistics(spark).sql(sql))
    assert plain == ["lineitem", "orders", "customer", "part"]
    assert sorted(by_cost) == sorted(plain) and {by_cost[0], by_cost[1]} == {"orders", "customer"}


def test_days_before_the_mark_are_pruned(spark, tmp_path, rows_of):
    K.ensure_table(spark, "by_day.events", "id BIGINT, ts TIMESTAMP_NTZ, day DATE", str(tmp_path), ["day"])
    source = spark.range(240).select("id", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(hours=F.col("id"))).alias("ts"))
    assert SF.sync_by_day(source.filter("id < 200 AND id <> 190"), "by_day.events", "ts", ["id"], "12 hours").count() == 199
    seen = []
    keep = SF.materialise
    try:
        SF.materialise = lambda df, kind="cut": seen.append(plan(df)) or keep(df, kind)
        assert rows_of(SF.sync_by_day(source, "by_day.events", "ts", ["id"], "12 hours"), "id") == [(i,) for i in sorted([190, *range(200, 240)], key=lambda x: repr((x,)))]
    finally:
        SF.materialise = keep
    pruned = [line for line in seen[0].splitlines() if "PartitionFilters" in line and "day" in line]
    assert pruned and ">= 2024-01-08" in pruned[0]
    assert SF.sync_by_day(source, "by_day.events", "ts", ["id"], "12 hours").count() == 0
    assert spark.table("by_day.events").count() == 240


def test_many_arguments_are_one_hash_join(spark):
    for name in ("delays_of_many_places", "fill_of_many_places"):
        text = plan(all_queries()[name].run(spark, FOLDER))
        assert "NestedLoop" not in text and "Cartesian" not in text and "HashJoin" in text


ORDERS = ["order", "client", "name", "city", "region", "item", "qty"]
RULES = [
    D.depends("order", "client name"), D.depends("client", "name city"), D.depends("city", "region"),
    D.depends("order item", "qty city"), D.depends("order client", "region"),
]


def test_closure_cover_and_key():
    assert D.closure(frozenset(["order"]), RULES) == {"order", "client", "name", "city", "region"}
    assert set(D.minimal_cover(RULES)) == {
        D.depends("order", "client"), D.depends("client", "name"), D.depends("client", "city"), D.depends("city", "region"), D.depends("order item", "qty"),
    }
    assert D.candidate_key(ORDERS, RULES) == {"order", "item"}
    assert D.candidate_key(["a", "b", "c"], [D.depends("a", "b"), D.depends("b", "a"), D.depends("b", "c")]) == {"a"}


@pytest.mark.parametrize("columns, rules, tables", [
    (ORDERS, RULES, [["city", "region"], ["client", "name", "city"], ["order", "client"], ["order", "item", "qty"]]),
    (["a", "b", "c"], [D.depends("a", "b")], [["a", "b"], ["a", "c"]]),
    (["a", "b"], [], [["a", "b"]]),
    (["a", "b", "c"], [D.depends("a b", "c"), D.depends("c", "b")], [["a", "b", "c"]]),
])
def test_third_normal_form(columns, rules, tables):
    assert sorted(D.third_normal_form(columns, rules)) == sorted(tables)


def flat(spark, extra=()):
    rows = [(o, o % 4, f"n{o % 4}", None if o % 4 == 3 else o % 2, "r", i, o + i) for o in range(12) for i in range(3)]
    return spark.createDataFrame([*rows, *extra], "order INT, client INT, name STRING, city INT, region STRING, item INT, qty INT")


def test_derived_tables_join_back(spark, rows_of):
    df = flat(spark, [(None, None, "n", None, "r", None, 1)])
    tables = D.split(df, RULES)
    assert len(tables) == 4 and rows_of(D.join_back(tables, df.columns)) == rows_of(df) and D.lossless(df, tables)
    assert D.split(df.limit(0), RULES)[0].count() == 0


def test_broken_dependencies_are_an_error_with_their_rows(spark, rows_of):
    df = flat(spark, [(1, 1, "other", 1, "r", 7, 1)])
    with pytest.raises(D.BrokenDependency, match="order does not determine client, name") as found:
        D.split(df, RULES)
    assert {r["order"] for r in found.value.rows.collect()} == {1} and found.value.rows.count() == 4
    assert {r["dependency"]: r["n_broken"] for r in D.broken_report(df, RULES).collect()} == {
        "order -> client name": 1, "client -> city name": 1, "city -> region": 0, "item order -> city qty": 0, "client order -> region": 0,
    }
    assert not D.lossless(df, [df.select(*c).distinct() for c in D.third_normal_form(df.columns, RULES)])
    split = spark.createDataFrame([(1, "a", "X"), (1, "b", "Y")], "k INT, v STRING, w STRING")
    with pytest.raises(ValueError, match="k does not determine v"):
        M.decompose(split, {"t": (["k"], ["v"])})


def test_wide_rows_are_made_unique_by_hashes(spark, rows_of):
    rows = spark.createDataFrame([("a" * 500, 1), ("a" * 500, 1), (None, 1), (None, 1), ("b", None), ("", 2)], "text STRING, n INT").repartition(3)
    assert rows_of(P.dedup_rows(rows, wide=True)) == rows_of(P.dedup_rows(rows))

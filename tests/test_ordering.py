"""Chunk borders by value, medians by narrowing, parts by bytes."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemill.operators import ordering as O


@pytest.fixture(scope="module")
def mixed(spark):
    """Rows with nulls, ties and all kinds of order columns."""
    rng = random.Random(3)
    rows = []
    for i in range(2_000):
        t = None if i % 13 == 0 else datetime.datetime(2024, 1, 1) + datetime.timedelta(microseconds=rng.randrange(10**12))
        d = rng.choice([None, float("nan"), float("inf"), -0.0, 0.0, rng.gauss(0, 1e9), 1e-300, rng.gauss(0, 1)])
        s = rng.choice([None, "", "é", 'quote " and \\', "z" * 40, f"s{rng.randrange(99)}"])
        rows.append((i, t, d, s, None if i % 5 == 0 else t and t.date(), "hot" if i % 4 else f"k{i % 12}"))
    return spark.createDataFrame(rows, "id BIGINT, t TIMESTAMP_NTZ, d DOUBLE, s STRING, day DATE, k STRING").repartition(5).cache()


ORDERS = [
    [O.desc("d"), O.asc("s"), O.desc("id")], [O.asc("day"), O.desc("t"), O.asc("id")], [O.asc("s"), O.asc("d"), O.asc("id")],
]


@pytest.mark.parametrize("order", ORDERS, ids=lambda o: "-".join(("-" if c.descending else "+") + c.name for c in o))
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_chunks_follow_the_order(mixed, rows_of, order, keys):
    plain = rows_of(O.number_rows(mixed, order, keys, max_group_rows=None), "id", "row_number")
    assert rows_of(O.number_rows(mixed, order, keys, max_group_rows=100), "id", "row_number") == plain
    move = O.next_value if keys else O.prev_value
    plain = rows_of(move(mixed, keys, order, "s", "other", max_group_rows=None), "id", "other")
    assert rows_of(move(mixed, keys, order, "s", "other", max_group_rows=100), "id", "other") == plain


def test_chunks_are_even_and_rows_keep_theirs(mixed):
    order = [O.asc("t"), O.asc("id")]
    split = O.split_ranges(mixed, [], order, 20)
    sizes = [r["count"] for r in split.groupBy(O.CHUNK).count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 3 * 2_000 / 20
    first, again = (dict((r["id"], r[O.CHUNK]) for r in split.repartition(n).collect()) for n in (2, 7))
    assert first == again


def test_ranks_of_a_hot_value(spark, rows_of):
    rows = spark.range(3_000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(400))).alias("v"))
    for descending in (True, False):
        plain = rows_of(O.rank_rows(rows, "v", descending, max_group_rows=None))
        split = O.rank_rows(rows, "v", descending, max_group_rows=100)
        assert rows_of(split) == plain
        assert "SortMergeJoin" not in split._jdf.queryExecution().executedPlan().toString()


def scanned(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[text.index("ReadSchema") :].split(">")[0]


def test_measuring_reads_keys_and_order_only(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    read = scanned(O.measured(events, ["user_id"], [O.asc("ts"), O.asc("event_id")], "ts"))
    assert "props" not in read and "event_type" not in read and "value" not in read and "user_id" in read


def test_no_frame_is_written(mixed, monkeypatch):
    written = []
    keep = O.materialise
    monkeypatch.setattr(O, "materialise", lambda df, kind="cut": written.append((kind, df.count())) or keep(df, kind))
    O.number_rows(mixed, [O.asc("t"), O.asc("id")], ["k"], max_group_rows=100).count()
    O.rank_rows(mixed, "d", max_group_rows=100).count()
    O.next_value(mixed, ["k"], [O.asc("t"), O.asc("id")], "s", "other", max_group_rows=100).count()
    assert written and max(n for _, n in written) <= 3 * 2_000 / 100


VALUES = {
    "hot": [random.Random(1).lognormvariate(0, 20) for _ in range(999)] + [5.0] * 300 + [None] * 50,
    "even": [float(i) for i in range(400)], "ties": [1.0] * 301 + [2.0] * 301, "one": [3.0] * 500,
    "wide": [1e308, -1e308, 5e-324, 0.0, -5e-324] * 60, "small": [1.0, 9.0], "nulls": [None] * 400, None: [7.0, 8.0] * 200,
}


@pytest.mark.parametrize("buckets", [1_000, 20])
def test_medians_by_narrowing(spark, monkeypatch, buckets):
    monkeypatch.setattr(O, "BUCKETS", buckets)
    rows = [(k, v) for k, values in VALUES.items() for v in values]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE").repartition(6)
    got = {r["k"]: r["median"] for r in O.median_by(df, ["k"], "v", max_group_rows=100).collect()}
    assert got == {k: statistics.median(p) if (p := [x for x in v if x is not None]) else None for k, v in VALUES.items()}
    everything = [v for _, v in rows if v is not None]
    assert O.median_by(df, [], "v", max_group_rows=100).collect()[0][0] == statistics.median(everything)


def test_medians_with_infinite_values(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([("a", v) for v in [-inf, inf, nan, 1.0, 2.0, 3.0, 4.0] * 40] + [("b", v) for v in [inf, -inf, -inf] * 60], "k STRING, v DOUBLE")
    assert {r["k"]: r["median"] for r in O.median_by(df, ["k"], "v", max_group_rows=50).collect()} == {"a": 3.0, "b": -inf}


def test_histograms_are_bounded_by_keys_times_buckets(spark):
    rows = spark.range(20_000).select((F.col("id") % 2).cast("string").alias("k"), F.rand(1).alias("_v"))
    bounds = rows.groupBy("k").agg(F.min("_v").alias("_min"), F.max("_v").alias("_max")).selectExpr("k", "5L AS _low", "5L AS _high", "0L AS _below", "_min", "_max")
    assert O.histogram(rows, bounds, ["k"]).count() <= 2 * O.BUCKETS
    plan = O.median_by(rows.withColumnRenamed("_v", "v"), ["k"], "v", max_group_rows=100)._jdf.queryExecution().toString()
    assert "Sort [" not in plan


def test_arrays_are_bounded_by_bytes(spark):
    rows = spark.range(60).select(F.lit("a").alias("k"), F.repeat(F.lpad(F.col("id").cast("string"), 3, "0"), 100).alias("v"))
    found = O.ordered_array(rows, ["k"], "v", max_bytes=3_000).orderBy("part").collect()
    assert [v for r in found for v in r["items"]] == sorted(r["v"] for r in rows.collect())
    assert len(found) == 6 and max(sum(map(len, r["items"])) for r in found) <= 3_300
    assert sorted(r["part"] for r in found) == list(range(6))

"""Hot keys give the same rows by the split way as by the plain one, and plans keep their shape."""

import pytest
from pyspark.sql import functions as F

from tidemill.operators import aggregates as A, joins as J, ordering as O, shape as P
from tidemill.plans import all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; one key has two thirds, a null key and many equal values occur."""
    rows = spark.range(3_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 30 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("k"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(50))).alias("v"),
    )
    return rows.cache()


def order():
    return [O.asc("v"), O.asc("id")]


SPLIT = {"max_group_rows": 200}


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_positions(skewed, rows_of, keys):
    plain = rows_of(O.number_rows(skewed, order(), keys))
    assert rows_of(O.number_rows(skewed, order(), keys, **SPLIT)) == plain
    assert rows_of(O.number_rows(skewed, order(), keys, max_group_rows=None)) == plain


@pytest.mark.parametrize("move", [O.next_value, O.prev_value])
@pytest.mark.parametrize("part", [[], ["k"]])
def test_neighbours(skewed, rows_of, move, part):
    plain = move(skewed, part, order(), "v", "other")
    assert rows_of(move(skewed, part, order(), "v", "other", **SPLIT), *plain.columns) == rows_of(plain)


def test_ranks(skewed, rows_of):
    for descending in (True, False):
        plain = O.rank_rows(skewed, "id", descending)
        assert rows_of(O.rank_rows(skewed, "id", descending, **SPLIT)) == rows_of(plain)


def test_medians(skewed, rows_of):
    plain = O.median_by(skewed, ["k"], "id")
    assert rows_of(O.median_by(skewed, ["k"], "id", **SPLIT)) == rows_of(plain)


def test_arrays_in_parts_are_whole(skewed):
    def lists(**options):
        found = {}
        for row in O.ordered_array(skewed, ["k"], "v", **options).orderBy("k", "part").collect():
            found.setdefault(row["k"], []).extend(row["items"])
        return found

    assert lists(max_items=90, **SPLIT) == lists()
    assert max(len(r["items"]) for r in O.ordered_array(skewed, ["k"], "v", max_items=90).collect()) == 90


@pytest.mark.parametrize("both", [True, False])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_band_join_equals_the_naive_join(spark, rows_of, keys, both):
    base = spark.range(400).select(
        F.col("id"), F.when(F.col("id") % 3 != 0, "hot").otherwise("cold").alias("k"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(4_000)) - 2_000).alias("ts"),
    )
    found = J.band_self_join(base, "id", "ts", 60, keys, both)
    salted = J.band_self_join(base, "id", "ts", 60, keys, both, max_bucket_rows=2)
    a, b = base.alias("a"), base.alias("b")
    near = F.abs(F.col("a.ts").cast("long") - F.col("b.ts").cast("long")) <= 60
    other = F.col("a.id") != F.col("b.id")
    if not both:
        other = F.struct("a.ts", "a.id") < F.struct("b.ts", "b.id")
    equal = F.col("a.k") == F.col("b.k") if keys else F.lit(True)
    naive = a.join(b, near & other & equal).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))
    assert naive.count() > 0
    assert rows_of(found, "a_id", "b_id") == rows_of(naive)
    assert rows_of(salted, "a_id", "b_id") == rows_of(naive)


def test_matched_and_unmatched_are_all(skewed):
    some = skewed.filter("v > 25").select("id")
    assert J.not_in(skewed, some, ["id"]).count() + skewed.join(some, "id").count() == skewed.count()


def test_grand_total_is_the_count(skewed):
    found = A.grouping_sets(skewed, ["k", "v"], [["k"], ["v"], []], {"n": ("count", "*")})
    by_set = {r["grouping_id"]: r["n"] for r in found.groupBy("grouping_id").agg(F.sum("n").alias("n")).collect()}
    assert by_set == {1: 3_000, 2: 3_000, 3: 3_000}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_plans_a_cross_join(spark):
    for name, query in all_queries().items():
        text = plan(query.run(spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(all_queries()["chosen_suppliers"].run(spark, FOLDER))
    assert "In(l_suppkey, [3,7,9])" in text and "LessThan(l_linenumber,4)" in text
    assert "l_extendedprice" not in text
    text = plan(all_queries()["orders_before"].run(spark, FOLDER))
    assert "LessThan(o_orderdate,1996-01-01T00:00)" in text


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(all_queries()["top_customers"].run(spark, FOLDER))


def test_key_dedup_combines_before_the_shuffle(skewed):
    text = plan(P.last_per_key(skewed, ["k"], ["id"]))
    assert text.count("max_by") >= 2 and "Window" not in text

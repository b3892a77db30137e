from pyspark.sql import functions as F

from tidemill.operators import joins as J


def found(rows, rows_of, limit):
    pairs = J.band_self_join(rows, "id", "ts", 60, ["k"], max_bucket_rows=limit)
    return rows_of(pairs, "a_id", "b_id"), pairs._jdf.queryExecution().optimizedPlan().toString()


def test_many_even_buckets_are_not_copied(spark, rows_of):
    rows = spark.range(2_400).select("id", (F.col("id") % 2).alias("k"), F.timestamp_seconds(F.col("id") * 3 + 0.5).alias("ts"))
    pairs, plan = found(rows, rows_of, 3)
    assert "salt" not in plan
    whole = found(rows, rows_of, 10_000)[0]
    assert pairs == whole and len(whole) == sum(min(10, i) for i in range(1_200)) * 2


def test_a_bucket_above_a_share_is_spread(spark, rows_of):
    one = spark.range(300).select("id", F.lit(0).alias("k"), F.timestamp_millis(F.col("id") * 10).alias("ts"))
    pairs, plan = found(one, rows_of, 3)
    assert "salt" in plan and len(pairs) == 300 * 299 // 2
    assert pairs == found(one, rows_of, 10_000)[0]

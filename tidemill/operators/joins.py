"""Joins. Sides are never forced to broadcast: Spark does so when it sees a small one, and
adaptive execution splits the partitions of a hot key otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.operators.ordering import same

MAX_BUCKET_ROWS = 50_000
MAX_BROADCAST_ROWS = 100_000
CELLS_PER_TASK = 4  # that large buckets of a band join are cut into, for each shuffle partition


def inner(a: DataFrame, b: DataFrame, on) -> DataFrame:
    return a.join(b, on, "inner")


def join_roles(
    fact: DataFrame, dim: DataFrame, roles: dict[str, str], dim_key: str, columns: list[str]
) -> DataFrame:
    """Joins one dimension several times. ``roles`` maps a prefix to the fact's key column;
    the dimension's ``columns`` come out as ``prefix_column``."""
    for prefix, key in roles.items():
        role_key = f"_{prefix}_key"
        side = dim.select(
            F.col(dim_key).alias(role_key), *[F.col(c).alias(f"{prefix}_{c}") for c in columns]
        )
        fact = fact.join(side, fact[key] == side[role_key]).drop(role_key)
    return fact


def star_join(
    fact: DataFrame, others: list[tuple[DataFrame, Column]], where: Column, columns: list[str]
) -> DataFrame:
    """Joins a fact to several tables under one filter; Catalyst moves the filter to the scans."""
    for table, on in others:
        fact = fact.join(table, on)
    return fact.filter(where).select(*columns)


def left_default(a: DataFrame, b: DataFrame, on, defaults: dict) -> DataFrame:
    """Left join; the named columns get a default where the right side is missing or null."""
    joined = a.join(b, on, "left")
    return joined.withColumns({c: F.coalesce(joined[c], F.lit(v)) for c, v in defaults.items()})


def lookup_key(fact: DataFrame, dim: DataFrame, natural: str, dim_natural: str, surrogate: str) -> DataFrame:
    """Adds the dimension's surrogate key, found by natural name; null where there is none."""
    side = dim.select(F.col(dim_natural).alias("_natural"), surrogate)
    return fact.join(side, fact[natural] == side["_natural"], "left").drop("_natural")


def not_in(new: DataFrame, existing: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``. A null in a key is in nothing, or with
    ``null_safe`` a value like others."""
    if null_safe:
        side = existing.select(*[F.col(k).alias(f"_e_{k}") for k in keys])
        return new.join(side, same([new[k] for k in keys], [side[f"_e_{k}"] for k in keys]), "left_anti")
    return new.join(existing.select(*keys), keys, "left_anti")


def band_self_join(
    df: DataFrame, id: str, ts: str, seconds: int, eq_keys: list[str] = (), ordered_pairs: bool = False,
    max_bucket_rows: int = MAX_BUCKET_ROWS,
) -> DataFrame:
    """Pairs of rows at most ``seconds`` apart, with equal ``eq_keys``; columns ``a_id``, ``b_id``,
    ``gap_sec`` and the equality keys.

    Each pair comes once, the earlier row first; ``ordered_pairs`` gives it in both directions.
    Rows meet by time bucket: the later row in its own, the earlier one in its own and the next,
    so a pair meets exactly once and only neighbours in time are compared. Buckets with more than
    ``max_bucket_rows`` rows on either side are spread over a grid: each side's rows over salts of
    their own and to every salt of the other side. The copies this takes grow with the square of a bucket,
    so a bucket that gives less to compare than a task's share of the whole join stays in one place however
    many rows it has, and grids are no finer than that share. No seconds means equal times.
    """
    eq_keys = list(eq_keys)
    base = df.select(
        F.col(id).alias("_id"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"),
        *eq_keys,
    ).filter(F.col("_us").isNotNull())
    band = seconds * 1_000_000
    width = max(band, 1)
    bucket = F.expr(f"_us div {width} - if(_us % {width} < 0, 1, 0)")
    meet = [*eq_keys, "_bucket"]
    later = base.withColumn("_bucket", bucket)
    earlier = later.withColumn("_bucket", F.explode(F.array(F.col("_bucket"), F.col("_bucket") + 1)))

    both = later.select(*meet, F.lit(1).alias("_l"), F.lit(0).alias("_e")).unionByName(
        earlier.select(*meet, F.lit(0).alias("_l"), F.lit(1).alias("_e"))
    )
    sizes = both.groupBy(*meet).agg(F.sum("_l").alias("_l"), F.sum("_e").alias("_e"))
    sizes = sizes.filter((F.greatest("_l", "_e") > max_bucket_rows) & (F.least("_l", "_e") > 0))
    n_hot, most, met = sizes.agg(
        F.count("*"), F.max(F.greatest("_l", "_e")), F.sum(F.col("_l").cast("double") * F.col("_e"))
    ).first()
    if n_hot:
        share = met / (CELLS_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        side = max(max_bucket_rows, math.isqrt(int(share)))
        sizes = sizes.filter(F.greatest("_l", "_e") > side)
        n_hot = 0 if most <= side else sizes.count()
    if n_hot:
        parts = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / side)).cast("int")
        hot = sizes.select(*meet, parts("_l").alias("_lsalts"), parts("_e").alias("_esalts"))
        hot = F.broadcast(hot) if n_hot <= MAX_BROADCAST_ROWS else hot
        own = lambda c: F.pmod(F.xxhash64("_id"), F.coalesce(c, F.lit(1))).cast("int")
        every = lambda c: F.explode(F.sequence(F.lit(0), F.coalesce(c, F.lit(1)) - 1))
        later = later.join(hot, meet, "left").withColumn("_lsalt", own("_lsalts")).withColumn("_esalt", every("_esalts"))
        earlier = earlier.join(hot, meet, "left").withColumn("_esalt", own("_esalts")).withColumn("_lsalt", every("_lsalts"))
        meet = [*meet, "_lsalt", "_esalt"]

    a = earlier.select(*[F.col(c).alias(f"_a_{c}") for c in ["_id", "_us", *meet]])
    b = later.select("_id", "_us", *meet)
    in_order = (F.col("_a__us") < F.col("_us")) | (
        (F.col("_a__us") == F.col("_us")) & (F.col("_a__id") < F.col("_id"))
    )
    near = F.col("_us") - F.col("_a__us") <= band
    equal = [a[f"_a_{c}"] == b[c] for c in meet]
    pairs = a.join(b, [*equal, in_order, near]).select(
        F.col("_a__id").alias("a_id"),
        F.col("_id").alias("b_id"),
        ((F.col("_us") - F.col("_a__us")) / 1_000_000).alias("gap_sec"),
        *eq_keys,
    )
    if not ordered_pairs:
        return pairs
    both = F.array(F.struct("a_id", "b_id"), F.struct(F.col("b_id").alias("a_id"), F.col("a_id").alias("b_id")))
    return pairs.withColumn("_pair", F.explode(both)).select("_pair.a_id", "_pair.b_id", "gap_sec", *eq_keys)


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Adds the columns of a one-row frame to every row, as scalar subqueries; no join is planned.

    More than one row is an error.
    """
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


def join_aggregates(base: DataFrame, parts: list[tuple[DataFrame, str, dict[str, Column]]]) -> DataFrame:
    """Joins a frame to others that are first aggregated by the join key: ``(frame, key, aggregates)``."""
    for part, key, aggregates in parts:
        summed = part.groupBy(key).agg(*[agg.alias(name) for name, agg in aggregates.items()])
        base = base.join(summed, key)
    return base


def count_children(parent: DataFrame, child: DataFrame, key: str, name: str = "n_children") -> DataFrame:
    """Adds the number of child rows to each parent, 0 when there are none.

    Children are counted before the join, so a parent with most of the rows is no burden.
    """
    counts = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name))
    return left_default(parent, counts, key, {name: 0})


def denormalise(a: DataFrame, b: DataFrame, on, columns: list[str]) -> DataFrame:
    """One wide table from two."""
    return a.join(b, on).select(*columns)


def orphans(child: DataFrame, parent: DataFrame, fk: list[str], pk: list[str]) -> DataFrame:
    """Child rows whose foreign key has no parent. As for a database, a null key refers to nothing."""
    for column in fk:
        child = child.filter(F.col(column).isNotNull())
    keys = parent.select(*[F.col(p).alias(f"_p_{p}") for p in pk])
    return child.join(keys, same([child[f] for f in fk], [keys[f"_p_{p}"] for p in pk]), "left_anti")

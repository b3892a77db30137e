"""Mixing sources to target weights: block quotas by Sainte-Laguë, blocks chosen by a seeded order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.llm.common import WORD
from tidemill.session import materialise

BLOCK_WORDS = 16
SHARD_WORDS = 1_000_000
# A table of sources is broadcast only if it was counted and has at most so many rows.
FEW_SOURCES = 50_000


def seats(parties: DataFrame, election: list[str], order: list[str], votes: str, total: Column) -> DataFrame:
    """Sainte-Laguë: ``total`` seats of each election go to the highest quotients votes / (2j + 1).

    With n parties and M seats a party with share q of M gets between q(1 - n/2M) - 1/2 and
    q(1 + n/2M) + 1/2 seats, so only the quotients in between are made and ranked: about three per
    party, whatever M is. Ties go to the party first in ``order``. A party without votes gets none.
    """
    whole = Window.partitionBy(*election)
    room = parties.withColumn("_seats", total).withColumn("_votes", F.sum(votes).over(whole)).withColumn(
        "_n", F.sum((F.col(votes) > 0).cast("bigint")).over(whole)
    )
    share = F.when((F.col("_votes") > 0) & (F.col("_seats") > 0), F.col(votes) * F.col("_seats") / F.col("_votes")).otherwise(0.0)
    slack = F.when(F.col("_seats") > 0, F.col("_n") / (2.0 * F.col("_seats"))).otherwise(0.0)
    room = room.withColumn("_low", F.greatest(F.lit(0), F.floor(share * (1 - slack) - 0.5001)).cast("bigint")).withColumn(
        "_high", F.when(F.col(votes) > 0, F.ceil(share * (1 + slack) + 0.5001)).otherwise(0).cast("bigint")
    )
    room = room.withColumn("_left", F.col("_seats") - F.sum("_low").over(whole))
    quotients = room.where("_high > _low").select(
        *election, *order, "_left", F.col(votes).alias("_v"), F.explode(F.expr("sequence(_low, _high - 1)")).alias("_j")
    )
    best = Window.partitionBy(*election).orderBy(F.desc(F.col("_v") / (2 * F.col("_j") + 1)), *order)
    won = (
        quotients.withColumn("_rank", F.row_number().over(best)).where("_rank <= _left")
        .groupBy(*election, *order).agg(F.count("*").alias("_won"))
    )
    keys = [*election, *order]
    return room.join(won, keys, "left").withColumn("seats", F.col("_low") + F.coalesce("_won", F.lit(0))).drop(
        "_seats", "_votes", "_n", "_low", "_high", "_left", "_won"
    )


def source_targets(sources: DataFrame, weights: list[int], share: float, most_times: int) -> DataFrame:
    """``source, source_size`` with ``source_no, weight, target``.

    Sources by code point, null last, get the weights in turn. Together they are to give ``share`` of
    all sizes; none more than ``most_times`` its own size, what is above being shared again by weight.
    That is min(cap, weight * level) with one level for all: the largest of (rest of the sum) /
    (rest of the weights) over the sources in order of cap / weight. One row per source is handled here.
    """
    by_name = Window.partitionBy("_all").orderBy(F.col("source").asc_nulls_last())
    rows = sources.withColumn("_all", F.lit(0)).withColumn("source_no", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = rows.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * most_times)
    by_cap = Window.partitionBy("_all").orderBy(F.col("_cap") / F.col("weight"), "source_no")
    everything = Window.partitionBy("_all")
    before = F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("_wanted", F.sum("source_size").over(everything) * share)
    rows = rows.withColumn("_level", (F.col("_wanted") - before) / rest)
    rows = rows.withColumn("target", F.least(F.col("_cap").cast("double"), F.col("weight") * F.max("_level").over(everything)))
    return rows.select("source", "source_size", "source_no", "weight", "target", "_wanted")


def mix(
    docs: DataFrame, weights: list[int] = (5, 2, 1), share: float = 1.5, most_times: int = 2, block: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS, seed: int = 11, carry: bool = False,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for each row of ``docs``.

    The size of a text is its number of words. Each source is cut into shards by a hash of the id, so
    that one window never holds a whole source; block quotas go to sources and then to their
    shards by Sainte-Laguë. A shard's documents lie on a line in an order drawn from the seed; its
    quota is taken from the start of that line, block by block, a second time round if it is larger
    than the shard. ``taken`` are the words taken, repeats counted; no document gives more than
    ``most_times`` its size, and reruns agree.

    With ``carry`` the columns of ``docs`` come along, as struct ``doc``.

    A null text has size 0 and gives nothing; null sources are one source; null ids are ids like
    any other; rows that repeat each count. An empty table gives no rows.
    """
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = materialise(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), named)).alias("draw"), *([F.struct("*").alias("doc")] if carry else []),
    ), "mix-sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, list(weights), share, most_times).withColumn("_all", F.lit(0))
    blocks = F.round(F.col("_wanted") / block).cast("bigint")
    quotas = materialise(
        seats(targets, ["_all"], ["source_no"], "target", blocks).select(
            "source", "source_size", "source_no", "target", F.col("seats").alias("source_seats"),
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("bigint").alias("n_shards"),
        ), "mix-quotas",
    )
    small = quotas.count() <= FEW_SOURCES
    of = quotas.withColumnRenamed("source", "_source")
    rows = rows.join(F.broadcast(of) if small else of, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "shard", F.conv(F.substring("draw", 1, 8), 16, 10).cast("bigint") % F.col("n_shards")
    )
    shards = rows.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"), F.max("source_seats").alias("source_seats"))
    shards = seats(shards, ["source_no"], ["shard"], "shard_size", F.col("source_seats")).select(
        "source_no", "shard", "shard_size", F.least(F.col("seats") * block, F.col("shard_size") * most_times).alias("quota")
    )
    line = Window.partitionBy("source_no", "shard").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(line), F.lit(0)))
    rounds = F.when(F.col("shard_size") > 0, F.floor(F.col("quota") / F.col("shard_size"))).otherwise(0)
    rest = F.col("quota") - rounds * F.col("shard_size")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.join(shards, ["source_no", "shard"]).select(
        "doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"), *(["doc"] if carry else [])
    )

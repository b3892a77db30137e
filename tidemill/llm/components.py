"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.session import materialise


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for each node of a link ``a, b``: the smallest node it can reach.

    Large-star and small-star steps in turn: each joins every node's neighbours to the smallest
    of them, so that long paths shrink fast. Each round is written to the shared folder, which cuts
    the lineage; a node with very many neighbours is a key whose minimum is combined before the shuffle.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = materialise(links, "links")
    before = None
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(below, "a").select(F.col("b").alias("x"), "m").where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b"))
            .unionByName(below.select("a", F.col("m").alias("b"))).distinct()
        )
        links = materialise(small, "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

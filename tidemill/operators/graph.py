"""Graph queries and merges over node and edge frames.

A label is one frame of nodes with an id column; a relation is a frame with ``src_id`` and ``dst_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.operators.changes import upsert
from tidemill.operators.shape import last_per_key


def _renamed(nodes: DataFrame, alias: str) -> DataFrame:
    return nodes.select(*[F.col(c).alias(f"{alias}_{c}") for c in nodes.columns])


def pattern(
    src: DataFrame, edges: DataFrame, dst: DataFrame, src_id: str, dst_id: str, names: tuple[str, str] = ("a", "b")
) -> DataFrame:
    """Every ``(a)-[edge]->(b)``; node columns come out as ``a_column`` and ``b_column``."""
    a, b = _renamed(src, names[0]), _renamed(dst, names[1])
    joined = edges.join(a, edges["src_id"] == a[f"{names[0]}_{src_id}"])
    return joined.join(b, joined["dst_id"] == b[f"{names[1]}_{dst_id}"]).drop("src_id", "dst_id")


def graph_rows(
    src: DataFrame, edges: DataFrame, dst: DataFrame, src_id: str, dst_id: str,
    src_columns: dict[str, str], dst_columns: dict[str, str],
) -> DataFrame:
    """Flat rows from a pattern: ``{node column: output name}`` for both ends."""
    found = pattern(src, edges, dst, src_id, dst_id, ("src", "dst"))
    return found.select(
        *[F.col(f"dst_{c}").alias(n) for c, n in dst_columns.items()],
        *[F.col(f"src_{c}").alias(n) for c, n in src_columns.items()],
    )


def merge_nodes(nodes: DataFrame, incoming: DataFrame, id: str, order_by: list[str]) -> DataFrame:
    """Nodes after MERGE ... SET: new ids are added, known ones get the last values. Repeating it
    changes nothing."""
    return upsert(nodes, incoming, [id], order_by)


def merge_edges(edges: DataFrame, incoming: DataFrame, partitions: int | None = None) -> DataFrame:
    """Edges after MERGE: each (src_id, dst_id) once.

    ``partitions``, when given, is how many tasks share the pairs, so that one task's part need not grow with the edges.
    """
    merged = edges.unionByName(incoming.select(*edges.columns))
    if partitions:
        merged = merged.repartition(partitions, "src_id", "dst_id")
    return merged.dropDuplicates(["src_id", "dst_id"])


def merge_pairs(pairs: DataFrame, node_id: str, order_by: list[str]) -> DataFrame:
    """The nodes named in a list of pairs, each once with its last values."""
    return last_per_key(pairs, [node_id], order_by)

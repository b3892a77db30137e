"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every vector is put into a leaf of it. A query walks the tree
by a priority queue of distances to centres and visits so many leaves as calibration against brute
force has shown to reach the wanted recall.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm.common import bounded_sample
from tidemill.session import materialise

SAMPLE = 20_000  # vectors the tree is fitted on, at most
SAMPLE_BYTES = 64 << 20
CALIBRATION = 200  # queries compared with brute force, at most
BIN_ROWS = 20_000  # vectors searched together by one task
QUERY_ROWS = 5_000  # queries that search them together


@dataclass
class Tree:
    """Nodes by number, the root first; a node without children is a leaf."""

    centres: np.ndarray
    children: list[list[int]]
    leaf_of: np.ndarray = field(init=False)  # node -> leaf number, -1 inside

    def __post_init__(self):
        inside = np.array([bool(c) for c in self.children])
        self.leaf_of = np.where(inside, -1, np.cumsum(~inside) - 1)

    @property
    def leaves(self) -> int:
        return int(self.leaf_of.max()) + 1

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by the nearest centre from level to level."""
        found, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if not self.children[node]:
                found[rows] = self.leaf_of[node]
                continue
            near = _distances(x[rows], self.centres[self.children[node]]).argmin(axis=1)
            todo.extend((child, rows[near == i]) for i, child in enumerate(self.children[node]))
        return found

    def visits(self, q: np.ndarray, most: int, sizes: np.ndarray | None = None, least: int = 0) -> list[list[int]]:
        """For each query the first ``most`` leaves, best bin first; more until they hold ``least`` vectors,
        where ``sizes`` tells how many each leaf has."""
        far, found = _distances(q, self.centres), []
        for row in far:
            queue, order, held = [(0.0, 0)], [], 0
            while queue and (len(order) < most or held < least):
                _, node = heapq.heappop(queue)
                if self.children[node]:
                    for child in self.children[node]:
                        heapq.heappush(queue, (row[child], child))
                else:
                    order.append(int(self.leaf_of[node]))
                    held += 0 if sizes is None else int(sizes[order[-1]])
            found.append(order)
        return found


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)


def grow(x: np.ndarray, branch: int = 8, leaf: int = 16, rounds: int = 8, seed: int = 5) -> Tree:
    """k-means within k-means until a node has at most ``leaf`` vectors of the sample."""
    rng = np.random.default_rng(seed)
    centres, children, todo = [x.mean(axis=0) if len(x) else np.zeros(x.shape[1])], [[]], [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= leaf:
            continue
        own = x[rows]
        k = x[rng.choice(rows, min(branch, len(rows)), replace=False)]
        for _ in range(rounds):
            near = _distances(own, k).argmin(axis=1)
            k = np.array([own[near == i].mean(axis=0) if (near == i).any() else k[i] for i in range(len(k))])
        near = _distances(own, k).argmin(axis=1)
        parts = [(k[i], rows[near == i]) for i in range(len(k)) if (near == i).any()]
        if len(parts) < 2:  # equal vectors
            continue
        for centre, part in parts:
            children[node].append(len(centres))
            todo.append((len(centres), part))
            centres.append(centre)
            children.append([])
    return Tree(np.array(centres), children)


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component makes all candidates equally long, so the nearest have the largest inner product."""
    return np.c_[x, np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))]


def _query(x: np.ndarray) -> np.ndarray:
    return np.c_[x, np.zeros(len(x))]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v``: rows with an id and a vector that is not null, not zero, and whose components are
    all finite numbers. Rows that repeat id and vector count once."""
    v = F.col(vector_col).cast("array<double>")
    return (
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull()))
        .where(F.forall("v", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    )


def _top(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, allowed: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its ``k`` best rows: candidates by a matrix product, then exact products in one fixed
    order of summing, so that equal vectors have equal scores everywhere."""
    for at in range(0, len(q), 256):
        products = q[at : at + 256] @ x.T
        if allowed is not None:
            products[~allowed[at : at + 256]] = -np.inf
        for i, row in enumerate(products):
            least = -np.inf if len(row) <= k else np.partition(row, len(row) - k)[len(row) - k]
            rows = np.flatnonzero((row >= least - 1e-9 * (1 + abs(least))) & (row > -np.inf) if least > -np.inf else row > -np.inf)
            exact = np.einsum("ij,j->i", x[rows], q[at + i])
            order = np.lexsort((ids[rows], -exact))[:k]
            yield at + i, rows[order], exact[order]


def _brute(q: np.ndarray, numbers: np.ndarray, k: int, dim: int):
    """The best of each task's vectors for a few queries; with the leaf each lies in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids = _matrix(batch.column("v"), dim), batch.column("vec_id").to_numpy()
            leaf = batch.column("leaf").to_numpy()
            out = [(int(numbers[i]), int(ids[r]), int(leaf[r]), float(s)) for i, rows, scores in _top(q, x, ids, k, None) for r, s in zip(rows, scores)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.float64()))] if out
                else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())],
                ["query", "vec_id", "leaf", "score"],
            )

    return run


def best(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each ``query``, ties to the smaller id."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrated_visits(tree: Tree, candidates: DataFrame, queries: DataFrame, k: int, dim: int, recall: float) -> tuple[int, float]:
    """Widens the leaf visits until the wanted recall is reached on at most about 200 queries, whose
    true neighbours are found among all vectors but their own. Returns the visits and the recall measured."""
    few = bounded_sample(queries.select("query", "v"), F.col("query"), CALIBRATION).collect()
    if not few:
        return 1, 1.0
    q, numbers = np.array([r["v"] for r in few]), np.array([r["query"] for r in few])
    near = candidates.mapInArrow(_brute(q, numbers, k + 1, dim), "query BIGINT, vec_id BIGINT, leaf BIGINT, score DOUBLE")
    truth = best(near.where("vec_id != query"), k).select("query", "leaf").collect()
    order = {int(n): {leaf: i for i, leaf in enumerate(o)} for n, o in zip(numbers, tree.visits(_query(q), tree.leaves))}
    needed = np.array([order[r["query"]][r["leaf"]] + 1 for r in truth])
    visits = 1
    while len(needed) and visits < tree.leaves and (needed <= visits).mean() < recall:
        visits = min(tree.leaves, max(visits + 1, int(visits * 1.1)))
    return visits, float((needed <= visits).mean()) if len(needed) else 1.0


def _bins(counts: dict[int, int], most: int) -> dict[int, tuple[int, int]]:
    """First bin and number of bins of each leaf: small leaves share one, a large leaf has several."""
    found, at, size = {}, 0, 0
    for leaf, n in sorted(counts.items()):
        parts = -(-n // most)
        if parts > 1:
            at, size = at + (size > 0), 0
            found[leaf] = (at, parts)
            at += parts
            continue
        if size and size + n > most:
            at, size = at + 1, 0
        found[leaf] = (at, 1)
        size += n
    return found


def _to_bins(tree: Tree, bins: dict[int, tuple[int, int]], visits: int, dim: int, sizes: np.ndarray, least: int):
    """Each query to the bins of the leaves it visits."""
    schema = pa.schema([("bin", pa.int64()), ("query", pa.int64()), ("v", pa.list_(pa.float64())), ("leaves", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                q, out = _matrix(part.column("v"), dim), []
                for number, vector, order in zip(part.column("query").to_pylist(), q, tree.visits(_query(q), visits, sizes, least)):
                    wanted: dict[int, list[int]] = {}
                    for leaf in order:
                        first, n = bins.get(leaf, (0, 0))
                        for b in range(first, first + n):
                            wanted.setdefault(b, []).append(leaf)
                    out.extend((b, number, vector, leaves) for b, leaves in wanted.items())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, schema.types)], schema=schema)

    return run


def _search(k: int, dim: int):
    schema = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        q, x = _matrix(queries.column("v"), dim), _matrix(rows.column("v"), dim)
        ids, leaf, numbers = rows.column("vec_id").to_numpy(), rows.column("leaf").to_numpy(), queries.column("query").to_numpy()
        wanted, out = queries.column("leaves"), []
        for at in range(0, len(q), 256) if len(x) else ():
            allowed = np.array([np.isin(leaf, w) for w in wanted.slice(at, 256).to_pylist()])
            for i, found, scores in _top(q[at : at + 256], x, ids, k, allowed):
                out.append((np.full(len(found), numbers[at + i]), ids[found], scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[]] * 3
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return run


def nearest(
    vectors: DataFrame, every: int = 20, k: int = 20, recall: float = 0.96, id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` the ``k``
    others of largest inner product, ties to the smaller id; all of them where there are fewer.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
    without an id; rows with the query's own id are not its neighbours; of vectors of different
    lengths those of the commonest length are searched. Of equal vectors only the ``k + 1`` smallest
    ids can be among anyone's neighbours, so only these are searched, and equal queries are searched
    once: a vector that a third of the rows have costs no more than another. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id BIGINT, rank INT, vec_id BIGINT, score DOUBLE")
    dim = sizes["dim"]
    rows = rows.where(F.size("v") == dim)
    same = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.withColumn("copy", F.dense_rank().over(same)).where(F.col("copy") <= k + 1).select("vec_id", "v", "copy")
    kept = materialise(kept.dropDuplicates(["v", "vec_id"]), "vectors")
    once = kept.where("copy = 1")
    longest = float(np.sqrt(once.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]))
    sample = bounded_sample(once.select("vec_id", "v"), F.col("vec_id"), min(SAMPLE, SAMPLE_BYTES // (8 * dim) + 1))
    x = np.array([r["v"] for r in sample.orderBy("vec_id").toLocalIterator()]).reshape(-1, dim)
    tree = grow(_lifted(x, longest))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.place(_lifted(_matrix(batch.column("v"), dim), longest))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(leaf, pa.int64())], ["vec_id", "v", "leaf"])

    candidates = materialise(kept.select("vec_id", "v").mapInArrow(place, "vec_id BIGINT, v ARRAY<DOUBLE>, leaf BIGINT"), "vectors-in-leaves")
    asked = rows.where(F.col("vec_id") % every == 0)
    queries = asked.groupBy("v").agg(F.min("vec_id").alias("query")).select("query", "v")
    visits, _ = calibrated_visits(tree, candidates, queries, k, dim, recall)
    counts = {r["leaf"]: r["count"] for r in candidates.groupBy("leaf").count().collect()}  # a row per leaf of the tree
    bins = _bins(counts, BIN_ROWS)
    sizes = np.array([counts.get(leaf, 0) for leaf in range(tree.leaves)])
    table = spark.createDataFrame([(leaf, first, n) for leaf, (first, n) in bins.items()], "leaf BIGINT, first BIGINT, parts BIGINT")
    binned = candidates.join(F.broadcast(table), "leaf").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).alias("bin"), "vec_id", "v", "leaf"
    )
    sent = queries.mapInArrow(_to_bins(tree, bins, visits, dim, sizes, k + 1), "bin BIGINT, query BIGINT, v ARRAY<DOUBLE>, leaves ARRAY<BIGINT>")
    # the queries of a bin in blocks of bounded size, each with all vectors of the bin
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    sent = sent.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    binned = binned.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    found = sent.groupBy("bin", "block").cogroup(binned.groupBy("bin", "block")).applyInArrow(
        _search(k + 1, dim), "query BIGINT, vec_id BIGINT, score DOUBLE"
    )
    top = best(found, k + 1).select("query", "vec_id", "score")
    members = asked.select("vec_id", "v").distinct().select(F.col("vec_id").alias("query_id"), "v").join(queries, "v").select("query_id", "query")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        members.join(top, "query").where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

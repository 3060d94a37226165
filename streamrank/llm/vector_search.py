"""Nearest neighbours by inner product with a vantage-point tree per shard.

One more coordinate gives all vectors the length of the longest, so that the largest
inner product is the smallest distance, and the triangle inequality can prune. Vectors
are dealt to shards by hash; a shard's tree is built once and stored. Queries come in
blocks of a fixed number, which go to all tasks: a task takes the stored trees as they
come, searches each of them for the block, and only the nearest are shuffled, to meet
per query. A subtree is left out if the query's distance to its shell is more than
``1 / factor`` of the distance of the worst result so far: factor one is exact search,
larger factors leave out more. What the search keeps is a bound on the distance; all
points within it, and within the rounding of distances, are then scored exactly, so that
ties are settled by id.

Equal vectors are one point of a tree, which keeps their ids.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import parked, table, tidied

#: Vectors of a shard, and queries that go to all tasks at once.
SHARD = 16_384
QUERY_BLOCK = 16_384
#: Queries searched together in a task.
GROUP = 1_024
LEAF = 256
FACTOR = 1.5
#: Lengths beyond which distances could overflow; such shards are scored point by point.
LONGEST = 1e150
#: Share of the longest vector by which computed distances may be off.
ROUNDING = 1e-6


def searchable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding, in doubles, of the rows that can take part.

    Null, empty and zero vectors and those with null or non-finite components cannot;
    nor can null ids. Rows with one id are rows of their own.
    """
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", doubles.alias("e")).where(
        F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("e", lambda x: x != 0)
    ).withColumnRenamed("e", "embedding")


@dataclass
class Tree:
    """A vantage-point tree in arrays: nodes split the points from ``lo`` to ``hi`` of ``order``."""

    points: np.ndarray
    order: np.ndarray
    nodes: list[tuple]

    @staticmethod
    def build(points: np.ndarray, seed: int = 0) -> Tree:
        draw = np.random.default_rng(seed)
        order, nodes = np.arange(len(points)), []

        def split(lo: int, hi: int) -> int:
            at = len(nodes)
            nodes.append((lo, hi, -1, 0.0, -1, -1))
            if hi - lo <= LEAF:
                return at
            vantage = order[lo + int(draw.integers(hi - lo))]
            away = np.linalg.norm(points[order[lo:hi]] - points[vantage], axis=1)
            half = (hi - lo) // 2
            ranked = np.argpartition(away, half)
            order[lo:hi] = order[lo:hi][ranked]
            away = away[ranked]
            nodes[at] = (lo, hi, vantage, (away[:half].max(), away[half:].min()),
                         split(lo, lo + half), split(lo + half, hi))
            return at

        if len(points):
            split(0, len(points))
        return Tree(points, order, nodes)

    def search(self, queries: np.ndarray, k: int, factor: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs that hold the ``k`` nearest of each query, ties included.

        The first walk finds how far the k-th nearest is; the second one takes all points
        that are no farther, by more than ``slack`` at least.
        """
        best = np.full((len(queries), k), np.inf)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        bound: np.ndarray | None = None

        def visit(at: int, asked: np.ndarray) -> None:
            lo, hi, vantage, shell, near, far = self.nodes[at]
            if vantage < 0:
                members = self.order[lo:hi]
                x, y = queries[asked], self.points[members]
                square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)
                away = np.sqrt(np.maximum(square, 0))
                if bound is None:
                    every = np.concatenate([best[asked], away], axis=1)
                    best[asked] = np.partition(every, k - 1, axis=1)[:, :k]
                else:
                    row, column = np.nonzero(away <= bound[asked][:, None])
                    pairs.append((asked[row], members[column]))
                return
            away = np.linalg.norm(queries[asked] - self.points[vantage], axis=1)
            inner, outer = shell
            in_first = away <= (inner + outer) / 2
            for first, second, mask, gap in (
                (near, far, in_first, outer - away), (far, near, ~in_first, away - inner)):
                if mask.any():
                    visit(first, asked[mask])
                    left = asked[mask]
                    worst = (best[left].max(axis=1) if bound is None else bound[left]) + slack
                    open_ = ~(factor * gap[mask] > worst)
                    if open_.any():
                        visit(second, left[open_])

        none = np.zeros(0, np.int64)
        if not self.nodes or not len(queries):
            return none, none
        visit(0, np.arange(len(queries)))
        bound = best.max(axis=1) + slack
        visit(0, np.arange(len(queries)))
        return np.concatenate([none, *(q for q, _ in pairs)]), np.concatenate([none, *(p for _, p in pairs)])


@dataclass
class Shard:
    """The distinct vectors of a shard, who holds each, and their tree; no tree where lengths would overflow."""

    vectors: np.ndarray
    holders: list[list[tuple[int, int]]]
    tree: Tree | None
    slack: float

    @staticmethod
    def build(members: pd.DataFrame, k: int, longest: float) -> Shard:
        members = members.sort_values(["vec_id", "row"])
        raw = np.stack(members["embedding"].to_numpy())
        _, first, which = np.unique(raw, axis=0, return_index=True, return_inverse=True)
        holders: list[list[tuple[int, int]]] = [[] for _ in first]
        for point, vec_id, row in zip(which.ravel().tolist(), members["vec_id"].tolist(), members["row"].tolist()):
            if len(holders[point]) <= k:  # in id order; no more can be among the nearest
                holders[point].append((vec_id, row))
        raw = raw[first]
        if not longest < LONGEST:
            return Shard(raw, holders, None, 0.0)
        length = np.sqrt(np.maximum(longest ** 2 - (raw * raw).sum(1), 0))
        tree = Tree.build(np.concatenate([raw, length[:, None]], axis=1))
        return Shard(raw, holders, tree, ROUNDING * longest)

    def packed(self) -> bytes:
        tree = self.tree and (self.tree.points, self.tree.order, self.tree.nodes)
        return pickle.dumps((self.vectors, self.holders, tree, self.slack))

    @staticmethod
    def unpacked(data: bytes) -> Shard:
        vectors, holders, tree, slack = pickle.loads(data)
        return Shard(vectors, holders, tree and Tree(*tree), slack)

    def nearest(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> Iterator[tuple]:
        """(place of the query, vec_id, row, score) of the best ``k`` of the shard for each query."""
        for start in range(0, len(queries), GROUP):
            asked = queries[start:start + GROUP]
            if self.tree is None:
                query, point = (x.ravel() for x in np.indices((len(asked), len(self.vectors))))
            else:
                # A query's own row may be among its nearest.
                flat = np.concatenate([asked, np.zeros((len(asked), 1))], axis=1)
                slack = self.slack + ROUNDING * np.sqrt((flat * flat).sum(1)).max(initial=0)
                query, point = self.tree.search(flat, k + 1, factor, slack)
            with np.errstate(over="ignore", invalid="ignore"):
                # One order of addition for all.
                score = np.concatenate([np.zeros(0), *(
                    (self.vectors[point[i:i + LEAF * GROUP]] * asked[query[i:i + LEAF * GROUP]]).sum(axis=1)
                    for i in range(0, len(query), LEAF * GROUP))])
            order = np.lexsort((-score, query))
            cuts = np.searchsorted(query[order], np.arange(len(asked) + 1))
            for q, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
                mine = order[a:b]
                if len(mine) > k + 1:
                    mine = mine[score[mine] >= score[mine[k]]]
                found = sorted((-score[p], *holder) for p in mine for holder in self.holders[point[p]]
                               if holder[1] != own[start + q])[:k]
                yield from ((start + q, vec_id, row, -s) for s, vec_id, row in found)


def nearest(
    vectors: DataFrame, asked: str | Column = "vec_id % 20 = 0", k: int = 20, factor: float = FACTOR,
    shard: int = SHARD, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query.

    ``vectors`` has vec_id and embedding, and ``asked`` says which rows are queries. A
    query's own row is no candidate; every other row is, also one that is repeated or has
    the query's id. Ties go to the smaller vec_id; queries with fewer candidates get all
    of them. See ``searchable`` for rows that take no part; vectors of different length
    have no product and do not meet. Inner products that overflow are infinite, or not a
    number, and then the largest. An empty table has no queries. Shards and blocks
    of queries grow in number, not in size, with the input; the driver holds one block.
    """
    rows = parked(searchable(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    rows = rows.withColumn("dims", F.size("embedding"))
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    sizes = rows.agg(F.count("*").alias("n"), F.sqrt(F.max(norm)).alias("longest")).first()
    shards, longest = max(1, -(-sizes["n"] // shard)), sizes["longest"] or 0.0

    def build(members: pd.DataFrame) -> pd.DataFrame:
        built = Shard.build(members, k, longest)
        return pd.DataFrame({"dims": [built.vectors.shape[1]], "shard": [built.packed()]})

    part = F.pmod(F.xxhash64("row"), F.lit(shards)).alias("part")
    trees = parked(rows.groupBy("dims", part).applyInPandas(build, "dims int, shard binary"), "trees")
    wanted = rows.where(asked)
    blocks = max(1, -(-wanted.count() // query_block))
    found = None
    for block in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).orderBy("row")
        here = _searched(trees, own.toPandas(), k, factor)
        found = here if found is None else found.union(here)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _searched(trees: DataFrame, queries: pd.DataFrame, k: int, factor: float) -> DataFrame:
    """The nearest of one block of queries in every stored shard."""
    by_dims = {
        int(dims): (np.stack(some["embedding"].to_numpy()), some["vec_id"].to_numpy(), some["row"].to_numpy())
        for dims, some in queries.groupby("dims")}
    sent = trees.sparkSession.sparkContext.broadcast(by_dims)
    names = ["query_id", "query_row", "vec_id", "row", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if dims not in sent.value:
                    continue
                vectors, ids, rows = sent.value[dims]
                hits = list(Shard.unpacked(packed.as_py()).nearest(vectors, rows, k, factor))
                place = np.array([h[0] for h in hits], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[place], pa.int64()), pa.array(rows[place], pa.int64())]
                    + [pa.array([h[i] for h in hits], kind) for i, kind in ((1, pa.int64()), (2, pa.int64()), (3, pa.float64()))],
                    names=names)

    return trees.select("dims", "shard").mapInArrow(
        tidied(search), "query_id long, query_row long, vec_id long, row long, score double")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector; see ``nearest`` for odd rows."""
    return nearest(table(spark, sf_dir, "embeddings"))

"""Exact top-k inner-product search: cover trees over queries and data, searched together.

Vectors are turned into integers, floor(256 x) of each component. The queries are a stated part of the rows,
taken in waves of a bounded number drawn by a hash. Tasks build a wave's query trees, of about 2,048 queries
each; the finished trees are broadcast, the wave's result is written, and the broadcast is given up before the
next wave. Every task reads its rows in lots of at most 2,048, builds a cover tree of each lot, and walks it
together with the query trees. A pair of nodes with centres q and r and covering radii a and b cannot hold a
product above q.r + |q| b + |r| a + a b, so it is pruned when that is below the worst kth score of every query
under the query node; the rows of a pair of leaves are bounded once more, row by row, before any product of
single vectors is made. A query group without k scores yet is seeded from the rows of its most promising nodes.
A task passes on at most k rows for each query, and Spark keeps the best k of all tasks.

How much is pruned depends on the data. Where a query's best scores stand out (clusters, copies), few pairs are
scored; where all vectors are about equally far apart, as random unit vectors in many dimensions are, no bound
on covering radii can leave anything out, and the search is a blocked product of all pairs.

Products of the integers are computed exactly: as doubles while they stay below 2**53, else as 64-bit integers.

Defined cases: a vector that is null, or holds null or a non-finite component, takes no part, nor does a row
with a null vec_id. A shorter vector counts as padded with zeros. A query is not met by rows of its own
vec_id; equal rows count once, and of several vectors under one vec_id the query's is the least. Equal scores
go to the smaller vec_id; a query with fewer candidates returns all. An empty table gives an empty result;
extra columns are ignored.
"""
from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonora.llm.shared import fresh_path, prepare, saved, table

QUERY_MODULUS, K, SCALE, SEED = 50, 5, 256, 13
#: Queries of a wave (about), and of a tree (about); rows of a lot (at most).
WAVE_QUERIES, TREE_QUERIES, LOT_ROWS = 16_384, 2048, 2048
#: Ratio of the covering radii of neighbouring levels, and points up to which a node stays a leaf.
BASE, LEAF_POINTS = 1.6, 4
#: Queries whose nodes meet the data together, queries of one group among them, and nodes that seed a group.
BLOCK_QUERIES, GROUP_QUERIES, SEED_NODES = 256, 32, 8
#: A group that more than this share of at least so many data nodes may concern is divided; groups stay together
#: while each needs more than this share of the nodes that any of them needs.
WIDE_SHARE, WIDE_ROWS, TOGETHER_SHARE = 0.1, 16, 0.25
FOUND = "query_id long, vec_id long, score long"


class CoverTree:
    """A cover tree with explicit levels. Nodes are in order of depth; each is a range of the reordered points.

    A node's centre is one of its points. The children of a node share one level l, below the node's own: their
    points lie within BASE**l of their centres (covering), their centres are more than BASE**l apart
    (separation), and the first child has its parent's centre (nesting). Levels at which a node would have one
    child only are left out. ``radius`` is the largest distance that occurs, at most BASE**level.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF_POINTS) -> None:
        points = points.astype(np.float64)
        self.order = np.arange(len(points))
        self.first, self.last, self.pivot, self.level, self.radius, self.children = [], [], [], [], [], []
        if len(points):
            self._grow(_distances(points), leaf)
        self.first, self.last = np.array(self.first, np.int64), np.array(self.last, np.int64)
        self.radius = np.array(self.radius, np.float64)
        self.centre = points[np.array(self.pivot, np.int64)]
        self.norm = np.sqrt((self.centre**2).sum(1))
        self.child_first = np.array([c.start for c in self.children], np.int64)
        self.child_count = np.array([len(c) for c in self.children], np.int64)

    def _node(self, first: int, last: int, pivot: int, level: int, away: np.ndarray) -> None:
        self.first.append(first)
        self.last.append(last)
        self.pivot.append(pivot)
        self.level.append(level)
        self.radius.append(float(away.max()) * (1 + 1e-12))
        self.children.append(range(0))

    def _grow(self, distance: np.ndarray, leaf: int) -> None:
        root = int(distance.max(1).argmin())
        reach = float(distance[root].max())
        self._node(0, len(self.order), root, _level_below(reach) + 1, distance[root])
        node = 0
        while node < len(self.first):
            first, last, pivot = self.first[node], self.last[node], self.pivot[node]
            if last - first > leaf and self.radius[node] > 0.0:
                own = self.order[first:last]
                away, of, centres = distance[pivot, own], np.zeros(len(own), np.int64), [pivot]
                level = _level_below(float(away.max()))
                # Farthest points first: a point becomes a centre only while it lies outside all covers.
                while away.max() > BASE**level:
                    centres.append(int(own[away.argmax()]))
                    d = distance[centres[-1], own]
                    of[d < away] = len(centres) - 1
                    away = np.minimum(away, d)
                sort = np.argsort(of, kind="stable")
                self.order[first:last], away = own[sort], away[sort]
                edges = np.searchsorted(of[sort], np.arange(len(centres) + 1)).tolist()
                self.children[node] = range(len(self.first), len(self.first) + len(centres))
                for centre, a, b in zip(centres, edges, edges[1:]):
                    self._node(first + a, first + b, centre, level, away[a:b])
            node += 1

    def members(self, nodes: np.ndarray) -> np.ndarray:
        return self.order[_ranges(self.first[nodes], self.last[nodes] - self.first[nodes])]

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """The children of ``nodes``; a leaf stands for itself."""
        inner = self.child_count[nodes] > 0
        return np.concatenate([nodes[~inner], _ranges(self.child_first[nodes[inner]], self.child_count[nodes[inner]])])


def _distances(points: np.ndarray) -> np.ndarray:
    """All distances of a lot's points; exact sums of squares below 2**53, else rounded up."""
    square = (points**2).sum(1)
    apart = square[:, None] + square[None, :] - 2.0 * (points @ points.T)
    if square.max() >= 2.0**50:
        apart += 1e-11 * square.max()
    np.fill_diagonal(apart, 0.0)
    return np.sqrt(np.maximum(apart, 0.0))


def _level_below(radius: float) -> int:
    """The largest level whose covering radius is below ``radius``."""
    if radius <= 0.0:
        return 0
    level = math.ceil(math.log(radius, BASE))
    while BASE**level >= radius:
        level -= 1
    return level


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each pair, one after the other."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Best:
    """The best k (score, vec_id) of each query so far."""

    def __init__(self, n: int, k: int) -> None:
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.vec_id = np.full((n, k), np.iinfo(np.int64).max)
        #: No score below this can be among a query's best: its kth score, or that of rows still to be offered.
        self.floor = np.full(n, -np.inf)

    def offer(self, at: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        k = self.score.shape[1]
        s = np.concatenate([self.score[at], score], 1)
        v = np.concatenate([self.vec_id[at], np.broadcast_to(vec_id, score.shape)], 1)
        top = np.lexsort((v, -s.astype(np.float64) if np.abs(s[s > np.iinfo(np.int64).min]).max(initial=0) < 1 << 53 else ~s), axis=1)[:, :k]
        self.score[at], self.vec_id[at] = np.take_along_axis(s, top, 1), np.take_along_axis(v, top, 1)
        full = self.vec_id[at][:, -1] != np.iinfo(np.int64).max
        self.floor[at] = np.maximum(self.floor[at], np.where(full, self.score[at][:, -1], -np.inf))


class Search:
    """The walk of one query tree and one lot's tree. ``products`` counts all products of vectors, of centres too."""

    def __init__(self, queries: CoverTree, query_ids: np.ndarray, exact_q: np.ndarray, data: CoverTree, ids: np.ndarray, exact: np.ndarray, best: Best) -> None:
        small = float(np.abs(exact_q.astype(float)).max(initial=0)) * float(np.abs(exact.astype(float)).max(initial=0)) * exact.shape[1] < 2.0**53
        self.queries, self.query_ids, self.data, self.ids, self.best, self.products = queries, query_ids, data, ids, best, 0
        self.left, self.right = (exact_q.astype(np.float64), exact.astype(np.float64)) if small else (exact_q, exact)
        self.points = exact.astype(np.float64)
        self.point_norm = np.sqrt((self.points**2).sum(1))
        if len(ids) and len(query_ids):
            self._walk()

    def _floors(self, nodes: np.ndarray) -> np.ndarray:
        return np.array([self.best.floor[self.queries.members(nodes[i : i + 1])].min() for i in range(len(nodes))])

    def _bounds(self, nodes: np.ndarray, centre: np.ndarray, norm: np.ndarray, radius: np.ndarray | float) -> np.ndarray:
        """No row within ``radius`` of a centre has a greater product with a query of the node (one row each)."""
        q_norm, q_radius = self.queries.norm[nodes][:, None], self.queries.radius[nodes][:, None]
        reach = q_norm * radius + q_radius * norm + q_radius * radius
        self.products += len(nodes) * len(centre)
        return self.queries.centre[nodes] @ centre.T + reach * (1 + 1e-9) + 1e-9 * (q_norm * norm) + 1e-6

    def _node_bounds(self, nodes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self._bounds(nodes, self.data.centre[rows], self.data.norm[rows], self.data.radius[rows])

    def _walk(self) -> None:
        """Pairs of query nodes and the data nodes that may still matter to them, from both roots down."""
        queries, data = self.queries, self.data
        stack = [(np.array([0]), np.array([0]))]
        while stack:
            nodes, rows = stack.pop()
            sizes = queries.last[nodes] - queries.first[nodes]
            if sizes.sum() <= BLOCK_QUERIES or not queries.child_count[nodes].any():
                self._block(nodes, rows)
                continue
            # One node with many queries: the pairs that remain, a level further down on the side of larger radius.
            rows = rows[self._node_bounds(nodes, rows)[0] >= self._floors(nodes)[0]]
            if not len(rows):
                continue
            if data.radius[rows].max() > queries.radius[nodes[0]]:
                rows = data.below(rows)
            part, held = [], 0
            for child in queries.children[nodes[0]]:
                size = int(queries.last[child] - queries.first[child])
                if part and held + size > BLOCK_QUERIES:
                    stack.append((np.array(part), rows))
                    part, held = [], 0
                part.append(child)
                held += size
            stack.append((np.array(part), rows))

    def _block(self, nodes: np.ndarray, rows: np.ndarray) -> None:
        """Walk the data below ``rows`` for the groups of queries below ``nodes``."""
        queries, data = self.queries, self.data
        while True:
            large = (queries.last[nodes] - queries.first[nodes] > GROUP_QUERIES) & (queries.child_count[nodes] > 0)
            if not large.any():
                break
            nodes = np.concatenate([nodes[~large], queries.below(nodes[large])])
        for i in range(len(nodes)):
            if self._floors(nodes[i : i + 1])[0] == -np.inf:
                self._seed(nodes[i : i + 1], rows)
        # Groups that the same data nodes may concern stay together; others go on alone, each with its own nodes.
        todo = [(nodes, rows)]
        while todo:
            nodes, rows = todo.pop()
            nodes, passes = self._passing(nodes, rows)
            some = passes.any(0)
            if len(nodes) > 1 and some.any() and passes[:, some].mean() <= TOGETHER_SHARE:
                todo.extend((nodes[i : i + 1], self.data.below(rows[passes[i]])) for i in np.flatnonzero(passes.any(1)).tolist())
            elif data.child_count[rows[some]].any():
                todo.append((nodes, data.below(rows[some])))
            elif some.any():
                self._leaves(nodes, data.members(rows[some]))

    def _leaves(self, nodes: np.ndarray, points: np.ndarray) -> None:
        """Score the rows of leaves, bounded one by one before where that is less work."""
        at = self.queries.members(nodes)
        if len(at) > len(nodes):
            bounds = self._bounds(nodes, self.points[points], self.point_norm[points], 0.0)
            points = points[(bounds >= self._floors(nodes)[:, None]).any(0)]
        self._score(at, points)

    def _passing(self, nodes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which data nodes may concern which groups. Groups too wide to tell are divided."""
        passes = self._node_bounds(nodes, rows) >= self._floors(nodes)[:, None]
        while len(rows) >= WIDE_ROWS:
            wide = (passes.mean(1) > WIDE_SHARE) & (self.queries.child_count[nodes] > 0)
            if not wide.any():
                break
            parts = self.queries.below(nodes[wide])
            for i in range(len(parts)):
                if (self.best.vec_id[self.queries.members(parts[i : i + 1]), -1] == np.iinfo(np.int64).max).any():
                    self._seed(parts[i : i + 1], rows)
            nodes = np.concatenate([nodes[~wide], parts])
            passes = np.concatenate([passes[~wide], self._node_bounds(parts, rows) >= self._floors(parts)[:, None]])
        return nodes, passes

    def _seed(self, node: np.ndarray, rows: np.ndarray) -> None:
        """Raise the floors of a group by its products with the rows of the nodes that look best from its centre."""
        best, data = self.best, self.data
        while True:
            looks = data.centre[rows] @ self.queries.centre[node[0]]
            self.products += len(rows)
            rows = rows[np.argsort(-looks, kind="stable")[:SEED_NODES]]
            if not data.child_count[rows].any():
                break
            rows = data.below(rows)
        at, points = self.queries.members(node), data.members(rows)
        score = (self.left[at] @ self.right[points].T).astype(np.float64)
        self.products += score.size
        score[self.query_ids[at][:, None] == self.ids[points][None, :]] = -np.inf
        k = best.score.shape[1]
        if len(points) >= k:
            best.floor[at] = np.maximum(best.floor[at], np.sort(score, 1)[:, -k])

    def _score(self, at: np.ndarray, points: np.ndarray) -> None:
        best = self.best
        score = (self.left[at] @ self.right[points].T).astype(np.int64)
        self.products += score.size
        may = (score >= best.floor[at][:, None]) & (self.query_ids[at][:, None] != self.ids[points][None, :])
        some, of_use = may.any(1), may.any(0)
        if some.any():
            may, score, ids = may[some][:, of_use], score[some][:, of_use], self.ids[points][of_use]
            best.offer(at[some], np.where(may, score, np.iinfo(np.int64).min), np.where(may, ids[None, :], np.iinfo(np.int64).max))


def _plant(width: int):
    def task(own: pa.Table) -> pa.Table:
        exact = _matrix(own["v"].combine_chunks(), width)
        return pa.table({"tree": pa.array([pickle.dumps((CoverTree(exact, leaf=1), own["vec_id"].to_numpy(), exact))], pa.binary())})

    return task


def _scan(shared, k: int, width: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = [pickle.loads(tree) for tree in shared.value]
        best = [Best(len(query_ids), k) for _, query_ids, _ in wave]
        for batch in batches:
            for lo in range(0, len(batch), LOT_ROWS):
                lot = batch.slice(lo, LOT_ROWS)
                exact, ids = _matrix(lot.column("v"), width), lot.column("vec_id").to_numpy()
                data = CoverTree(exact)
                for (tree, query_ids, exact_q), found in zip(wave, best):
                    Search(tree, query_ids, exact_q, data, ids, exact, found)
        for (_, query_ids, _), found in zip(wave, best):
            there = found.vec_id != np.iinfo(np.int64).max
            yield pa.RecordBatch.from_pydict({"query_id": query_ids[np.nonzero(there)[0]], "vec_id": found.vec_id[there], "score": found.score[there]})

    return task


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy()
    return out


def integer_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``, the integers of each vector that takes part; equal rows once."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & sound)
    return rows.select(F.col("vec_id").cast("long"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")).distinct()


def topk_search(rows: DataFrame, k: int = K, query_modulus: int = QUERY_MODULUS, vector: str = "embedding", wave_queries: int = WAVE_QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of each query.

    The driver passes on the finished trees of one wave, whose size ``wave_queries`` bounds, and holds no others.
    """
    spark = prepare(rows.sparkSession)
    data = saved(integer_vectors(rows, vector), "vectors")
    queries = saved(data.where(F.col("vec_id") % query_modulus == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    n, width = queries.count(), data.agg(F.max(F.size("v"))).first()[0] or 0
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    path, waves = fresh_path(spark, "topk"), -(-n // wave_queries)
    deal = lambda own, parts: F.pmod(F.xxhash64(F.lit(own), "vec_id"), F.lit(parts))
    for wave in range(waves):
        own = queries.where(deal(SEED, waves) == wave)
        planted = own.groupBy(deal(SEED + 1, -(-min(n, wave_queries) // TREE_QUERIES))).applyInArrow(_plant(width), "tree binary")
        shared = spark.sparkContext.broadcast([bytes(r.tree) for r in planted.collect()])
        best = data.mapInArrow(_scan(shared, k, width), FOUND).withColumn("rank", rank).where(F.col("rank") <= k)
        best.write.parquet(f"{path}/wave={wave}")
        shared.destroy()
    if not waves:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return spark.read.schema(f"{FOUND}, rank int").parquet(path).select("query_id", "rank", "vec_id", "score")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search(table(spark, sf_dir, "embeddings"))

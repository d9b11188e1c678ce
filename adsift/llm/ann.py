"""Approximate nearest neighbours: a forest of random-projection trees.

Each tree halves the vectors at the median of a projection, level by level; a
projection's direction is the difference of two random vectors of the node.
The forest is fitted on a bounded sample of the different vectors, as deep as
the sample allows; levels below that use seeded random directions through the
leaf's mean, which need no fitting, so leaves stay small at any size. Every
vector is then indexed in every tree.

A query goes through all trees at once with one priority queue: the node that
most probably holds a near neighbour comes first. A neighbour at cosine c lies
on a side of a dividing plane with the probability that c times the query's
projection, with the spread that c leaves, is on that side; a node's is the
product along its path (the normal distribution is taken as logistic, and c is
what sample vectors have to their nearest ones in the sample). The search ends
when the leaves taken hold the wanted number of vectors. Leaves are dealt
out with their vectors, the query goes to each of its leaves, and the leaf
candidates are ranked by their exact cosine there; each task merges the best of
its leaves, and only the best of a task travel on.

Equal vectors are one point that keeps the smallest ids it can need, so a
vector held by a third of all rows is one point. A leaf above ``most_points``
is split into chunks, and its queries go to all of them.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and those of another length than the most frequent one (the larger
of equally frequent ones), take no part; neither do null ids. A query skips
every row with its own id; rows with the same id and vector are one. With
fewer candidates than wanted, all are given. No rows give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..plans.strategy import write_table

SAMPLE = 16_384  # vectors that the forest is fitted on at most
TREES = 8
LEAF_POINTS = 128
# Leaves to take, by their points over all points; trees overlap, so about two thirds are different.
# Neighbours that hardly stand out (as in isotropic data) need so many for a recall of 0.9.
SEARCH_SHARE = 0.5
SEARCH_LEAST = 4096
MOST_POINTS = 4096
QUERIES_HELD = 20_000  # whose best points a task holds before it gives them
NEAREST = 5
SEED = 7


@dataclass
class Tree:
    """A perfect tree: node i has children 2i+1 and 2i+2; ``extra`` directions split its leaves further."""

    normals: np.ndarray
    cuts: np.ndarray
    depth: int
    means: np.ndarray
    extra: np.ndarray

    @property
    def levels(self) -> int:
        return self.depth + len(self.extra)

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row."""
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (np.einsum("ij,ij->i", x, self.normals[node]) > self.cuts[node])
        leaf = node - (2**self.depth - 1)
        out = leaf
        for normal in self.extra:
            out = 2 * out + ((x - self.means[leaf]) @ normal > 0)
        return out


def _direction(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Difference of two random rows, or a random direction where they agree."""
    w = np.zeros(x.shape[1])
    if len(x) > 1:
        a, b = rng.choice(len(x), 2, replace=False)
        w = x[a] - x[b]
    if not np.any(w):
        w = rng.standard_normal(x.shape[1])
    return w / np.linalg.norm(w)


def fit_tree(x: np.ndarray, depth: int, extra: int, rng: np.random.Generator) -> Tree:
    dim = x.shape[1]
    normals, cuts = np.zeros((2**depth - 1, dim)), np.zeros(2**depth - 1)
    rows = {0: np.arange(len(x))}
    for node in range(2**depth - 1):
        own = rows.pop(node)
        normals[node] = _direction(x[own], rng)
        p = x[own] @ normals[node]
        cuts[node] = np.median(p) if len(p) else 0.0
        rows[2 * node + 1], rows[2 * node + 2] = own[p <= cuts[node]], own[p > cuts[node]]
    means = np.array([x[rows[2**depth - 1 + i]].mean(axis=0) if len(rows[2**depth - 1 + i]) else np.zeros(dim) for i in range(2**depth)])
    directions = rng.standard_normal((extra, dim))
    return Tree(normals, cuts, depth, means, directions / np.linalg.norm(directions, axis=1, keepdims=True) if extra else directions)


@dataclass
class Forest:
    """Trees of one depth, and the cosine that near neighbours are expected to have."""

    trees: list[Tree]
    near: float


def fit_forest(x: np.ndarray, points: int, trees: int = TREES, leaf_points: int = LEAF_POINTS, k: int = NEAREST, seed: int = SEED) -> Forest:
    """A forest for ``points`` unit vectors from the sample ``x`` of them."""
    levels = max(0, int(np.ceil(np.log2(max(points, 1) / leaf_points))))
    depth = min(levels, max(0, int(np.log2(max(len(x), 1) / 8))))
    some = x[: min(len(x), 256)] @ x.T
    near = float(np.sort(some, axis=1)[:, -min(k, len(x) - 1) - 1 : -1].mean()) if len(x) > 1 else 0.0
    return Forest([fit_tree(x, depth, levels - depth, np.random.default_rng((seed, t))) for t in range(trees)], min(max(near, 0.05), 0.95))


def _log_sides(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the probabilities to be below and above a plane, ``z`` spreads away."""
    return -np.logaddexp(0, 1.702 * z), -np.logaddexp(0, -1.702 * z)


def search(forest: Forest, q: np.ndarray, leaves: int) -> list[list[tuple[int, int]]]:
    """(tree, leaf) pairs for each row of ``q``: the first ``leaves`` of the shared queue."""
    spread = np.sqrt((1 - forest.near**2) / q.shape[1])
    fitted = [_log_sides((forest.near * (q @ t.normals.T) - t.cuts) / spread) for t in forest.trees]
    tails = [forest.near * (q @ t.extra.T) for t in forest.trees]
    middles = [t.means @ t.extra.T for t in forest.trees]
    out = []
    for i in range(len(q)):
        queue = [(0.0, t, 0, 0) for t in range(len(forest.trees))]  # (minus the log probability, tree, level, place in level)
        taken: list[tuple[int, int]] = []
        while queue and len(taken) < leaves:
            cost, t, level, place = heapq.heappop(queue)
            tree = forest.trees[t]
            if level == tree.levels:
                taken.append((t, place))
                continue
            if level < tree.depth:
                node = 2**level - 1 + place
                below, above = fitted[t][0][i, node], fitted[t][1][i, node]
            else:
                k = level - tree.depth
                below, above = _log_sides((tails[t][i, k] - middles[t][place >> k, k]) / spread)
            heapq.heappush(queue, (cost - above, t, level + 1, 2 * place + 1))
            heapq.heappush(queue, (cost - below, t, level + 1, 2 * place))
        out.append(taken)
    return out


def leaves_for(forest: Forest, points: int, leaf_points: int = LEAF_POINTS, share: float = SEARCH_SHARE, least: int = SEARCH_LEAST) -> int:
    """How many leaves a query takes: those of the wanted number of vectors, at most all."""
    return int(min(len(forest.trees) * 2 ** forest.trees[0].levels, np.ceil(max(share * points, least) / leaf_points)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(axis=1, keepdims=True)


def _lists(x: np.ndarray) -> pa.Array:
    ends = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part, vectors in double precision."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    common = rows.groupBy(F.size(v).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    return rows.where(F.size(v) == (common[0]["dim"] if common else 0))


CELLED = pa.schema([("cell", pa.int64()), ("point", pa.int64()), ("vector", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64()))])
CELLED_SQL = "cell long, point long, vector array<double>, ids array<long>"
RANKED = pa.schema([("query", pa.int64()), ("point", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])


def rerank(rows: DataFrame, best: int) -> DataFrame:
    """Rows in order of (cell, chunk, kind), points before queries -> each query's best points of the task's cells."""
    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, points, vectors, ids = None, [], [], []
        block = None
        held: dict[int, dict[int, tuple[float, list[int]]]] = {}  # by query and point, as trees share points

        def trimmed(found: dict[int, tuple[float, list[int]]]) -> dict[int, tuple[float, list[int]]]:
            return dict(sorted(found.items(), key=lambda f: (-f[1][0], f[1][1][0]))[:best])

        def told() -> Iterator[pa.RecordBatch]:
            out = [(q, p, score, own) for q, found in held.items() for p, (score, own) in trimmed(found).items()]
            held.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), RANKED, strict=True)], schema=RANKED)

        for batch in batches:
            cells, chunk, kind, point = (batch.column(i).to_numpy() for i in range(4))
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(chunk) != 0) | (np.diff(kind) != 0)) + 1
            x = _matrix(batch.column(4))
            for a, b in zip([0, *cuts], [*cuts, len(cells)], strict=True):
                if a == b:
                    continue
                if (cells[a], chunk[a]) != key:
                    key, points, vectors, ids, block = (cells[a], chunk[a]), [], [], [], None
                if kind[a] == 0:
                    points.append(point[a:b])
                    vectors.append(x[a:b])
                    ids += batch.column(5).slice(a, b - a).to_pylist()
                    continue
                if not points:
                    continue
                if block is None:
                    raw = np.concatenate(vectors)
                    block = (np.concatenate(points), _unit(raw), np.array([i[0] for i in ids]), ids)
                names, unit, least, own = block
                q = _unit(x[a:b])
                scores = q @ unit.T
                take = min(best, len(names))
                for i in range(b - a):
                    edge = np.partition(scores[i], len(names) - take)[len(names) - take]
                    near = np.flatnonzero(scores[i] >= edge - 1e-12)
                    exact = (unit[near] * q[i]).sum(axis=1)
                    found = held.setdefault(int(point[a + i]), {})
                    for j in np.lexsort((least[near], -exact))[:take]:
                        found[int(names[near[j]])] = (float(exact[j]), own[near[j]])
                    if len(found) > 8 * best:
                        held[int(point[a + i])] = trimmed(found)
            if len(held) > QUERIES_HELD:
                yield from told()
        yield from told()

    return rows.mapInArrow(ranked, "query long, point long, score double, ids array<long>")


def nearest(vectors: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST, trees: int = TREES,
            leaf_points: int = LEAF_POINTS, share: float = SEARCH_SHARE, least: int = SEARCH_LEAST, sample: int = SAMPLE,
            most_points: int = MOST_POINTS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest by cosine of the rows whose id fulfils ``queries`` (a function of the id column)."""
    spark = vectors.sparkSession
    rows = write_table(clean(vectors, id_col, vector_col), "vectors")
    per_vector = W.partitionBy("vector").orderBy("id")
    firsts = rows.distinct().withColumn("i", F.row_number().over(per_vector)).where(F.col("i") <= k + 1)
    points = firsts.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = write_table(points.select(F.monotonically_increasing_id().alias("point"), "vector", "ids"), "points")
    n = points.count()
    head = points.orderBy(F.xxhash64("vector"), "point").limit(sample).select("vector").toPandas()["vector"]
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = fit_forest(_unit(np.array(head.tolist(), np.float64)), n, trees, leaf_points, k)
    leaves = leaves_for(forest, n, leaf_points, share, least)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _unit(_matrix(batch.column(1)))
                for t, tree in enumerate(forest.trees):
                    cells = (t << 48) + tree.route(x)
                    yield pa.RecordBatch.from_arrays([pa.array(cells), *batch.columns], schema=CELLED)

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 64):
                part = batch.slice(a, 64)
                x = _matrix(part.column(1))
                found = search(forest, _unit(x), leaves)
                at = np.repeat(np.arange(len(part)), [len(f) for f in found])
                cells = np.array([(t << 48) + leaf for f in found for t, leaf in f], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cells), part.column(0).take(pa.array(at)), _lists(x[at]), part.column(2).take(pa.array(at))], schema=CELLED)

    asked = rows.where(queries(F.col("id"))).distinct().join(points.select("point", F.col("vector").alias("v")), F.col("vector") == F.col("v")).select("id", "point")
    asked = write_table(asked, "asked")
    searching = points.join(asked.select(F.col("point").alias("p")).distinct(), F.col("point") == F.col("p")).select("point", "vector", "ids")
    index = points.mapInArrow(indexed, CELLED_SQL)
    large = (index.groupBy(F.col("cell").alias("c")).agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > most_points)
             .select("c", F.ceil(F.col("held") / most_points).cast("int").alias("chunks")))
    probes = searching.mapInArrow(probed, CELLED_SQL)
    many = F.coalesce("chunks", F.lit(1))
    index = index.join(large, F.col("cell") == F.col("c"), "left").select("cell", F.pmod(F.xxhash64("point"), many).cast("int").alias("chunk"),
                                                                          F.lit(0).alias("kind"), "point", "vector", "ids")
    probes = probes.join(large, F.col("cell") == F.col("c"), "left").select("cell", F.explode(F.sequence(F.lit(0), many - 1)).alias("chunk"),
                                                                            F.lit(1).alias("kind"), "point", "vector", "ids")
    dealt = index.unionByName(probes).repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "kind")
    found = rerank(dealt, k + 1).groupBy("query", "point").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    by_query = W.partitionBy("query").orderBy(F.desc("score"), "id")
    found = found.select("query", "score", F.explode("ids").alias("id")).withColumn("i", F.row_number().over(by_query)).where(F.col("i") <= k + 1)
    told = asked.select(F.col("id").alias("query_id"), "point").join(found, F.col("point") == F.col("query")).where("id <> query_id")
    ranked = told.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")

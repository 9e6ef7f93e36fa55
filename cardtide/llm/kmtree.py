"""Approximate nearest neighbours by a hierarchical k-means tree, best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardtide.llm.common import stored
from cardtide.llm.vectors import best, dealt_to_shards, finite, matrices, sample, searched

BRANCHES = 8
LEAF_ROWS = 400
SAMPLE_ROWS = 20_000
SAMPLE_PER_LEAF = 12
SHARD_ROWS = 20_000
CALIBRATION_QUERIES = 200
TARGET = 0.97


@dataclass
class KMeansTree:
    """Inner pages hold the centres of their children; leaves are numbered."""

    centers: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)  # page, or -1 - leaf
    leaves: int = 0

    @classmethod
    def fit(cls, points: np.ndarray, leaves: int) -> KMeansTree:
        tree = cls()
        tree._split(points, max(1, leaves), np.random.default_rng(7))
        return tree

    def _split(self, points: np.ndarray, leaves: int, rng: np.random.Generator) -> int:
        if leaves <= 1 or len(points) < 2 * BRANCHES:
            self.leaves += 1
            return -self.leaves
        ways = min(BRANCHES, leaves)
        centers = points[rng.choice(len(points), ways, replace=False)]
        for _ in range(12):
            nearest = _squares(points, centers).argmin(axis=1)
            n = np.bincount(nearest, minlength=ways)
            sums = np.zeros_like(centers)
            np.add.at(sums, nearest, points)
            centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
        nearest = _squares(points, centers).argmin(axis=1)
        kept = [g for g in range(ways) if (nearest == g).any()]
        if len(kept) < 2:
            self.leaves += 1
            return -self.leaves
        page = len(self.centers)
        self.centers.append(centers[kept])
        self.children.append([])
        share = leaves / len(points)
        self.children[page] = [
            self._split(points[nearest == g], round((nearest == g).sum() * share), rng) for g in kept
        ]
        return page

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point, going to the nearest centre at each page."""
        out = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))] if self.centers else []
        while todo:
            page, rows = todo.pop()
            nearest = _squares(points[rows], self.centers[page]).argmin(axis=1)
            for g, child in enumerate(self.children[page]):
                own = rows[nearest == g]
                if not len(own):
                    continue
                if child < 0:
                    out[own] = -1 - child
                else:
                    todo.append((child, own))
        return out

    def best_bins(self, point: np.ndarray) -> Iterator[int]:
        """Leaves in the order in which a priority queue on centre distances gives them."""
        if not self.centers:
            yield 0
            return
        queue, n = [(0.0, 0, 0)], 1
        while queue:
            _, _, page = heapq.heappop(queue)
            if page < 0:
                yield -1 - page
                continue
            distance = _squares(point[None, :], self.centers[page])[0]
            for child, d in zip(self.children[page], distance.tolist(), strict=True):
                heapq.heappush(queue, (d, n, child))
                n += 1


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


def _nearest(ids, points, own_ids, queries, k: int):
    """The ``k`` nearest points of each query, by exact distances of those that may be."""
    squares = _squares(queries, points)
    scale = (points * points).sum(axis=1).max(initial=0) + (queries * queries).sum(axis=1)
    out = []
    for i, own in enumerate(own_ids.tolist()):
        row = np.where(ids == own, np.inf, squares[i])
        if len(row) > k:
            row_limit = np.partition(row, k - 1)[k - 1] + 1e-9 * scale[i]
            near = np.flatnonzero(row <= row_limit)
        else:
            near = np.arange(len(row))
        near = near[ids[near] != own]
        distance = np.sqrt(((points[near] - queries[i]) ** 2).sum(axis=1))
        order = np.lexsort((ids[near], distance))[:k]
        out.append((np.full(len(order), own, np.int64), ids[near][order], distance[order]))
    return out


@dataclass
class AnnIndex:
    """Rows dealt to shards of leaves, the trees by vector length, and the leaves to visit."""

    rows: DataFrame
    trees: dict[int, KMeansTree]
    shards: dict[int, tuple[range, int]]
    visits: int
    recall: float
    k: int

    def search(self, queries: DataFrame) -> DataFrame:
        """``query_id, rank, vec_id, score`` of ``queries(vec_id, vector)``: the ``k`` nearest found.

        A query visits ``visits`` leaves, and more as long as they hold no more than ``k``
        rows. A query's own id is no candidate; a query that repeats id and vector is answered once.
        """
        trees, shards, visits, k = self.trees, self.shards, self.visits, self.k

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, matrix in matrices(batch):
                    d = matrix.shape[1]
                    tree = trees.get(d, KMeansTree())
                    targets = []
                    for point in matrix:
                        cells, rows = [], 0
                        for leaf in tree.best_bins(point):
                            if len(cells) >= visits and rows > k:
                                break
                            found, n = shards.get((d << 32) + leaf, (range(0), 0))
                            cells.append(found)
                            rows += n
                        targets.append([s for cell in cells for s in cell])
                    part = batch.take(pa.array(at))
                    yield pa.record_batch(
                        [part.column("vec_id"), part.column("vector"), pa.array(targets, pa.list_(pa.int64()))],
                        names=["vec_id", "vector", "shards"],
                    )

        asked = queries.distinct().mapInArrow(visit, "vec_id long, vector array<double>, shards array<long>")
        asked = asked.select(
            F.explode("shards").alias("shard"), "vec_id", "vector", F.lit(0.0).alias("bound")
        )

        def answer(built, ids, matrix, bounds) -> list[tuple]:
            return [
                x
                for at in range(0, len(ids), 64)
                for x in _nearest(*built, ids[at : at + 64], matrix[at : at + 64], k)
            ]

        found = searched(self.rows, asked, lambda ids, matrix: (ids, matrix), answer, "double")
        return best(found, k, F.asc("score"))


def usable(df: DataFrame) -> DataFrame:
    """``vec_id, vector`` as doubles, of the rows that have an id and a usable vector."""
    rows = df.filter(finite(F.col("vector")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("vector").cast("array<double>").alias("vector"),
    )
    return rows.filter(F.exists("vector", lambda x: x != 0))


def build_index(
    vectors: DataFrame, k: int = 10, target: float = TARGET, leaf_rows: int = LEAF_ROWS
) -> AnnIndex:
    """Index every row of ``vectors(vec_id, vector)``, and calibrate it for ``k`` neighbours.

    A hierarchical k-means tree is fitted to at most 20,000 rows (fewer of very long vectors);
    every row then goes to a leaf. Leaves of more than 20,000 rows are split by a hash. For up to
    200 rows the true neighbours are found by brute force over all rows, in blocks; the
    leaves that a query visits are widened until the recall of those reaches ``target``.

    Rows with a null id, a null vector, a null or non-finite component or no component but
    zeros are left out. Vectors of different lengths are never neighbours. A row that
    repeats id and vector is found once. An empty table gives an index that finds nothing.
    """
    # Copies would take the places of other neighbours, in a shard's answer and in the calibration's.
    rows = stored(usable(vectors).distinct(), "vectors")
    spark, n = vectors.sparkSession, rows.count()
    ids, some = sample(rows, SAMPLE_ROWS, seed=29)
    lengths = np.array([len(v) for v in some], np.int64)
    trees = {}
    for d in np.unique(lengths).tolist():
        points = np.array([v for v in some if len(v) == d], np.float64).reshape(-1, d)
        share = n * len(points) // max(1, len(some))
        trees[d] = KMeansTree.fit(points, min(share // leaf_rows, len(points) // SAMPLE_PER_LEAF))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in matrices(batch):
                d = matrix.shape[1]
                leaf = trees.get(d, KMeansTree()).leaf_of(matrix)
                part = batch.take(pa.array(at))
                yield pa.record_batch(
                    [part.column("vec_id"), part.column("vector"), pa.array(leaf + (d << 32))],
                    names=["vec_id", "vector", "cell"],
                )

    placed = rows.mapInArrow(place, "vec_id long, vector array<double>, cell long")
    dealt, shards = dealt_to_shards(placed, SHARD_ROWS)
    visits, recall = _calibrate(rows, trees, k, target)
    return AnnIndex(dealt, trees, shards, visits, recall, k)


def _calibrate(rows: DataFrame, trees: dict, k: int, target: float) -> tuple[int, float]:
    """Leaves to visit, and the recall on the calibration queries with so many."""
    own_ids, own = sample(rows, CALIBRATION_QUERIES, seed=31)
    asked = {}
    for d in {len(v) for v in own}:
        at = [i for i, v in enumerate(own) if len(v) == d]
        asked[d] = (own_ids[at], np.array([own[i] for i in at], np.float64).reshape(len(at), d))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for at, matrix in matrices(batch):
                d = matrix.shape[1]
                if d not in asked:
                    continue
                leaf = dict(zip(ids[at].tolist(), trees[d].leaf_of(matrix).tolist(), strict=True))
                query, found, distance = (
                    np.concatenate(c) for c in zip(*_nearest(ids[at], matrix, *asked[d], k), strict=True)
                )
                yield pa.record_batch(
                    [pa.array(query), pa.array(found), pa.array(distance),
                     pa.array([leaf[i] for i in found.tolist()], pa.int64())],
                    names=["query_id", "vec_id", "score", "leaf"],
                )

    found = rows.mapInArrow(compare, "query_id long, vec_id long, score double, leaf long")
    # At most 200 x k rows.
    true = best(found.drop("leaf"), k, F.asc("score")).join(
        found.select("query_id", "vec_id", "leaf").distinct(), ["query_id", "vec_id"]
    )
    wanted: dict[int, list[int]] = {}
    for query, leaf in true.select("query_id", "leaf").collect():
        wanted.setdefault(query, []).append(leaf)
    places = []
    for d, (queries, matrix) in asked.items():
        for query, point in zip(queries.tolist(), matrix, strict=True):
            order = {leaf: i for i, leaf in enumerate(trees[d].best_bins(point))}
            places += [order[leaf] for leaf in wanted.get(query, [])]
    if not places:
        return 1, 1.0
    places = np.sort(places)
    visits = 1
    while (places < visits).mean() < target:
        visits += 1
    return visits, float((places < visits).mean())

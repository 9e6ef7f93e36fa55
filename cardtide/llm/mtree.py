"""Exact top-k inner products by best-first search of M-trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardtide.llm.common import stored
from cardtide.llm.vectors import best, dealt_to_shards, matrices, sample, searched

PAGE = 64
FANOUT = 16
SHARD_ROWS = 8192
MAX_CELLS = 256
SAMPLE_ROWS = 2048
SLACK = 1e-6


class Node:
    """A page: entries with the distance of each to the page's routing object.

    An inner entry is a child with its routing object and covering radius, a leaf entry a row.
    """

    __slots__ = ("rows", "parent", "routing", "radius", "children")

    def __init__(self, rows, parent, routing=None, radius=None, children=None):
        self.rows, self.parent = rows, parent
        self.routing, self.radius, self.children = routing, radius, children


class MTree:
    """M-tree over rows whose inner products with a query are wanted.

    With ``top`` at least the greatest squared norm, every row x gets one more coordinate
    sqrt(top - x.x) and a query q a 0. Then d(q, x)^2 = q.q + top - 2 q.x is a metric in which
    the nearest rows have the greatest inner products. The coordinate is never stored: the
    distance of two rows is worked out from their inner product and it.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, top: float):
        _, first = np.unique(np.column_stack([ids, matrix]), axis=0, return_index=True)
        self.ids, self.whole = ids[first], matrix[first]
        self.points, self.top = self.whole.astype(np.float64), top
        norms = np.einsum("ij,ij->i", self.points, self.points)
        self.lift = np.sqrt(np.maximum(top - norms, 0))
        self.norms = norms + self.lift**2
        rows = np.arange(len(self.ids))
        self.center = 0
        to_center = self._between(rows, np.array([0]))[:, 0]
        self.root = self._grow(rows, to_center)

    def _between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        inner = self.points[a] @ self.points[b].T + self.lift[a][:, None] * self.lift[b][None, :]
        square = self.norms[a][:, None] + self.norms[b][None, :] - 2 * inner
        return np.sqrt(np.maximum(square, 0))

    def _grow(self, rows: np.ndarray, to_parent: np.ndarray) -> Node:
        if len(rows) <= PAGE:
            return Node(rows, to_parent)
        routing = rows[np.linspace(0, len(rows) - 1, FANOUT).astype(int)]
        distance = self._between(rows, routing)
        nearest = distance.argmin(axis=1)
        if np.bincount(nearest).max() == len(rows):
            nearest = np.arange(len(rows)) % FANOUT  # equal rows
        kept = [g for g in range(FANOUT) if (nearest == g).any()]
        at = np.searchsorted(rows, routing)
        children = [
            self._grow(rows[nearest == g], distance[nearest == g, g]) for g in kept
        ]
        radius = np.array([distance[nearest == g, g].max() for g in kept])
        return Node(None, to_parent[at[kept]], routing[kept], radius, children)

    def search(self, own: int, query: np.ndarray, k: int, least: float):
        """The ``k`` greatest inner products: ids and scores. ``least``: a score known to be
        among the k greatest of the whole table, or minus infinity."""
        q = query.astype(np.float64)
        square = float(q @ q) + self.top
        slack = SLACK * (np.sqrt(max(square, 0)) + 1)
        far = lambda score: np.sqrt(max(square - 2 * score, 0)) + slack
        reach = far(least) if np.isfinite(least) else np.inf
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)

        def away(rows: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(square - 2 * (self.points[rows] @ q), 0))

        queue = [(0.0, 0, self.root, float(away(np.array([self.center]))[0]))]
        n_pages = 1
        while queue:
            nearest, _, node, to_parent = heapq.heappop(queue)
            if nearest > reach:
                break
            # |d(q, parent) - d(entry, parent)| bounds d(q, entry) from below, for free.
            bound = np.abs(to_parent - node.parent)
            if node.children is None:
                rows = node.rows[bound <= reach]
                rows = rows[self.ids[rows] != own]
                if len(rows):
                    ids = np.concatenate([ids, self.ids[rows]])
                    scores = np.concatenate([scores, self.whole[rows] @ query])
                    order = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[order], scores[order]
                    if len(scores) == k:
                        reach = min(reach, far(float(scores[-1])))
                continue
            open_ = np.flatnonzero(bound - node.radius <= reach)
            distance = away(node.routing[open_])
            least_away = np.maximum(distance - node.radius[open_], 0)
            for i, d, low in zip(open_.tolist(), distance.tolist(), least_away.tolist(), strict=True):
                if low <= reach:
                    heapq.heappush(queue, (low, n_pages, node.children[i], d))
                    n_pages += 1
        return ids, scores


def _lifted(matrix: np.ndarray, top: float) -> np.ndarray:
    points = matrix.astype(np.float64)
    norms = np.einsum("ij,ij->i", points, points)
    return np.column_stack([points, np.sqrt(np.maximum(top - norms, 0))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _spread(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the points, each the farthest from those before it."""
    chosen = [0]
    distance = _distances(points, points[:1])[:, 0]
    while len(chosen) < min(n, len(points)):
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, _distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """The ``k`` greatest inner products of each query: ``query_id, rank, vec_id, score``.

    ``vectors(vec_id, vector)`` and ``queries(vec_id, vector)`` hold whole numbers
    (array<bigint>). A query's own id is no candidate; vectors of another length than the query's
    are none either. Ties go to the smaller vec_id; a row that repeats id and vector counts
    once; rows with a null id, a null vector or a null component take no part. Fewer
    candidates than ``k`` are all returned; no rows, no result.

    The root of the search is a page of up to 256 routing objects, chosen from a sample of
    2,048 rows. Each row goes to the nearest; a cell of more than ``shard_rows`` rows is split by a
    hash, and each part has an M-tree of its own. A query starts with the k-th best score of
    that sample, which no final answer can be below, and visits only cells whose covering radius
    reaches that far. All queries pass each shard in batches.
    """
    vectors, queries = (
        df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<bigint>").alias("vector"))
        .filter(
            F.col("vec_id").isNotNull()
            & F.coalesce(F.forall("vector", lambda x: x.isNotNull()), F.lit(False))
        )
        for df in (vectors, queries)
    )
    # Copies would take places among the k best, in the sample's bound above all.
    vectors, queries = stored(vectors.distinct(), "vectors"), queries.distinct()
    spark = vectors.sparkSession
    norm = F.aggregate(
        "vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    n, top = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(norm), F.lit(0.0))).first()
    ids, some = sample(vectors, SAMPLE_ROWS, seed=23)
    lengths = np.array([len(v) for v in some], np.int64)
    n_cells = max(1, min(MAX_CELLS, n // shard_rows))
    pages = {}
    for d in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == d)
        matrix = np.array([some[i] for i in own], np.int64).reshape(len(own), d)
        pages[d] = (ids[own], matrix, _spread(_lifted(matrix, top), n_cells))
    shared = spark.sparkContext.broadcast(pages)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in matrices(batch):
                d = matrix.shape[1]
                cell, away = np.zeros(len(rows), np.int64), np.zeros(len(rows))
                if d in shared.value:
                    distance = _distances(_lifted(matrix, top), shared.value[d][2])
                    cell, away = distance.argmin(axis=1), distance.min(axis=1)
                part = batch.take(pa.array(rows))
                yield pa.record_batch(
                    [part.column("vec_id"), part.column("vector"), pa.array(cell + (d << 16)), pa.array(away)],
                    names=["vec_id", "vector", "cell", "away"],
                )

    placed = vectors.mapInArrow(place, "vec_id long, vector array<bigint>, cell long, away double")
    radii = dict(placed.groupBy("cell").agg(F.max("away")).collect())
    rows, shards = dealt_to_shards(placed, shard_rows)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in matrices(batch):
                d = matrix.shape[1]
                cells = [c for c in shards if c >> 16 == d]
                part = batch.take(pa.array(at))
                bounds = np.full(len(at), -np.inf)
                away = np.zeros((len(at), len(cells)))
                if d in shared.value:
                    sample_ids, sampled, routing = shared.value[d]
                    points = matrix.astype(np.float64)
                    scores = points @ sampled.astype(np.float64).T
                    own = part.column("vec_id").to_numpy()[:, None] == sample_ids[None, :]
                    scores[own] = -np.inf
                    if scores.shape[1] >= k:
                        bounds = np.partition(scores, -k, axis=1)[:, -k]
                    flat = np.column_stack([points, np.zeros(len(points))])
                    away = _distances(flat, routing)[:, [c & 0xFFFF for c in cells]]
                square = (matrix.astype(np.float64) ** 2).sum(axis=1) + top
                reach = np.sqrt(np.maximum(square - 2 * bounds, 0)) + SLACK * (np.sqrt(square) + 1)
                radius = np.array([radii[c] for c in cells])
                near = (away - radius[None, :] <= reach[:, None]) if d in shared.value else away == 0
                targets = [
                    [s for c, ok in zip(cells, row, strict=True) if ok for s in shards[c][0]]
                    for row in near.tolist()
                ]
                yield pa.record_batch(
                    [part.column("vec_id"), part.column("vector"), pa.array(bounds),
                     pa.array(targets, pa.list_(pa.int64()))],
                    names=["vec_id", "vector", "bound", "shards"],
                )

    asked = queries.mapInArrow(
        visit, "vec_id long, vector array<bigint>, bound double, shards array<long>"
    ).select(F.explode("shards").alias("shard"), "vec_id", "vector", "bound")

    def build(ids: np.ndarray, matrix: np.ndarray) -> MTree:
        return MTree(ids, matrix, top)

    def answer(tree: MTree, ids, matrix, bounds) -> list[tuple]:
        out = []
        for own, query, least in zip(ids.tolist(), matrix, bounds.tolist(), strict=True):
            found, scores = tree.search(own, query, k, least)
            out.append((np.full(len(found), own, np.int64), found, scores))
        return out

    return best(searched(rows, asked, build, answer, "long"), k, F.desc("score"))

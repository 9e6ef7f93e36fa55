"""What the two vector searches share: clean vectors, shards, and the merge of their answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SAMPLE_VALUES = 1_500_000


def finite(vector: Column) -> Column:
    """True for a vector that is not null and holds neither null, NaN nor infinity."""
    as_double = vector.cast("array<double>")
    good = F.forall(
        as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def sample(vectors: DataFrame, rows: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids and vectors of up to ``rows`` rows by a hash of the id, and at most
    ``SAMPLE_VALUES`` numbers in all; this is what the driver holds of the table."""
    widest = vectors.agg(F.max(F.size("vector"))).first()[0] or 1
    rows = max(1, min(rows, SAMPLE_VALUES // max(1, widest)))
    taken = vectors.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(rows).toArrow()
    return taken.column("vec_id").to_numpy(), [
        np.asarray(v) for v in taken.column("vector").to_pylist()
    ]


def matrices(batch: pa.RecordBatch, column: str = "vector") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a batch by length: row numbers and a matrix."""
    lists = batch.column(column)
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.r_[0, np.cumsum(lengths)]
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        yield rows, values[(starts[rows][:, None] + np.arange(d)[None, :]).ravel()].reshape(-1, d)


def searched(
    rows: DataFrame,
    queries: DataFrame,
    build: Callable[[np.ndarray, np.ndarray], object],
    answer: Callable[[object, np.ndarray, np.ndarray, np.ndarray], list[tuple]],
    score_type: str,
) -> DataFrame:
    """Answers of every query in every shard that it visits: ``query_id, vec_id, score``.

    ``rows(shard, vec_id, vector)`` and ``queries(shard, vec_id, vector, bound)`` go to the
    task of their shard, rows first. A task holds one shard, and the queries pass by in
    batches, however many they are. ``build(ids, matrix)`` makes what ``answer(built, ids,
    matrix, bounds)`` searches. All vectors of a shard have one length.
    """
    both = rows.select(
        "shard", F.lit(0).alias("kind"), "vec_id", "vector", F.lit(None).cast("double").alias("bound")
    ).unionByName(queries.select("shard", F.lit(1).alias("kind"), "vec_id", "vector", "bound"))
    dealt = both.repartition("shard").sortWithinPartitions("shard", "kind", "vec_id")
    number = pa.float64() if score_type == "double" else pa.int64()
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", number)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, built = None, [], None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            kind = batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(shard) != 0) | (np.diff(kind) != 0)) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(shard)], strict=True):
                if start == end:
                    continue
                if shard[start] != current:
                    current, parts, built = shard[start], [], None
                part = batch.slice(start, end - start)
                ids = part.column("vec_id").to_numpy()
                ((_, matrix),) = matrices(part)
                if kind[start] == 0:
                    parts.append((ids, matrix))
                    continue
                if not parts and built is None:
                    continue
                if built is None:
                    built = build(
                        np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                    )
                    parts = []
                bounds = part.column("bound").to_numpy(zero_copy_only=False)
                found = answer(built, ids, matrix, bounds)
                if found:
                    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                    yield pa.record_batch(
                        [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)],
                        schema=schema,
                    )

    return dealt.mapInArrow(run, f"query_id long, vec_id long, score {score_type}")


def best(found: DataFrame, k: int, order: Column) -> DataFrame:
    """The first ``k`` answers of each query by ``order``, then the smaller ``vec_id``.

    Rows and queries are distinct before a search, so no pair of them is found twice.
    """
    ranked = found.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))
    )
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def dealt_to_shards(placed: DataFrame, shard_rows: int) -> tuple[DataFrame, dict]:
    """Give each row of ``placed(cell, vec_id, vector, ...)`` a shard: cells above
    ``shard_rows`` rows are split by a hash of the id. Also the shards of each cell.

    Cells are few (a parameter of the search), so their counts come to the driver.
    """
    counts = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()
    shards, first, table = {}, 0, []
    for cell, n in sorted(counts):
        ways = -(-n // shard_rows)
        table.append((cell, first, ways))
        shards[cell] = (range(first, first + ways), n)
        first += ways
    spark = placed.sparkSession
    ways = F.broadcast(spark.createDataFrame(table, "cell long, first long, ways long"))
    joined = placed.join(ways, "cell")
    shard = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("ways"))
    return joined.withColumn("shard", shard).drop("first", "ways"), shards

"""What several operators share: scratch tables, checked broadcasts, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardtide.scratch import new_folder

# A word is a run of characters other than blank, tab and line ends.
WORD = r"[^\x20\x09-\x0D]+"
# A hash table of so many rows of a few numbers takes some tens of megabytes.
MAX_BROADCAST_ROWS = 500_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read that: a cut in the lineage
    that lost executors do not touch."""
    path = new_folder(df.sparkSession, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table of narrow rows for broadcast if it is counted to be small.

    Above ``max_rows`` it is returned as it is, and joins with it shuffle.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def uniform(seed: int, *columns) -> Column:
    """A number in (0, 1) that follows from the columns: the same in every run."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Union-find over ``edges(a, b)`` of longs: ``node, root``, root the smallest reachable.

    Large-star and small-star steps in turn: every step joins each node to the
    smallest node it knows of, and ends when nothing moves. Neighbour lists are never
    collected; a node with very many neighbours only meets their minimum, which is
    aggregated before the shuffle. Nodes that stand in no edge are not returned. Null
    ends and loops are ignored; raises after ``rounds`` rounds (graphs of diameter d
    need about log d).
    """
    links = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") > F.col("b"))
        .distinct(),
        "links",
    )
    n, total = _measure(links)
    for _ in range(rounds):
        if n == 0:
            break
        moved = stored(_small_star(_large_star(links)), "links")
        after = _measure(moved)
        if after == (n, total) and moved.exceptAll(links).isEmpty():
            break
        links, (n, total) = moved, after
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _measure(links: DataFrame) -> tuple[int, object]:
    sums = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), sums).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every greater neighbour of a node goes to the smallest of the node's neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select("a", F.least("a", "low").alias("low"))
    return (
        both.filter(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all go to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(least, "a")
    return (
        moved.filter(F.col("b") > F.col("low"))
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .unionByName(least.select("a", F.col("low").alias("b")))
        .distinct()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

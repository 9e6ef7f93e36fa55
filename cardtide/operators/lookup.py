"""Label each row by the smallest cumulative weight that reaches its number."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# One bound in so many, on average, is a cut; one cut in so many is a cut of the next level.
FANOUT = 32
MAX_BROADCAST_BYTES = 16 << 20
# So many bounds are one expression.
TREE = 64
# Copies of bounds too many to broadcast.
SPREAD = 16
# Fixed value: the label of a number above every bound.
NO_LABEL = "All Other"


def assign_weighted(
    df: DataFrame,
    bounds: DataFrame,
    u: str = "u",
    cum: str = "cum",
    labels: Mapping[str, str] | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    spread: int = SPREAD,
) -> DataFrame:
    """Add the label columns of the smallest ``cum`` that is >= ``u``.

    ``labels`` maps each label column of ``bounds`` to the value that rows above
    every bound (or with a null ``u``) get; by default ``{"label": "All Other"}``.
    A bound given twice keeps the greatest of its labels. ``df`` may be a stream.

    Up to 64 bounds become one expression, a tree of comparisons. More are cut at values of their
    own, chosen by hash, and the cuts again, level by level, until 64 or so are left. A row
    goes down that tree first and then by hash joins on the cut above its number, meeting some 32
    values at each level, whatever the range and number of the bounds. Bounds of up to
    ``max_broadcast_bytes`` are read once and broadcast, so ``df`` is not shuffled. Larger ones stay
    distributed, must not change while a stream runs, and are joined in ``spread`` copies, so that
    rows on one cut go to as many tasks (rows equal in all columns to one) and rows without a number
    to as many as there are.
    """
    labels = dict(labels or {"label": NO_LABEL})
    fetched = F.struct(*[F.col(name).alias(name) for name in labels])
    steps = (
        bounds.filter(F.col(cum).isNotNull())
        .groupBy(F.col(cum).cast("double").alias("_hi"))
        .agg(F.max(fetched).alias("_label"))
    )
    rows = df.withColumn("_u", F.col(u).cast("double"))
    first = steps.limit(TREE + 1).toArrow() if max_broadcast_bytes else None
    if first is not None and first.num_rows <= TREE and first.nbytes <= max_broadcast_bytes:
        found = _from_tree(rows, steps, first)
    else:
        found = _down_levels(rows, steps, max_broadcast_bytes, spread)
    return found.select(
        *[F.col(c) for c in df.columns],
        *[
            F.when(F.col("_label").isNull(), F.lit(default))
            .otherwise(F.col(f"_label.{name}"))
            .alias(name)
            for name, default in labels.items()
        ],
    )


def _from_tree(rows: DataFrame, steps: DataFrame, fetched: pa.Table) -> DataFrame:
    kind = steps.schema["_label"].dataType
    known = sorted(fetched.to_pylist(), key=lambda r: r["_hi"])
    given = [
        F.struct(*[F.lit(r["_label"][f.name]).cast(f.dataType).alias(f.name) for f in kind])
        for r in known
    ]
    values = F.array(*given).cast(f"array<{kind.simpleString()}>")
    return rows.withColumn("_label", F.get(values, _rank([r["_hi"] for r in known])))


def _rank(cuts: Sequence[float], first: int = 0) -> Column:
    """Which of the sorted cuts is the first that is >= ``_u``; their number if none is, as for
    a null or NaN."""
    if not cuts:
        return F.lit(first)
    middle = (len(cuts) - 1) // 2
    below, above = _rank(cuts[:middle], first), _rank(cuts[middle + 1 :], first + middle + 1)
    if middle:
        below = F.when(F.col("_u") <= cuts[middle - 1], below).otherwise(first + middle)
    else:
        below = F.lit(first)
    return F.when(F.col("_u") <= cuts[middle], below).otherwise(above)


def _down_levels(rows: DataFrame, steps: DataFrame, max_bytes: int, spread: int) -> DataFrame:
    n, n_bytes = steps.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.octet_length(F.to_json("_label")) + 16), F.lit(0)),
    ).first()
    few = n_bytes <= max_bytes
    if few:
        steps = rows.sparkSession.createDataFrame(steps.toArrow(), steps.schema)
    return _descended(rows, steps, n, few, spread)


def _descended(rows: DataFrame, steps: DataFrame, n: int, few: bool, spread: int) -> DataFrame:
    """``rows`` with the ``_label`` of the least bound that reaches ``_u``, or null."""
    depth = 1
    while n > 2 * FANOUT ** (depth + 1):
        depth += 1

    def values(level: int) -> DataFrame:
        """Level 0 has all bounds; each level above has one in ``FANOUT`` of the one below."""
        chosen = F.xxhash64("_hi") % F.lit(FANOUT**level) == 0
        return steps.filter(chosen).select("_hi") if level else steps

    def placed(rows: DataFrame, level: int) -> DataFrame:
        """``_cut``: the least value of the level that reaches ``_u``, infinite if none does."""
        if level == depth:
            met = rows
            cut = F.get(top, _rank(first))
        else:
            met = beside(rows, level)
            cut = _reaching("_values")["_hi"]
        cut = F.coalesce(cut, F.lit(float("inf")))
        return met.withColumn("_cut", F.when(F.col("_u").isNotNull(), cut)).drop("_values")

    def beside(rows: DataFrame, level: int) -> DataFrame:
        """``_values``: those of the level that lie under the row's cut of the level above."""
        members = values(level)
        grouped = (
            placed(members.withColumn("_u", F.col("_hi")), level + 1)
            .groupBy("_cut")
            .agg(F.sort_array(F.collect_list(F.struct(*members.columns))).alias("_values"))
        )
        if few:
            return placed(rows, level + 1).join(F.broadcast(grouped), "_cut", "left")
        copies = F.sequence(F.lit(0), F.lit(spread - 1)).cast("array<bigint>")
        return (
            placed(rows, level + 1)
            .withColumn("_copy", _copy_of(rows, spread))
            .join(grouped.withColumn("_copy", F.explode(copies)), ["_cut", "_copy"], "left")
            .drop("_copy")
        )

    # Some 64 values at most, whatever n.
    first = sorted(r["_hi"] for r in values(depth).collect())
    top = F.array(*[F.lit(c) for c in first]).cast("array<double>")
    return beside(rows, 0).withColumn("_label", _reaching("_values")["_label"])


def _copy_of(rows: DataFrame, spread: int) -> Column:
    """Which copy of the bounds a row meets, by its columns; one of many more, of which there is
    no bound, where it has no number."""
    hashable = [f.name for f in rows.schema if not _has_map(f.dataType)]
    bits = F.xxhash64(F.lit(SPREAD), *hashable)
    ways = F.when(F.col("_u").isNull(), F.lit(spread * FANOUT)).otherwise(F.lit(spread))
    return F.pmod(bits, ways.cast("bigint"))


def _has_map(kind: T.DataType) -> bool:
    return any(name in kind.simpleString() for name in ("map<", "variant"))


def _reaching(values: str) -> Column:
    """The first of the sorted values that is >= ``_u``."""
    return F.get(F.filter(values, lambda v: v["_hi"] >= F.col("_u")), 0)

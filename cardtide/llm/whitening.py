"""Whitening of vectors by the covariance of their distinct values.

Rows of one vector are brought together once, with their number. The fit runs on distinct
vectors, weighted by one or by that number: tasks centre a block of vectors and multiply
it with itself, and only d x d sums leave them. Each distinct vector is whitened once and
joined back to its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardtide.llm.common import stored
from cardtide.llm.vectors import matrices

# Vectors held by so many rows or more a share of the table are joined by broadcast.
HEAVY_SHARES = 1024
HEAVY_BYTES = 16 << 20


def whole_vector(vector: Column, scale: int = 64, offset: int = 1_000_000) -> Column:
    """``floor(scale * c) + offset`` of each entry, as double, to long; entries beyond 2^60
    count as 2^60."""
    far = float(1 << 60)
    return F.transform(
        vector.cast("array<double>"),
        lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(-far)), F.lit(far))) + F.lit(offset),
    )


@dataclass
class Fit:
    """What one vector length needs: totals, the offset near the mean, axes and shares."""

    n: int
    sums: list[int]
    near: np.ndarray  # whole numbers nearest to the mean
    rest: np.ndarray  # the mean less those
    axes: np.ndarray  # d x k, divided by the root of the eigenvalue; NaN where that is 0
    explained: list[float | None]

    def deviations(self, whole: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S)^2, exactly; null from 10^38 on."""
        shift = np.array([s - self.n * int(m) for s, m in zip(self.sums, self.near, strict=True)], object)
        moved = whole - self.near
        widest = self.n * int(np.abs(moved).max(initial=0)) + int(np.abs(shift).max(initial=0))
        if widest**2 * max(1, whole.shape[1]) < 1 << 62:
            gaps = moved * self.n - shift.astype(np.int64)
            return pa.array((gaps * gaps).sum(axis=1)).cast(pa.decimal128(38, 0))
        gaps = moved.astype(object) * self.n - shift
        exact = [int(v) for v in (gaps * gaps).sum(axis=1)]
        return pa.array([v if v < 10**38 else None for v in exact], pa.decimal128(38, 0))

    def whiten(self, whole: np.ndarray) -> np.ndarray:
        return ((whole - self.near).astype(float) - self.rest) @ self.axes


def _totals(
    table: DataFrame, vector: str, fold: Callable[[np.ndarray, np.ndarray], np.ndarray], kind: str
) -> dict[int, list]:
    """Sums over all rows of what ``fold(matrix, weights)`` gives, by vector length.

    A task adds up its batches and gives one row per number and length; the numbers are
    added up by Spark, and d x d of them, at most, come to the driver for each length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for rows, matrix in matrices(batch, vector):
                part = fold(matrix, weights[rows])
                d = matrix.shape[1]
                totals[d] = totals[d] + part if d in totals else part
        for d, total in totals.items():
            yield pa.record_batch(
                {
                    "dim": pa.array(np.full(len(total), d), pa.int32()),
                    "at": pa.array(np.arange(len(total)), pa.int32()),
                    "value": pa.array(total),
                }
            )

    parts = table.select(vector, "weight").mapInArrow(run, f"dim int, at int, value {kind}")
    value = F.col("value").cast("decimal(38,0)") if kind == "long" else F.col("value")
    summed = parts.groupBy("dim", "at").agg(F.sum(value).alias("value"))
    found: dict[int, dict[int, object]] = {}
    for row in summed.toLocalIterator():
        found.setdefault(row.dim, {})[row.at] = row.value
    return {d: [by_place[i] for i in range(len(by_place))] for d, by_place in found.items()}


def _whole_sums(matrix: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted sums of the high and the low half of every entry, and of the weights."""
    high, low = matrix >> 32, matrix & 0xFFFFFFFF
    w = weights[:, None]
    return np.concatenate([(high * w).sum(axis=0), (low * w).sum(axis=0), [weights.sum()]])


def fit(distinct: DataFrame, k: int = 16) -> dict[int, Fit]:
    """Principal axes of ``distinct(x, weight)``, by vector length.

    Vectors are centred on whole numbers exactly, then on the rest of the mean, before they
    are multiplied; the divisor is the sum of the weights. Axes are numbered by falling
    eigenvalue, each with its greatest entry positive.
    """
    fits: dict[int, Fit] = {}
    for d, values in _totals(distinct, "x", _whole_sums, "long").items():
        n = int(values[-1])
        sums = [(int(high) << 32) + int(low) for high, low in zip(values[:d], values[d:-1], strict=True)]
        near = [round(Fraction(s, n)) for s in sums]
        rest = [float(Fraction(s - n * m, n)) for s, m in zip(sums, near, strict=True)]
        fits[d] = Fit(n, sums, np.array(near, np.int64), np.array(rest), np.empty((d, 0)), [])
    plain = {d: (f.near, f.rest) for d, f in fits.items()}

    def products(matrix: np.ndarray, weights: np.ndarray) -> np.ndarray:
        near, rest = plain[matrix.shape[1]]
        centred = (matrix - near).astype(float) - rest
        return ((centred * weights[:, None]).T @ centred).ravel()

    for d, values in _totals(distinct, "x", products, "double").items():
        covariance = np.array(values).reshape(d, d) / fits[d].n
        spread, axes = np.linalg.eigh((covariance + covariance.T) / 2)
        spread, axes = spread[::-1][:k], axes[:, ::-1][:, :k]
        axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1, 1)
        trace = float(np.trace(covariance))
        flat = spread <= trace * d * np.finfo(float).eps
        roots = np.sqrt(np.where(flat, np.nan, np.maximum(spread, 0)))
        fits[d].axes = axes / roots
        fits[d].explained = [float(max(e, 0.0)) / trace if trace > 0 else None for e in spread]
    return fits


def whiten_distinct(distinct: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """``distinct(x, copies, weight)`` with ``deviation`` and ``whitened``, one value a component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in matrices(batch, "x"):
                found = fits[matrix.shape[1]]
                white = found.whiten(matrix)
                kept = batch.take(pa.array(rows))
                flat = pa.array(white.ravel(), from_pandas=True)
                offsets = np.arange(len(rows) + 1, dtype=np.int32) * white.shape[1]
                yield pa.record_batch(
                    [*kept.columns, found.deviations(matrix), pa.ListArray.from_arrays(offsets, flat)],
                    names=["x", "copies", "weight", "deviation", "whitened"],
                )

    schema = "x array<long>, copies long, weight long, deviation decimal(38,0), whitened array<double>"
    return distinct.select("x", "copies", "weight").mapInArrow(run, schema)


def identity_errors(white: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """By vector length: the largest entry of the whitened vectors' covariance less the identity,
    over the components that have any spread."""
    solid = white.select(
        F.filter("whitened", lambda z: z.isNotNull()).alias("z"), "weight", F.size("x").alias("dim")
    )
    errors = {}
    for d in fits:
        rows = solid.filter((F.col("dim") == d) & (F.size("z") > 0))
        for k, values in _totals(rows, "z", _float_sums, "double").items():
            mean = np.array(values[:-1]) / values[-1]

            def products(matrix: np.ndarray, weights: np.ndarray, mean=mean) -> np.ndarray:
                centred = matrix - mean
                return ((centred * weights[:, None]).T @ centred).ravel()

            squares = np.array(_totals(rows, "z", products, "double")[k]).reshape(k, k)
            errors[d] = float(np.abs(squares / values[-1] - np.eye(k)).max())
    return errors


def _float_sums(matrix: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.append((matrix * weights[:, None]).sum(axis=0), float(weights.sum()))


def whiten(rows: DataFrame, k: int = 16, weights: str = "one") -> DataFrame:
    """Whitened components of ``rows(vec_id, x)``, x whole numbers without null.

    Returns ``vec_id, component, n, deviation, whitened, explained, identity_error`` for
    every row and each of its first ``k`` components (as many as x has entries, if
    fewer). ``weights="one"`` fits each distinct x once, ``"copies"`` as often as it has
    rows. ``n`` is the sum of the weights and ``deviation`` the sum over dimensions of
    (n * x - S)^2 with S the weighted sums, as decimal (null from 10^38 on).

    Vectors of each length are a fit of their own. Rows with a null vec_id, and rows
    that repeat a vec_id, are whitened like others; empty vectors have no component and null
    ones take no part. Where vectors do not spread along a component (all equal, or more
    entries than vectors), ``whitened`` is null and ``explained`` 0, or null if nothing spreads.
    """
    if weights not in ("one", "copies"):
        raise ValueError(f"weights must be 'one' or 'copies', not {weights!r}")
    spark = rows.sparkSession
    rows = rows.select("vec_id", "x").filter(F.size("x") > 0)
    copies = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    weight = F.lit(1).cast("long") if weights == "one" else F.col("copies")
    distinct = stored(copies.withColumn("weight", weight), "distinct")
    fits = fit(distinct, k)
    white = stored(whiten_distinct(distinct, fits), "whitened")
    errors = identity_errors(white, fits)
    # One row per vector length.
    model = spark.createDataFrame(
        [(d, f.n, f.explained, errors.get(d)) for d, f in fits.items()],
        "dim int, n long, explained array<double>, identity_error double",
    )
    each = _joined_back(rows, white, max(fits, default=1) + k)
    each = each.join(F.broadcast(model), F.size("x") == F.col("dim"))
    parts = F.arrays_zip("whitened", "explained")
    return each.select(
        "vec_id", F.posexplode(parts).alias("at", "part"), "n", "deviation", "identity_error"
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"),
        "identity_error",
    )


def _joined_back(rows: DataFrame, white: DataFrame, values: int) -> DataFrame:
    """``vec_id, x, deviation, whitened`` of every row.

    At most ``HEAVY_SHARES`` vectors can hold more than that share of the rows each; they fit in
    ``HEAVY_BYTES`` and are broadcast. No other vector is a hot key of the shuffled join.
    """
    total = white.agg(F.sum("copies")).first()[0] or 0
    shares = max(1, min(HEAVY_SHARES, HEAVY_BYTES // (8 * values)))
    heavy = F.col("copies") * shares > total
    known = white.select("x", "copies", "deviation", "whitened")
    few = F.broadcast(known.filter(heavy).drop("copies"))
    rest = known.filter(~heavy).drop("copies")
    at_once = rows.join(few, "x")
    shuffled = rows.join(few.select("x"), "x", "left_anti").join(rest, "x")
    return at_once.unionByName(shuffled)

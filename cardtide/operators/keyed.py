"""What keyed storage leaves behind: the latest row per key, and only fresh rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardtide.schemas import RETENTION_SECONDS


def latest_per_key(df: DataFrame, keys: Sequence[str], written: Sequence[str]) -> DataFrame:
    """The row written last for each key, as an upsert on ``keys`` would keep.

    Rows are compared by ``written``, then by their other columns, so the outcome
    does not depend on task order. The maximum is taken within each task before the
    shuffle: a key with very many versions sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in written]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*written, *rest)).alias("_row"))
    return newest.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def retain(
    df: DataFrame,
    written: str = "ingest_ts",
    seconds: int = RETENTION_SECONDS,
    as_of: dt.datetime | Column | None = None,
) -> DataFrame:
    """Rows younger than ``seconds`` at ``as_of`` (now, unless given).

    A row exactly ``seconds`` old is dropped. A datetime without a zone is read in the
    session's. The bound is a constant of the column's own type, so it reaches the
    Parquet scan.
    """
    return df.filter(F.col(written) > expiry_bound(df.schema[written].dataType, seconds, as_of))


def expiry_bound(kind, seconds: int, as_of: dt.datetime | Column | None = None) -> Column:
    """The time of writing, of type ``kind``, at and before which rows have expired."""
    if as_of is None:
        now = F.current_timestamp()
    elif isinstance(as_of, dt.datetime) and as_of.tzinfo is None:
        now = F.lit(as_of.isoformat(sep=" ")).cast(kind)
    else:
        now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return (now - F.expr(f"INTERVAL '{int(seconds)}' SECOND")).cast(kind)


def point_lookup(
    minutes: DataFrame,
    year: int,
    month: int,
    day: int,
    hour: int,
    minute: int,
    calendar: str = "iso",
) -> DataFrame:
    """The minute row of a full five-part key.

    On the stored minute table the day is also asked for as ``minute_date``, so that
    only that partition is listed and read.
    """
    found = minutes.filter(
        f"year = {int(year)} AND month = {int(month)} AND day = {int(day)} "
        f"AND hour = {int(hour)} AND minute = {int(minute)}"
    )
    if "minute_date" in minutes.columns:
        iso_month = int(month) + 1 if calendar == "compat" else int(month)
        found = found.filter(F.col("minute_date") == F.lit(dt.date(int(year), iso_month, int(day))))
    return found

"""Transactions that expire by the time of writing, in tables partitioned by the day of it.

Whole days of writing are deleted once every row in them has expired, without reading one.
Readers ask for days that have not expired, so no reader meets a deleted file.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from cardtide.operators.keyed import expiry_bound, retain
from cardtide.schemas import RETENTION_SECONDS, WRITTEN_TABLE
from cardtide.sources.paths import delete_path, names_in, qualified
from cardtide.sources.tables import read_with

PREFIX = "ingest_date="


@dataclass
class Expired:
    """Days of writing that were deleted, and expired days whose files the sink still lists."""

    deleted: list[dt.date] = field(default_factory=list)
    listed: list[dt.date] = field(default_factory=list)


def _bound(seconds: int, as_of: dt.datetime | None) -> Column:
    return expiry_bound(T.TimestampType(), seconds, as_of)


def read_unexpired(
    spark: SparkSession,
    path: str,
    seconds: int = RETENTION_SECONDS,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Rows younger than ``seconds`` of a table by day of writing. Only days that can hold
    one are listed and read."""
    rows = read_with(spark, path, WRITTEN_TABLE)
    rows = rows.filter(F.col("ingest_date") >= F.to_date(_bound(seconds, as_of)))
    return retain(rows, "ingest_ts", seconds, as_of)


def expire_written(
    spark: SparkSession,
    path: str,
    seconds: int = RETENTION_SECONDS,
    as_of: dt.datetime | None = None,
    listed: str = "keep",
) -> Expired:
    """Delete the days of writing that lie wholly behind the bound.

    A stream's sink lists the files it wrote, and forgets those older than its ``retention`` when
    it next compacts the list. ``listed="keep"`` leaves a day until the list names none of its
    files, for readers of any kind; ``"delete"`` goes ahead, for readers who use
    ``read_unexpired`` only, with no greater ``seconds``. Rows are written under the clock's own day, so
    no writer adds to a day as old as that. The unknown day is never deleted.
    """
    if listed not in ("keep", "delete"):
        raise ValueError(f"listed must be 'keep' or 'delete', not {listed!r}")
    first_kept = spark.range(1).select(F.to_date(_bound(seconds, as_of))).first()[0]
    old = []
    for name in names_in(spark, path):
        if name.startswith(PREFIX):
            try:
                day = dt.date.fromisoformat(name.removeprefix(PREFIX))
            except ValueError:
                continue
            if day < first_kept:
                old.append(day)
    found = Expired()
    if not old:
        return found
    named = _listed_days(spark, path) if listed == "keep" else set()
    for day in old:
        if day in named:
            found.listed.append(day)
        else:
            delete_path(spark, f"{path}/{PREFIX}{day.isoformat()}")
            found.deleted.append(day)
    return found


def _listed_days(spark: SparkSession, path: str) -> set[dt.date]:
    """Days of which the sink's list names a file. The driver holds that list for every read."""
    if "_spark_metadata" not in names_in(spark, path):
        return set()
    below = qualified(spark, path).rstrip("/") + "/" + PREFIX
    days = set()
    for file in read_with(spark, path, WRITTEN_TABLE).inputFiles():
        if file.startswith(below) or f"/{PREFIX}" in file:
            text = file.split(f"/{PREFIX}", 1)[1].split("/", 1)[0]
            try:
                days.add(dt.date.fromisoformat(text))
            except ValueError:
                continue
    return days

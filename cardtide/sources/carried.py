"""Carried totals kept per day, so that reading some days does not start at the first one.

The table has one row per closed day: its first and last minute, how often its minutes break
off, the totals of its last run, and the totals it passes on. ``read_chained`` needs the
minutes of the days asked for and one such row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from cardtide.operators.carry import START_DAY, as_start, chained_days, chained_totals, day_ends
from cardtide.operators.keyed import latest_per_key
from cardtide.sources.paths import path_exists
from cardtide.sources.tables import read_with

CARRY_TABLE = T.StructType(
    [
        T.StructField("carry_date", T.DateType()),
        T.StructField("_day", T.LongType()),
        T.StructField("_first", T.LongType()),
        T.StructField("_last", T.LongType()),
        T.StructField("_runs", T.LongType()),
        T.StructField("_tail_total", T.LongType()),
        T.StructField("_tail_approved", T.LongType()),
        T.StructField("_total_out", T.LongType()),
        T.StructField("_approved_out", T.LongType()),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)


def read_carry(spark: SparkSession, carry_path: str) -> DataFrame:
    """One row per closed day, the one written last."""
    if not path_exists(spark, carry_path):
        return spark.createDataFrame([], CARRY_TABLE).drop("ingest_ts")
    stored = read_with(spark, carry_path, CARRY_TABLE)
    return latest_per_key(stored, ["carry_date", "_day"], ["ingest_ts"]).drop("ingest_ts")


def _last_before(carry: DataFrame, day: dt.date | None) -> DataFrame:
    """The row of the latest day ahead of ``day``, or no row."""
    earlier = carry if day is None else carry.filter(F.col("carry_date") < F.lit(day))
    names = earlier.columns
    newest = earlier.agg(F.max_by(F.struct(*names), "_day").alias("row"))
    return newest.filter(F.col("row").isNotNull()).select(*[f"row.{n}" for n in names])


def write_carry(
    minutes: DataFrame, carry_path: str, before: dt.date, changed: Iterable[dt.date] = ()
) -> int:
    """Store the rows of days ahead of ``before`` that have none, and say how many were written.

    ``minutes`` is the stored minute table with its ``minute_date``; only the days since the last
    stored row are read. Days ``changed`` since (as ``settle_minutes`` tells) are read again; for days
    after them the stored ends are chained anew, without their minutes. A closed day must not get
    minutes any more, or be told in ``changed``.
    """
    spark = minutes.sparkSession
    carry = read_carry(spark, carry_path)
    changed = sorted(d for d in set(changed) if d < before)
    kept = carry if not changed else carry.filter(F.col("carry_date") < F.lit(changed[0]))
    last = _last_before(kept, before)
    newest = carry.agg(F.max("carry_date")).first()[0]
    day = F.col("minute_date")
    fresh = day < F.lit(before)
    if newest is not None:
        fresh &= (day > F.lit(newest)) | day.isin(changed) if changed else day > F.lit(newest)
    days = day_ends(minutes.filter(fresh), F.unix_date("minute_date").cast("long"))
    if changed:
        again = (F.col("carry_date") >= F.lit(changed[0])) & ~F.col("carry_date").isin(changed)
        days = days.unionByName(carry.filter(again).select(days.columns))
    chained = chained_days(days.unionByName(as_start(last))).filter(F.col("_day") != START_DAY)
    carry_date = F.date_from_unix_date(F.col("_day").cast("int"))
    rows = chained.withColumns({"carry_date": carry_date, "ingest_ts": F.current_timestamp()})
    rows = rows.select(CARRY_TABLE.names).coalesce(1)
    rows.write.mode("append").parquet(carry_path)
    return read_carry(spark, carry_path).count() - kept.count()


def read_chained(
    minutes: DataFrame, carry_path: str, first: dt.date, last: dt.date | None = None
) -> DataFrame:
    """``chained_totals`` of the days ``first`` to ``last`` of the stored minute table.

    Reads those days, days just ahead of them that are not closed yet, and one row of the
    carry table: earlier days are pruned from the scan.
    """
    carry = read_carry(minutes.sparkSession, carry_path)
    start = _last_before(carry, first)
    known = start.select("carry_date").first()
    day = F.col("minute_date")
    wanted = day <= F.lit(last) if last is not None else F.lit(True)
    if known is not None:
        wanted &= day > F.lit(known.carry_date)
    chained = chained_totals(minutes.filter(wanted), before=start)
    return chained.filter(day >= F.lit(first))

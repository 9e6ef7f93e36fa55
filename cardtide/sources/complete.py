"""Minute rows that hold every stored transaction, late ones and the open tail included.

A minute stream gives a minute out once, when its watermark has passed, and drops what
comes later; the last minutes of a stream stay open. The transaction table has all of it. Per
day, the number of its rows tells whether the minutes given out are all: only days
where it is greater are counted again, from two columns, and a minute takes the greater count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardtide.operators.keyed import latest_per_key
from cardtide.operators.minutes import minute_rollup
from cardtide.schemas import MINUTE, MINUTE_TABLE
from cardtide.sources.paths import path_exists
from cardtide.sources.tables import read_minutes, read_transactions, read_with, write_minutes

COUNTED = ("approved_rate_min", "ttl_txn_min", "approved_txn_min")


def settled_minutes(spark: SparkSession, minutes_path: str, settled_path: str | None = None) -> DataFrame:
    """Streamed minutes with the rows that ``settle_minutes`` wrote in their place."""
    if settled_path is None or not path_exists(spark, settled_path):
        return read_minutes(spark, minutes_path)
    keys = [c for c in [*MINUTE.names, "minute_date"] if c not in COUNTED]
    both = read_with(spark, minutes_path, MINUTE_TABLE).unionByName(
        read_with(spark, settled_path, MINUTE_TABLE)
    )
    return latest_per_key(both, keys, ["ingest_ts"]).drop("ingest_ts")


def unsettled_days(minutes: DataFrame, txns: DataFrame) -> list[dt.date]:
    """Days of which ``txns`` hold more rows than ``minutes`` have counted.

    Of the transaction table only the partition day is read, so its files' footers tell. The answer
    has one entry per day at most. Rows of an unknown time belong to no minute.
    """
    stored = txns.filter(F.col("txn_date").isNotNull()).groupBy("txn_date").agg(
        F.count(F.lit(1)).alias("stored")
    )
    counted = minutes.groupBy(F.col("minute_date").alias("txn_date")).agg(
        F.sum("ttl_txn_min").alias("counted")
    )
    more = stored.join(counted, "txn_date", "left").filter(
        F.col("stored") > F.coalesce("counted", F.lit(0))
    )
    return [row.txn_date for row in more.select("txn_date").orderBy("txn_date").toLocalIterator()]


def recounted(
    minutes: DataFrame, txns: DataFrame, days: list[dt.date], calendar: str = "iso"
) -> DataFrame:
    """Minute rows of these days: each minute as counted from ``txns`` or as in ``minutes``,
    whichever has more rows, so that a transaction table behind its minute table loses nothing."""
    again = minute_rollup(txns.filter(F.col("txn_date").isin(days)), calendar=calendar)
    again = again.withColumn("minute_date", F.to_date("minute_ts"))
    known = minutes.filter(F.col("minute_date").isin(days)).select(again.columns)
    return latest_per_key(again.unionByName(known), ["minute_ts", "minute_date"], ["ttl_txn_min"])


def complete_minutes(
    spark: SparkSession,
    minutes_path: str,
    transactions_path: str,
    settled_path: str | None = None,
    calendar: str = "iso",
) -> DataFrame:
    """One row per minute that counts all stored transactions, with ``minute_date``.

    Both tables may be written by streams that still run. Days that are whole already come from
    the minute table as they are.
    """
    minutes = settled_minutes(spark, minutes_path, settled_path)
    txns = read_transactions(spark, transactions_path)
    days = unsettled_days(minutes, txns)
    if not days:
        return minutes
    rest = minutes.filter(~F.col("minute_date").isin(days))
    return rest.unionByName(recounted(minutes, txns, days, calendar))


def settle_minutes(
    spark: SparkSession,
    minutes_path: str,
    transactions_path: str,
    settled_path: str,
    before: dt.date | None = None,
    calendar: str = "iso",
) -> list[dt.date]:
    """Store what ``complete_minutes`` would count again, and say for which days.

    Only minutes whose count has grown are written, to a table beside the stream's own, whose
    list of files stays the sink's. Late rows are then counted once and not at every
    read. ``before`` leaves the days from it on, still being written, to the reader. Run again
    without new transactions it writes nothing.
    """
    minutes = settled_minutes(spark, minutes_path, settled_path)
    txns = read_transactions(spark, transactions_path)
    days = [d for d in unsettled_days(minutes, txns) if before is None or d < before]
    if days:
        known = minutes.filter(F.col("minute_date").isin(days)).select(
            "minute_ts", F.col("ttl_txn_min").alias("_known")
        )
        grown = recounted(minutes, txns, days, calendar).join(known, "minute_ts", "left")
        grown = grown.filter(F.col("ttl_txn_min") > F.coalesce("_known", F.lit(0)))
        write_minutes(grown.drop("_known"), settled_path)
    return days

"""Transactions kept once per key while they are written: a later write replaces an earlier one.

Each micro-batch is merged into the day partitions of its rows. Days in which none of its keys
stands yet only get rows added; the others are written anew, first beside the table and then
over it, so that a driver lost in between leaves a copy to go on from. A batch that runs
again finds its own rows and changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cardtide.operators.keyed import latest_per_key
from cardtide.schemas import TRANSACTION_TABLE
from cardtide.sources.paths import delete_path, names_in, path_exists
from cardtide.sources.tables import by_key, read_with, transaction_rows

DAY = "txn_date"


def merge_batch(
    rows: DataFrame, path: str, batch_id: int, keys: Sequence[str] = ("txn_id",)
) -> None:
    """Merge stored-form rows into the table at ``path``: per day and key, the row written last
    (``ingest_ts``) stays. The same batch may be merged again, as often as need be.

    A transaction keeps its day: copies of a key under another day are another row. Rows with a
    null key are one transaction, as nulls are one key; rows without a time share a day of their own.
    """
    spark = rows.sparkSession
    staged = f"{path}_merging/batch={int(batch_id)}"
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        rows = latest_per_key(rows, [DAY, *keys], ["ingest_ts"]).persist()
        try:
            days = _days(rows)
            if not days:
                return
            known = _of_days(_stored(spark, path), days)
            changed = _days(_matching(known, rows, keys))
            _write(_of_days(rows, sorted(set(days) - set(changed), key=str)), path, keys, "append")
            if not changed:
                return
            merged = _of_days(known, changed).unionByName(_of_days(rows, changed))
            _write(latest_per_key(merged, [DAY, *keys], ["ingest_ts"]), staged, keys, "overwrite")
        finally:
            rows.unpersist()
    # Only days that this copy holds are replaced, and replacing them twice is the same.
    copy = read_with(spark, staged, TRANSACTION_TABLE)
    _write(copy, path, keys, "overwrite")


def _write(rows: DataFrame, path: str, keys: Sequence[str], mode: str) -> None:
    writer = by_key(rows, DAY, keys).mode(mode).partitionBy(DAY)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    if path_exists(spark, path):
        return read_with(spark, path, TRANSACTION_TABLE)
    return spark.createDataFrame([], TRANSACTION_TABLE)


def _days(rows: DataFrame) -> list[dt.date | None]:
    """Days of a batch, or of some of the table's partitions: a handful."""
    return [row[0] for row in rows.select(DAY).distinct().toLocalIterator()]


def _of_days(rows: DataFrame, days: Sequence[dt.date | None]) -> DataFrame:
    known = [d for d in days if d is not None]
    within = F.col(DAY).isin(known) if known else F.lit(False)
    return rows.filter(within | F.col(DAY).isNull() if None in days else within)


def _matching(known: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the table whose day and key the batch has, too. Reads day and keys only."""
    wanted = rows.select(*[F.col(c).alias(f"_{c}") for c in (DAY, *keys)])
    same = F.lit(True)
    for c in (DAY, *keys):
        same &= known[c].eqNullSafe(wanted[f"_{c}"])
    return known.join(wanted, same, "left_semi")


def start_merged(
    txns: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("txn_id",),
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write a stream of transactions so that the table holds each key once, the last written.

    The time of writing is that of the micro-batch, the same if it runs again; rows of one key in one batch
    are told apart by their other columns. A batch rewrites the days in which it changes a row, so
    a trigger of minutes suits large days better than one of seconds.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        # When a batch begins, those before it are done with.
        done = [n for n in names_in(batch.sparkSession, f"{path}_merging") if n != f"batch={batch_id}"]
        for folder in done:
            delete_path(batch.sparkSession, f"{path}_merging/{folder}")
        merge_batch(batch, path, batch_id, keys)

    writer = (
        transaction_rows(txns)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
    )
    return (writer.queryName(name) if name else writer).start()

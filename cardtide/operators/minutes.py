"""Count transactions and approvals per minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardtide.functions.calendar import calendar_parts, epoch_minute, from_epoch_minute
from cardtide.functions.rates import approval_rate
from cardtide.schemas import APPROVED


def minute_row(
    minute_ts: Column, total: Column, approved: Column, calendar: str = "iso"
) -> list[Column]:
    """The nine columns of a minute row, in stored order."""
    return [
        minute_ts.alias("minute_ts"),
        *[part.alias(name) for name, part in calendar_parts(minute_ts, calendar).items()],
        approval_rate(approved, total).alias("approved_rate_min"),
        total.alias("ttl_txn_min"),
        approved.alias("approved_txn_min"),
    ]


def minute_rollup(
    txns: DataFrame,
    time: str = "txn_time",
    label: str = "start",
    calendar: str = "iso",
    counted: Column | None = None,
) -> DataFrame:
    """One row per minute that has transactions: total, approved and rate.

    Works on a batch or a stream (give the stream a watermark first). Both counts
    come from one pass, and each task sends at most one row per minute it saw, so
    a minute holding most of the data still shuffles as a handful of rows.

    ``label`` names a minute by its ``start``, or by its ``end`` as a job does
    that labels the minute just closed with the clock. A null time raises in a batch; so it does
    in the streams of ``streaming.jobs``, where else a window passes over it. Rows for which ``counted`` is not true open their minute but are not counted in
    it; they have no status.
    """
    if label not in ("start", "end"):
        raise ValueError(f"label must be 'start' or 'end', not {label!r}")
    if txns.isStreaming:
        keyed, minute_ts = F.window(time, "1 minute"), F.col(f"_minute.{label}")
    else:
        # A plain bigint key. window() would add an is-not-null filter that Catalyst
        # moves below the decoder, which then runs twice per message.
        keyed = F.coalesce(epoch_minute(F.col(time)), F.raise_error(F.lit(f"null {time}")))
        minute_ts = from_epoch_minute(F.col("_minute") + int(label == "end"))
    minutes = txns.groupBy(keyed.alias("_minute")).agg(
        (F.count(F.lit(1)) if counted is None else F.count_if(counted)).alias("_total"),
        F.count_if(F.col("status") == APPROVED).alias("_approved"),
    )
    return minutes.select(
        *minute_row(minute_ts, F.col("_total"), F.col("_approved"), calendar)
    )

"""Totals carried over minute rows: chained, trailing hour, previous minute.

Input is minute rows (``minute_rollup`` or the stored minute table), batch only.
Nothing here orders the whole table in one task. Rows are spread by calendar day,
at most 1,440 of them each; what has to cross midnight does so either as copies of
the few minutes before it, or through a table of one row per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardtide.functions.calendar import epoch_minute, from_epoch_minute
from cardtide.functions.rates import approval_rate
from cardtide.operators.minutes import minute_row

MINUTES_PER_DAY = 1440
START_DAY = -(1 << 40)
# Ten years are 5 million minutes.
MAX_DAYS = 3660


def _day(minute: Column) -> Column:
    return F.floor(minute / MINUTES_PER_DAY).cast("long")


def _by_day(minutes: DataFrame) -> DataFrame:
    numbered = minutes.withColumn("_m", epoch_minute(F.col("minute_ts")))
    return numbered.withColumn("_day", _day(F.col("_m")))


def _by_day_with_overlap(minutes: DataFrame, overlap: int) -> DataFrame:
    """``_by_day`` plus a copy of each day's last ``overlap`` minutes in the next day."""
    late = F.col("_m") % MINUTES_PER_DAY >= MINUTES_PER_DAY - overlap
    days = F.when(late, F.array("_day", F.col("_day") + 1)).otherwise(F.array("_day"))
    return _by_day(minutes).withColumn("_day", F.explode(days))


def _drop_overlap(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_day") == _day(F.col("_m"))).drop("_m", "_day")


def with_hour_columns(df: DataFrame, total: Column, approved: Column) -> DataFrame:
    return df.withColumns(
        {
            "approved_rate_hr": approval_rate(approved, total),
            "ttl_txn_hr": total,
            "approved_txn_hr": approved,
        }
    )


def chained_totals(minutes: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Running totals that go on from the previous minute's row.

    Each minute adds to the total carried by the row one minute earlier and starts
    afresh where that row is missing. Despite the ``_hr`` names nothing is taken off
    after an hour; for that see ``sliding_hour``. Fill quiet minutes first
    (``fill_quiet_minutes``) if they should carry the total along.

    ``before`` is a row of ``chained_days`` for a day ahead of all ``minutes``, whose totals
    go on into them if its last minute touches the first one here.
    """
    rows = with_runs(minutes)
    in_run = (
        Window.partitionBy("_day", "_run")
        .orderBy("_m")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumns(
        {
            "_total": F.sum("ttl_txn_min").over(in_run),
            "_approved": F.sum("approved_txn_min").over(in_run),
        }
    )
    ends = rows.groupBy("_day").agg(*_ends("_total", "_approved"))
    carried = chained_days(ends if before is None else ends.unionByName(as_start(before)))
    rows = rows.join(carried.select("_day", "_total_in", "_approved_in"), "_day", "left")
    goes_on = F.col("_run") == 0
    zero = F.lit(0).cast("long")
    total = F.col("_total") + F.when(goes_on, F.col("_total_in")).otherwise(zero)
    approved = F.col("_approved") + F.when(goes_on, F.col("_approved_in")).otherwise(zero)
    return with_hour_columns(rows, total, approved).select(
        *minutes.columns, "approved_rate_hr", "ttl_txn_hr", "approved_txn_hr"
    )


def with_runs(minutes: DataFrame, day: Column | None = None) -> DataFrame:
    """Minutes with their number ``_m``, ``_day`` (any number of the day, by default that in UTC)
    and ``_run`` of adjacent minutes in it."""
    rows = _by_day(minutes) if day is None else _by_day(minutes).withColumn("_day", day)
    in_day = Window.partitionBy("_day").orderBy("_m")
    gap = F.coalesce(F.col("_m") - F.lag("_m").over(in_day) != 1, F.lit(False))
    # Run 0 of a day is the one that may go on from the day before.
    return rows.withColumn("_gap", gap.cast("int")).withColumn("_run", F.sum("_gap").over(in_day))


def _ends(total: str, approved: str) -> list[Column]:
    return [
        F.min("_m").alias("_first"),
        F.max("_m").alias("_last"),
        F.max("_run").alias("_runs"),
        F.max_by(total, "_m").alias("_tail_total"),
        F.max_by(approved, "_m").alias("_tail_approved"),
    ]


def day_ends(minutes: DataFrame, day: Column | None = None) -> DataFrame:
    """Per day: its first and last minute, how often its minutes break off, and the totals of
    its last run. One row of six numbers per calendar day."""
    runs = with_runs(minutes, day).groupBy("_day", "_run").agg(
        F.min("_m").alias("_from"),
        F.max("_m").alias("_m"),
        F.sum("ttl_txn_min").alias("_total"),
        F.sum("approved_txn_min").alias("_approved"),
    )
    first = F.min("_from").alias("_first")
    return runs.groupBy("_day").agg(first, *_ends("_total", "_approved")[1:])


def as_start(ended: DataFrame) -> DataFrame:
    """A day of ``chained_days`` as the one to go on from, ahead of all others: what it passes on
    is its own."""
    return ended.select(
        F.lit(START_DAY).cast("long").alias("_day"),
        "_first",
        "_last",
        F.lit(1).cast("long").alias("_runs"),
        F.col("_total_out").alias("_tail_total"),
        F.col("_approved_out").alias("_tail_approved"),
    )


def chained_days(days: DataFrame) -> DataFrame:
    """``day_ends`` with the totals that each day takes over from the day before
    (``_total_in``, ``_approved_in``) and those it passes on (``_total_out``, ``_approved_out``).

    One row per calendar day, so the ordered window below sees 36,525 rows per
    century however many transactions there are.
    """
    order = Window.orderBy("_day")
    touches = F.coalesce(F.col("_first") - F.lag("_last").over(order) == 1, F.lit(False))
    days = days.withColumn("_touches", touches)
    passes_on = F.col("_touches") & (F.col("_runs") == 0)
    days = days.withColumn("_chain", F.sum((~passes_on).cast("int")).over(order))
    in_chain = (
        Window.partitionBy("_chain")
        .orderBy("_day")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    days = days.withColumns(
        {
            "_total_out": F.sum("_tail_total").over(in_chain),
            "_approved_out": F.sum("_tail_approved").over(in_chain),
        }
    )
    zero = F.lit(0).cast("long")
    taken = {
        f"{name}_in": F.when(F.col("_touches"), F.lag(f"{name}_out").over(order)).otherwise(zero)
        for name in ("_total", "_approved")
    }
    return days.withColumns(taken).drop("_touches", "_chain")


def sliding_hour(minutes: DataFrame, length: int = 60) -> DataFrame:
    """Totals over the ``length`` minutes that end with each row's minute."""
    if not 1 <= length <= MINUTES_PER_DAY:
        raise ValueError("length must be between 1 minute and 1 day")
    frame = Window.partitionBy("_day").orderBy("_m").rangeBetween(1 - length, 0)
    rows = _by_day_with_overlap(minutes, length - 1)
    rows = with_hour_columns(
        rows, F.sum("ttl_txn_min").over(frame), F.sum("approved_txn_min").over(frame)
    )
    return _drop_overlap(rows)


def with_previous(
    minutes: DataFrame,
    stored: DataFrame | None = None,
    columns: Sequence[str] = ("ttl_txn_min", "approved_txn_min"),
) -> DataFrame:
    """Add ``prev_<column>``: the value one minute earlier, 0 where there is no row.

    Without ``stored`` the earlier minute is looked up among ``minutes`` itself, in
    one window and no join; with it, in that table.
    """
    if stored is None:
        before = Window.partitionBy("_day").orderBy("_m").rangeBetween(-1, -1)
        rows = _by_day_with_overlap(minutes, 1).withColumns(
            {f"prev_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in columns}
        )
        return _drop_overlap(rows)
    earlier = stored.select(
        (F.col("minute_ts") + F.expr("INTERVAL 1 MINUTE")).alias("minute_ts"),
        *[F.col(c).alias(f"prev_{c}") for c in columns],
    )
    return minutes.join(earlier, "minute_ts", "left").fillna(0, [f"prev_{c}" for c in columns])


def fill_quiet_minutes(
    minutes: DataFrame, calendar: str = "iso", max_days: int = MAX_DAYS
) -> DataFrame:
    """Minute rows for every minute from the first to the last, quiet ones with 0.

    Raises if that is more than ``max_days``, as after one stray time far from the others.
    Reads ``minutes`` twice (once for the two ends), so give it the stored minute
    table rather than a rollup still to be computed.
    """
    numbered = minutes.select(
        epoch_minute(F.col("minute_ts")).alias("_m"), "ttl_txn_min", "approved_txn_min"
    )
    ends = numbered.agg(F.min("_m").alias("_lo"), F.max("_m").alias("_hi"))
    span = _day(F.col("_hi")) - _day(F.col("_lo"))
    apart = F.raise_error(F.concat(span.cast("string"), F.lit(f" days of minutes, over {max_days}")))
    last = F.when(span > max_days, apart.cast("long")).otherwise(_day(F.col("_hi")))
    days = ends.select(
        "_lo", "_hi", F.explode(F.sequence(_day(F.col("_lo")), last)).alias("_day")
    ).repartition("_day")
    midnight = F.col("_day") * MINUTES_PER_DAY
    every = days.select(
        F.explode(
            F.sequence(
                F.greatest("_lo", midnight),
                F.least(F.col("_hi"), midnight + (MINUTES_PER_DAY - 1)),
            )
        ).alias("_m"),
        F.lit(0).cast("long").alias("ttl_txn_min"),
        F.lit(0).cast("long").alias("approved_txn_min"),
    )
    summed = (
        numbered.unionByName(every)
        .groupBy("_m")
        .agg(
            F.sum("ttl_txn_min").alias("ttl_txn_min"),
            F.sum("approved_txn_min").alias("approved_txn_min"),
        )
    )
    return summed.select(
        *minute_row(
            from_epoch_minute(F.col("_m")),
            F.col("ttl_txn_min"),
            F.col("approved_txn_min"),
            calendar,
        )
    )

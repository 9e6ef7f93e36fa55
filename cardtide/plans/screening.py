"""Messages to transactions, transactions to minutes: the whole screening job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cardtide.functions.calendar import calendar_parts, date_text
from cardtide.functions.rules import Rule, classify
from cardtide.functions.wire import bad_rows, decode_wire, good_rows
from cardtide.operators.carry import chained_totals
from cardtide.operators.minutes import minute_rollup
from cardtide.schemas import REJECT_BELOW


def to_transactions(
    decoded: DataFrame,
    calendar: str = "iso",
    rules: Sequence[Rule] | None = None,
    reject_below: int = REJECT_BELOW,
) -> DataFrame:
    """Typed wire rows to the fifteen stored columns."""
    judged = classify(decoded, rules, reject_below)
    parts = calendar_parts(F.col("txn_time"), calendar)
    return judged.select(
        "cc_no",
        "cc_provider",
        parts["year"].alias("year"),
        parts["month"].alias("month"),
        parts["day"].alias("day"),
        parts["hour"].alias("hour"),
        parts["minute"].alias("min"),
        "txn_time",
        "txn_id",
        "merchant",
        "location",
        "country",
        "amount",
        "status",
        date_text(parts["year"], parts["month"], parts["day"]).alias("date_text"),
    )


def screen(
    messages: DataFrame,
    calendar: str = "iso",
    rules: Sequence[Rule] | None = None,
    reject_below: int = REJECT_BELOW,
    on_error: str = "fail",
) -> DataFrame:
    """Wire messages to transactions, batch or stream.

    A bad message raises, or with ``on_error="quarantine"`` is left out here and
    given out by ``unreadable``.
    """
    decoded = decode_wire(messages, on_error)
    if on_error == "quarantine":
        decoded = good_rows(decoded)
    return to_transactions(decoded, calendar, rules, reject_below)


def unreadable(messages: DataFrame) -> DataFrame:
    """The messages that ``screen`` leaves out under quarantine: ``value, problem``."""
    return bad_rows(decode_wire(messages, "quarantine"))


def screened_minutes(messages: DataFrame, calendar: str = "iso", label: str = "start") -> DataFrame:
    """Wire messages to minute rows with chained totals (batch)."""
    return chained_totals(minute_rollup(screen(messages), label=label, calendar=calendar))

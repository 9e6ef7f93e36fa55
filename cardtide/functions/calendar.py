"""Calendar parts of a timestamp, in ISO form or in the older stored form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CALENDARS = ("iso", "compat")


def calendar_parts(ts: Column, calendar: str = "iso") -> dict[str, Column]:
    """year, month, day, hour and minute of ``ts`` as int columns.

    ``iso``    months 1..12, hours 0..23.
    ``compat`` months 0..11, hours 0..11 (morning and afternoon coincide), which
               is how rows written by earlier versions of this feed are labelled.
    """
    if calendar not in CALENDARS:
        raise ValueError(f"calendar must be one of {CALENDARS}, not {calendar!r}")
    month, hour = F.month(ts), F.hour(ts)
    if calendar == "compat":
        month, hour = month - 1, hour % 12
    return {
        "year": F.year(ts),
        "month": month,
        "day": F.dayofmonth(ts),
        "hour": hour,
        "minute": F.minute(ts),
    }


def zero_padded(number: Column, width: int) -> Column:
    """``number`` as text, filled with zeros up to ``width``; never cut short."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def date_text(year: Column, month: Column, day: Column) -> Column:
    """yyyyMMdd text from parts, so that it follows the calendar they came from."""
    return F.concat(zero_padded(year, 4), zero_padded(month, 2), zero_padded(day, 2))


def epoch_minute(ts: Column) -> Column:
    """Whole minutes since 1970 as a bigint; unaffected by any time zone."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / 60).cast("long")


def from_epoch_minute(minute: Column) -> Column:
    return F.timestamp_seconds(minute * 60)

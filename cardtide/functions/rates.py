"""Approval rate in percent."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def approval_rate(approved: Column, total: Column) -> Column:
    """``approved / total * 100``, and 0.0 where nothing was counted.

    Divide first, then multiply: the other order rounds differently.
    """
    return F.coalesce(F.try_divide(approved.cast("double"), total) * 100.0, F.lit(0.0))

"""Approve or reject a transaction by an ordered list of named rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardtide.schemas import APPROVED, REJECT_BELOW, REJECTED

Rule = tuple[str, Column]


def low_score(reject_below: int = REJECT_BELOW, score: str = "score") -> Rule:
    """The default rule: the score is below ``reject_below``."""
    return ("low_score", F.col(score) < reject_below)


def classify(
    df: DataFrame,
    rules: Sequence[Rule] | None = None,
    reject_below: int = REJECT_BELOW,
    reason: str | None = None,
) -> DataFrame:
    """Add ``status``: REJECTED where any rule holds, APPROVED where none does.

    Where the rules cannot tell (a null score) the status is null rather than
    approved. ``reason`` names an extra column for the first rule that held.
    """
    rules = list(rules) if rules is not None else [low_score(reject_below)]
    if not rules:
        raise ValueError("at least one rule is needed")
    hit = rules[0][1]
    first = F.when(rules[0][1], F.lit(rules[0][0]))
    for name, held in rules[1:]:
        hit = hit | held
        first = first.when(held, F.lit(name))
    out = df.withColumn("status", F.when(hit, F.lit(REJECTED)).when(~hit, F.lit(APPROVED)))
    return out.withColumn(reason, first) if reason else out


def approved_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == APPROVED)

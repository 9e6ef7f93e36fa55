"""Read a generic ``events`` table as card transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardtide.functions.wire import card_number, card_provider

# Fixed value: issuers are numbered below this.
PROVIDERS = 9999


def wire_rows(events: DataFrame) -> DataFrame:
    """``event_id, ts, user_id, event_type, value, props`` as the ten wire columns."""
    provider = card_provider(F.col("user_id") % PROVIDERS)
    return events.select(
        card_number(provider, F.col("user_id")).alias("cc_no"),
        provider.alias("cc_provider"),
        F.col("ts").cast("timestamp").alias("txn_time"),
        F.col("event_id").cast("string").alias("txn_id"),
        F.col("event_type").alias("merchant"),
        F.lit("").alias("location"),
        F.lit("US").alias("country"),
        F.lit("").alias("items"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").cast("int").alias("score"),
    )

"""Fold line items into one wire text per basket, and take it apart again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardtide.functions.wire import decode_items, item_text
from cardtide.schemas import ITEM_SEPARATOR, MONEY


def fold_items(
    lines: DataFrame,
    key: str,
    item: Column,
    price: Column,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per basket, of any size: ``key, part, items, amount, n_items``.

    Items are listed in the order of ``order_by``, then name, then price; amounts
    add up the printed two-decimal prices exactly. ``part`` is always 0. A null item or
    price raises, as does a name that holds a separator.

    Equal entries are counted before rows move. Entries then go to tasks by ranges of
    (basket, entry), so a large basket is spread over neighbouring tasks; each lists its stretch, and
    the stretches are joined in order. Batch only, since ranges are cut from the data.
    """
    entry = F.struct(*order_by, item.alias("item"), price.cast(MONEY).alias("price"))
    counted = (
        lines.select(key, entry.alias("_entry")).groupBy(key, "_entry").agg(F.count(F.lit(1)).alias("_n"))
    )
    spread = counted.repartitionByRange(F.col(key), F.col("_entry")).select(
        key, "_entry", "_n", F.spark_partition_id().alias("_stretch")
    )
    listed = F.transform(
        F.sort_array(F.collect_list(F.struct("_entry", "_n"))),
        lambda e: F.array_repeat(item_text(e["_entry"]["item"], e["_entry"]["price"]), e["_n"].cast("int")),
    )
    stretches = spread.groupBy(key, "_stretch").agg(
        F.array_join(F.flatten(listed), ITEM_SEPARATOR).alias("_text"),
        F.sum(F.col("_entry.price") * F.col("_n")).alias("_amount"),
        F.sum("_n").alias("_items"),
    )
    texts = F.transform(
        F.sort_array(F.collect_list(F.struct("_stretch", "_text"))), lambda s: s["_text"]
    )
    return stretches.groupBy(key).agg(
        F.lit(0).alias("part"),
        F.array_join(texts, ITEM_SEPARATOR).alias("items"),
        F.sum("_amount").cast("decimal(28,2)").alias("amount"),
        F.sum("_items").alias("n_items"),
    )


def explode_items(df: DataFrame, keep: Sequence[str], items: str = "items") -> DataFrame:
    """One row per item of each ``items`` text: ``keep``, ``item``, ``price``."""
    return df.select(*keep, F.inline(decode_items(F.col(items))))


def basket_totals(parts: DataFrame, key: str) -> DataFrame:
    """Amount and item count per basket, its parts added up."""
    return parts.groupBy(key).agg(
        F.sum("amount").cast("decimal(28,2)").alias("amount"),
        F.sum("n_items").alias("n_items"),
    )

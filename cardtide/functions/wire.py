"""The delimited wire message: text to typed columns and back.

Everything is a built-in expression, so the same code runs in a batch query and
in a stream, inside whole-stage codegen, and Catalyst drops the fields that a
query does not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardtide.functions.calendar import zero_padded
from cardtide.schemas import (
    ITEM_SEPARATOR,
    ITEMS,
    MONEY,
    PRICE_ARROW,
    WIRE_FIELDS,
    WIRE_SEPARATOR,
)

_TYPES = {"txn_time": "timestamp", "amount": "double", "score": "int"}


def _or_raise(typed: Column, raw: Column, field: str) -> Column:
    shown = F.coalesce(raw, F.lit("<missing>"))
    return F.coalesce(typed, F.raise_error(F.concat(F.lit(f"bad {field}: "), shown)))


def decode_wire(
    df: DataFrame,
    on_error: str = "fail",
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Split ``value`` on ``;`` into the ten typed wire fields.

    ``fail``        a short message, bad time, amount or score raises, whether or
                    not the session is in ANSI mode. Only fields that the query
                    uses are checked.
    ``quarantine``  nothing raises; a ``problem`` column says what is wrong (null
                    for good rows) and the message itself stays in ``value``. See
                    ``good_rows`` and ``bad_rows``.

    Extra fields beyond the tenth are ignored. Casts are Spark's: blanks around a
    number and a date without a time of day are accepted.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")
    text = F.col(value).cast("string")
    # A one-element explode keeps the split in a step of its own: a filter on a decoded
    # field is not moved below it, so no message is split twice.
    split_once = F.explode(F.array(F.split(text, WIRE_SEPARATOR)))
    parts = df.select(*keep, text.alias("value"), split_once.alias("_parts"))
    raw = {name: F.get("_parts", F.lit(i)) for i, name in enumerate(WIRE_FIELDS)}
    typed = {name: raw[name].try_cast(_TYPES[name]) if name in _TYPES else raw[name] for name in raw}
    if on_error == "fail":
        return parts.select(
            *keep, *[_or_raise(typed[name], raw[name], name).alias(name) for name in WIRE_FIELDS]
        )
    fields = parts.select(
        *keep,
        "value",
        *[typed[name].alias(name) for name in WIRE_FIELDS],
        F.coalesce(F.size("_parts") < len(WIRE_FIELDS), F.lit(True)).alias("_short"),
    )
    problem = F.when(F.col("_short"), F.lit("too few fields"))
    for name in _TYPES:
        problem = problem.when(F.col(name).isNull(), F.lit(f"bad {name}"))
    return fields.withColumn("problem", problem).drop("_short")


def good_rows(quarantined: DataFrame) -> DataFrame:
    return quarantined.filter(F.col("problem").isNull()).drop("problem", "value")


def bad_rows(quarantined: DataFrame) -> DataFrame:
    """Messages set aside, with the reason; enough to mend and replay them."""
    return quarantined.filter(F.col("problem").isNotNull()).select("value", "problem")


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f``: at least one fraction digit, no trailing zeros."""
    text = ts.cast("string")
    return F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))


def encode_wire(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Write the ten wire columns as one ``value`` string.

    Nulls become empty fields. A text field that holds the separator raises,
    since the message could not be read back.
    """
    texts = []
    for name in WIRE_FIELDS:
        column = F.col(name)
        if name == "txn_time":
            text = timestamp_text(column)
        elif name == "amount":
            text = column.cast(MONEY).cast("string")
        elif name == "score":
            text = column.cast("string")
        else:
            text = F.when(
                F.contains(column, F.lit(WIRE_SEPARATOR)),
                F.raise_error(F.concat(F.lit(f"separator in {name}: "), column)),
            ).otherwise(column)
        texts.append(F.coalesce(text, F.lit("")))
    return df.select(*keep, F.concat_ws(WIRE_SEPARATOR, *texts).alias("value"))


def card_provider(number: Column) -> Column:
    """Four-digit issuer code."""
    return zero_padded(number, 4)


def card_number(provider: Column, number: Column) -> Column:
    """Sixteen-digit card number: the issuer code and twelve more digits."""
    return F.concat(provider, zero_padded(number, 12))


def item_text(item: Column, price: Column) -> Column:
    """``name->1.50``. A null, or a name that holds one of the separators, raises."""
    text = F.concat(item, F.lit(PRICE_ARROW), price.cast(MONEY).cast("string"))
    unclear = F.lit(False)
    for separator in (WIRE_SEPARATOR, ITEM_SEPARATOR, PRICE_ARROW):
        unclear = unclear | F.contains(item, F.lit(separator))
    return (
        F.when(text.isNull(), F.raise_error(F.lit("item or price is null")))
        .when(unclear, F.raise_error(F.concat(F.lit("separator in item name: "), item)))
        .otherwise(text)
    )


def decode_items(items: Column) -> Column:
    """``a->1.50,b->3.00`` as an array of (item, price).

    An array, not a map: a basket may hold the same item twice. Empty text gives
    an empty array; a price that is no number raises.
    """
    entry = F.split(items, ITEM_SEPARATOR)
    decoded = F.transform(
        entry,
        lambda x: F.struct(
            F.substring_index(x, PRICE_ARROW, 1).alias("item"),
            _or_raise(F.substring_index(x, PRICE_ARROW, -1).try_cast(MONEY), x, "price").alias(
                "price"
            ),
        ),
    )
    return F.when(items == "", F.array().cast(ITEMS)).otherwise(decoded)

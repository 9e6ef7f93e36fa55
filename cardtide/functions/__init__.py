"""Column expressions and row-wise transforms."""

from cardtide.functions.calendar import (
    calendar_parts,
    date_text,
    epoch_minute,
    from_epoch_minute,
    zero_padded,
)
from cardtide.functions.rates import approval_rate
from cardtide.functions.rules import approved_only, classify, low_score
from cardtide.functions.wire import (
    bad_rows,
    card_number,
    card_provider,
    decode_items,
    decode_wire,
    encode_wire,
    good_rows,
    item_text,
    timestamp_text,
)

__all__ = [
    "approval_rate",
    "approved_only",
    "bad_rows",
    "calendar_parts",
    "card_number",
    "card_provider",
    "classify",
    "date_text",
    "decode_items",
    "decode_wire",
    "encode_wire",
    "epoch_minute",
    "from_epoch_minute",
    "good_rows",
    "item_text",
    "low_score",
    "timestamp_text",
    "zero_padded",
]

"""DataFrame operators."""

from cardtide.operators.baskets import basket_totals, explode_items, fold_items
from cardtide.operators.carry import (
    chained_totals,
    fill_quiet_minutes,
    sliding_hour,
    with_previous,
)
from cardtide.operators.keyed import latest_per_key, point_lookup, retain
from cardtide.operators.lookup import assign_weighted
from cardtide.operators.minutes import minute_rollup

__all__ = [
    "assign_weighted",
    "basket_totals",
    "chained_totals",
    "explode_items",
    "fill_quiet_minutes",
    "fold_items",
    "latest_per_key",
    "minute_rollup",
    "point_lookup",
    "retain",
    "sliding_hour",
    "with_previous",
]

from strata.functions.keys import VOLATILE_COLUMNS, event_order, order_columns, row_hash, surrogate_key
from strata.functions.shaping import (
    cast_columns,
    explode_items,
    flatten_struct,
    misfits,
    stamp,
)

__all__ = [
    "VOLATILE_COLUMNS",
    "cast_columns",
    "event_order",
    "explode_items",
    "flatten_struct",
    "misfits",
    "order_columns",
    "row_hash",
    "stamp",
    "surrogate_key",
]

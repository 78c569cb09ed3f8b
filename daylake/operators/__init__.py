from daylake.operators.latest import distinct_rows, latest, may_be_latest, one_per_key
from daylake.operators.nested import (
    explode_items,
    garnish_detail,
    infer_items_schema,
    item_detail,
    items_wide,
    malformed_items,
    order_items,
    parse_items,
)
from daylake.operators.quality import (
    duplicate_keys,
    passes_gate,
    preview,
    profile,
    text_lengths,
)
from daylake.operators.statuses import latest_statuses, status_funnel, status_table

__all__ = [
    "distinct_rows",
    "duplicate_keys",
    "explode_items",
    "garnish_detail",
    "infer_items_schema",
    "item_detail",
    "items_wide",
    "latest",
    "latest_statuses",
    "malformed_items",
    "may_be_latest",
    "one_per_key",
    "order_items",
    "parse_items",
    "passes_gate",
    "preview",
    "profile",
    "status_funnel",
    "status_table",
    "text_lengths",
]

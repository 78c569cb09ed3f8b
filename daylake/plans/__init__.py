from daylake.plans.colocated import orders_with_last_status, publish_colocated
from daylake.plans.jobs import (
    Ingested,
    IngestFailed,
    ingest,
    ingest_each,
    items_schema,
    refresh_order_items,
    refresh_order_statuses,
    refresh_orders,
    refresh_trusted,
    registry,
)
from daylake.plans.trusted_order import (
    orders_with_consumers,
    orders_with_merchants,
    trusted_order,
)

__all__ = [
    "IngestFailed",
    "Ingested",
    "ingest",
    "ingest_each",
    "items_schema",
    "orders_with_consumers",
    "orders_with_last_status",
    "orders_with_merchants",
    "publish_colocated",
    "refresh_order_items",
    "refresh_order_statuses",
    "refresh_orders",
    "refresh_trusted",
    "registry",
    "trusted_order",
]

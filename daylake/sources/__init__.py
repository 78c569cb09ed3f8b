from daylake.sources.commits import vacuum
from daylake.sources.inferred import InferredSchemas
from daylake.sources.readers import (
    Days,
    file_inventory,
    latest_day_before,
    raw_consumers,
    raw_merchants,
    raw_orders,
    raw_status,
    read_source,
    scan,
)
from daylake.sources.registry import Registry, SchemaConflict
from daylake.sources.writers import AUTO, GateResult, stamp, write_by_day, write_day, write_flat, write_gated
from daylake.sources.zones import work_dir, zone_path

__all__ = [
    "AUTO",
    "Days",
    "GateResult",
    "InferredSchemas",
    "Registry",
    "SchemaConflict",
    "file_inventory",
    "latest_day_before",
    "raw_consumers",
    "raw_merchants",
    "raw_orders",
    "raw_status",
    "read_source",
    "scan",
    "stamp",
    "vacuum",
    "work_dir",
    "write_by_day",
    "write_day",
    "write_flat",
    "write_gated",
    "zone_path",
]

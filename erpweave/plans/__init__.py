"""The unified data sets and the end-to-end run."""

from erpweave.plans.colocated import drop_order_tables, process_stored_orders, store_order_tables
from erpweave.plans.harmonize import PublishResult, harmonize_data, publish, read_published, rejected_values
from erpweave.plans.pipelines import (
    local_material_integrated,
    process_local_material,
    process_order_integrated,
    process_process_order,
    rename_local_material,
    rename_process_order,
)

__all__ = [
    "PublishResult",
    "drop_order_tables",
    "harmonize_data",
    "local_material_integrated",
    "process_local_material",
    "process_order_integrated",
    "process_process_order",
    "process_stored_orders",
    "publish",
    "read_published",
    "rejected_values",
    "rename_local_material",
    "rename_process_order",
    "store_order_tables",
]

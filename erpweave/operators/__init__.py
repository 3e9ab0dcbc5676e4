"""``DataFrame -> DataFrame`` operators of the unification job."""

from erpweave.operators.dedup import distinct_rows, duplicate_keys, first_per_key_counted, latest_per_key
from erpweave.operators.derive import (
    derive_intra_and_inter_primary_key,
    derive_order_keys,
    post_prep_local_material,
    post_prep_process_order,
)
from erpweave.operators.integrate import (
    integration_local_material,
    integration_process_order,
    left_join,
    union_systems,
)
from erpweave.operators.prep import (
    prep_company_codes,
    prep_general_material_data,
    prep_material_valuation,
    prep_plant_and_branches,
    prep_plant_data_for_material,
    prep_sap_general_material_data,
    prep_sap_order_header_data,
    prep_sap_order_item,
    prep_sap_order_master_data,
    prep_valuation_data,
)
from erpweave.operators.quality import (
    SchemaContractError,
    check_columns_unique,
    check_schema,
    key_violations,
    mask_sensitive_columns,
    preview,
    profile_data,
)

__all__ = [
    "SchemaContractError",
    "check_columns_unique",
    "check_schema",
    "derive_intra_and_inter_primary_key",
    "derive_order_keys",
    "distinct_rows",
    "duplicate_keys",
    "integration_local_material",
    "integration_process_order",
    "key_violations",
    "latest_per_key",
    "left_join",
    "mask_sensitive_columns",
    "post_prep_local_material",
    "post_prep_process_order",
    "prep_company_codes",
    "prep_general_material_data",
    "prep_material_valuation",
    "prep_plant_and_branches",
    "prep_plant_data_for_material",
    "prep_sap_general_material_data",
    "prep_sap_order_header_data",
    "prep_sap_order_item",
    "prep_sap_order_master_data",
    "prep_valuation_data",
    "preview",
    "profile_data",
    "union_systems",
    "first_per_key_counted",
]

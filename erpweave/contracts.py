"""Schemas, rename maps and masked-column lists of the unified model.

Identifiers are strings everywhere (a numeric-looking material number such as ``0001``
must not become the integer 1). Money and weights are doubles, calendar values are dates.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S = StringType()
D = DateType()
F64 = DoubleType()
I32 = IntegerType()
TS = TimestampType()


def struct(*fields: tuple[str, DataType]) -> StructType:
    """Nullable ``StructType`` from ``(name, type)`` pairs."""
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


def names(schema: StructType) -> list[str]:
    return [field.name for field in schema.fields]


def renamed(schema: StructType, mapping: dict[str, str]) -> StructType:
    """The schema with its columns renamed by ``mapping`` (other names unchanged)."""
    return StructType([StructField(mapping.get(f.name, f.name), f.dataType, f.nullable) for f in schema.fields])


# ---------------------------------------------------------------------------------------
# Source extracts: the columns the pipelines read, by name. Calendar columns stay text at
# the source and are converted by the preparation operators (they accept text or dates).
# ---------------------------------------------------------------------------------------
SOURCE_SCHEMAS: dict[str, StructType] = {
    "MARA": struct(
        ("MANDT", S), ("MATNR", S), ("MEINS", S), ("ZZMDGM", S), ("BISMT", S), ("LVORM", S),
        ("NTGEW", F64), ("MTART", S),
    ),
    "MBEW": struct(
        ("MANDT", S), ("MATNR", S), ("BWKEY", S), ("VPRSV", S), ("VERPR", F64), ("STPRS", F64),
        ("PEINH", F64), ("BKLAS", S), ("LVORM", S), ("BWTAR", S), ("LAEPR", S),
    ),
    "MARC": struct(("SOURCE_SYSTEM_ERP", S), ("MATNR", S), ("WERKS", S), ("LVORM", S)),
    "T001W": struct(("MANDT", S), ("WERKS", S), ("BWKEY", S), ("NAME1", S)),
    "T001K": struct(("MANDT", S), ("BWKEY", S), ("BUKRS", S)),
    "T001": struct(("MANDT", S), ("BUKRS", S), ("WAERS", S)),
    "AFKO": struct(
        ("SOURCE_SYSTEM_ERP", S), ("MANDT", S), ("AUFNR", S),
        ("GLTRP", S), ("GSTRP", S), ("FTRMS", S), ("GLTRS", S), ("GSTRS", S),
        ("GSTRI", S), ("GETRI", S), ("GLTRI", S), ("FTRMI", S), ("FTRMP", S),
        ("DISPO", S), ("FEVOR", S), ("PLGRP", S), ("FHORI", S), ("AUFPL", S),
    ),
    "AFPO": struct(
        ("AUFNR", S), ("POSNR", S), ("DWERK", S), ("MATNR", S), ("MEINS", S), ("KDAUF", S),
        ("KDPOS", S), ("LTRMI", S),
    ),
    "AUFK": struct(
        ("AUFNR", S), ("OBJNR", S), ("ERDAT", S), ("ERNAM", S), ("AUART", S), ("ZZGLTRP_ORIG", S),
        ("ZZPRO_TEXT", S),
    ),
    "CDPOS": struct(("OBJNR", S), ("CHNGIND", S), ("VALUE_NEW", S)),
}

#: Columns of the extracts that the pipelines convert from text, with their target types.
TYPED_SCHEMAS: dict[str, StructType] = {
    "MARA": struct(("NTGEW", F64)),
    "MBEW": struct(("VERPR", F64), ("STPRS", F64), ("PEINH", F64)),
    "MARC": struct(("MATNR", S)),
    "AFKO": struct(*((c, D) for c in ("GLTRP", "GSTRP", "FTRMS", "GLTRS", "GSTRS", "GSTRI", "GETRI", "GLTRI", "FTRMI", "FTRMP"))),
    "AFPO": struct(("LTRMI", D)),
    "AUFK": struct(("ERDAT", D), ("ZZGLTRP_ORIG", D)),
}

ORDER_HEADER_DATES = ["GLTRP", "GSTRP", "FTRMS", "GLTRS", "GSTRS", "GSTRI", "GETRI", "GLTRI", "FTRMI", "FTRMP"]

# ---------------------------------------------------------------------------------------
# Prepared tables: the schema each system's prepared table is conformed to before the
# systems are unioned by name.
# ---------------------------------------------------------------------------------------
PREPARED_SCHEMAS: dict[str, StructType] = {
    "MARA": struct(("MANDT", S), ("MATNR", S), ("MEINS", S), ("GLOBAL_MATERIAL_NUMBER", S)),
    "MBEW": struct(
        ("MANDT", S), ("MATNR", S), ("BWKEY", S), ("VPRSV", S), ("VERPR", F64), ("STPRS", F64),
        ("PEINH", F64), ("BKLAS", S),
    ),
    "MARC": struct(("SOURCE_SYSTEM_ERP", S), ("MATNR", S), ("WERKS", S)),
    "T001W": struct(("MANDT", S), ("WERKS", S), ("BWKEY", S), ("NAME1", S)),
    "T001K": struct(("MANDT", S), ("BWKEY", S), ("BUKRS", S)),
    "T001": struct(("MANDT", S), ("BUKRS", S), ("WAERS", S)),
    "AFKO": struct(
        ("SOURCE_SYSTEM_ERP", S), ("MANDT", S), ("AUFNR", S),
        *[(c, D) for c in ORDER_HEADER_DATES],
        ("DISPO", S), ("FEVOR", S), ("PLGRP", S), ("FHORI", S), ("AUFPL", S),
        ("start_date", D), ("finish_date", D),
    ),
    "AFPO": struct(
        ("AUFNR", S), ("POSNR", S), ("DWERK", S), ("MATNR", S), ("MEINS", S), ("KDAUF", S),
        ("KDPOS", S), ("LTRMI", D),
    ),
    "AUFK": struct(
        ("AUFNR", S), ("OBJNR", S), ("ERDAT", D), ("ERNAM", S), ("AUART", S), ("ZZGLTRP_ORIG", D),
        ("ZZPRO_TEXT", S),
    ),
    "MARA_ORDER": struct(("MATNR", S), ("GLOBAL_MATERIAL_NUMBER", S), ("NTGEW", F64), ("MTART", S)),
}

# ---------------------------------------------------------------------------------------
# Output contracts, in column order (fixed values: must equal the reference's contracts).
# ---------------------------------------------------------------------------------------
LOCAL_MATERIAL_CONTRACT = struct(
    ("MANDT", S), ("SOURCE_SYSTEM_ERP", S), ("MATNR", S), ("WERKS", S), ("MEINS", S),
    ("GLOBAL_MATERIAL_NUMBER", S), ("BWKEY", S), ("NAME1", S), ("VPRSV", S), ("VERPR", F64),
    ("STPRS", F64), ("PEINH", F64), ("BKLAS", S), ("BUKRS", S), ("WAERS", S),
    ("primary_key_intra", S), ("primary_key_inter", S), ("mtl_plant_emd", S), ("global_mtl_id", S),
)

PROCESS_ORDER_CONTRACT = struct(
    ("MATNR", S), ("AUFNR", S), ("SOURCE_SYSTEM_ERP", S), ("MANDT", S),
    ("GLTRP", D), ("GSTRP", D), ("FTRMS", D), ("GLTRS", D), ("GSTRS", D), ("GSTRI", D),
    ("GETRI", D), ("GLTRI", D), ("FTRMI", D), ("FTRMP", D),
    ("DISPO", S), ("FEVOR", S), ("PLGRP", S), ("FHORI", S), ("AUFPL", S),
    ("start_date", D), ("finish_date", D),
    ("POSNR", S), ("DWERK", S), ("MEINS", S), ("KDAUF", S), ("KDPOS", S), ("LTRMI", D),
    ("OBJNR", S), ("ERDAT", D), ("ERNAM", S), ("AUART", S), ("ZZGLTRP_ORIG", D), ("ZZPRO_TEXT", S),
    ("GLOBAL_MATERIAL_NUMBER", S), ("NTGEW", F64), ("MTART", S),
    ("primary_key_intra", S), ("primary_key_inter", S), ("on_time_flag", I32),
    ("actual_on_time_deviation", F64), ("late_delivery_bucket", S), ("mto_vs_mts_flag", S),
    ("order_finish_timestamp", TS), ("order_start_timestamp", TS),
)

# Columns hashed in each output (must equal the reference's lists).
LOCAL_MATERIAL_MASKED = ["GLOBAL_MATERIAL_NUMBER", "NAME1", "BUKRS", "mtl_plant_emd", "MATNR"]
PROCESS_ORDER_MASKED = ["AUFNR", "MATNR", "KDPOS", "KDAUF", "ERNAM", "OBJNR"]

# Derived columns that still carry raw identifiers after the default masking; hashed too
# when a pipeline runs with ``mask_derived=True``.
LOCAL_MATERIAL_DERIVED_IDS = ["primary_key_intra", "primary_key_inter", "global_mtl_id"]
PROCESS_ORDER_DERIVED_IDS = ["primary_key_intra", "primary_key_inter", "GLOBAL_MATERIAL_NUMBER"]

PRIMARY_KEYS = ["primary_key_intra", "primary_key_inter"]

# Business names of the local material output (must equal the reference's
# map; mtl_plant_emd is not in it and keeps its name).
LOCAL_MATERIAL_RENAME = {
    "MATNR": "material_number",
    "WERKS": "plant",
    "SOURCE_SYSTEM_ERP": "source_system_erp",
    "MANDT": "client",
    "MEINS": "base_unit_of_measure",
    "GLOBAL_MATERIAL_NUMBER": "global_material_number",
    "BWKEY": "valuation_area",
    "NAME1": "branch_name",
    "VPRSV": "price_control_indicator",
    "VERPR": "moving_average_price",
    "STPRS": "standard_price",
    "PEINH": "price_unit",
    "BKLAS": "valuation_class",
    "BUKRS": "company_code",
    "WAERS": "currency_key",
    "primary_key_intra": "primary_key_intra",
    "primary_key_inter": "primary_key_inter",
    "global_mtl_id": "global_mtl_id",
}

# Business names of the process order output (must equal the reference's
# map). Note GLTRP (basic finish) -> planned_start_date, GSTRP (basic start) ->
# planned_finish_date and LTRMI (actual delivery) -> requested_delivery_date, as there.
PROCESS_ORDER_RENAME = {
    "MATNR": "material_number",
    "AUFNR": "order_number",
    "SOURCE_SYSTEM_ERP": "source_system_erp",
    "MANDT": "client",
    "GLTRP": "planned_start_date",
    "GSTRP": "planned_finish_date",
    "FTRMS": "scheduled_start_date",
    "GLTRS": "actual_start_date",
    "GSTRS": "actual_finish_date",
    "GSTRI": "planned_start_date_internal",
    "GETRI": "planned_finish_date_internal",
    "GLTRI": "actual_start_date_internal",
    "FTRMI": "scheduled_start_date_internal",
    "FTRMP": "scheduled_finish_date_internal",
    "DISPO": "mrp_controller",
    "FEVOR": "production_supervisor",
    "PLGRP": "planner_group",
    "FHORI": "scheduling_direction",
    "AUFPL": "routing_number",
    "start_date": "start_date",
    "finish_date": "finish_date",
    "POSNR": "item_number",
    "DWERK": "plant",
    "MEINS": "base_unit_of_measure",
    "KDAUF": "sales_order",
    "KDPOS": "sales_order_item",
    "LTRMI": "requested_delivery_date",
    "OBJNR": "object_number",
    "ERDAT": "creation_date",
    "ERNAM": "created_by",
    "AUART": "order_type",
    "ZZGLTRP_ORIG": "original_planned_start_date",
    "ZZPRO_TEXT": "production_order_text",
    "GLOBAL_MATERIAL_NUMBER": "global_material_number",
    "NTGEW": "net_weight",
    "MTART": "material_type",
    "primary_key_intra": "primary_key_intra",
    "primary_key_inter": "primary_key_inter",
    "on_time_flag": "on_time_flag",
    "actual_on_time_deviation": "actual_on_time_deviation",
    "late_delivery_bucket": "late_delivery_bucket",
    "mto_vs_mts_flag": "mto_vs_mts_flag",
    "order_finish_timestamp": "order_finish_timestamp",
    "order_start_timestamp": "order_start_timestamp",
}

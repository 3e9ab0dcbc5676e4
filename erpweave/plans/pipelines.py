"""The two unified data sets, each built as one lazy plan over every source system.

Per system each extract is prepared (filter, project, de-duplicate) and conformed to the
prepared schema; the systems are unioned by name; the union is integrated by the join
chain, post-processed, masked and checked against its contract. Nothing runs until the
caller writes or collects the result, so Catalyst sees (and prunes, pushes down and
co-plans) the whole job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from erpweave import contracts as C
from erpweave.operators import (
    check_columns_unique,
    check_schema,
    integration_local_material,
    integration_process_order,
    mask_sensitive_columns,
    post_prep_local_material,
    post_prep_process_order,
    prep_company_codes,
    prep_general_material_data,
    prep_material_valuation,
    prep_plant_and_branches,
    prep_plant_data_for_material,
    prep_sap_general_material_data,
    prep_sap_order_header_data,
    prep_sap_order_item,
    prep_sap_order_master_data,
    union_systems,
)
from erpweave.operators.dedup import distinct_rows
from erpweave.operators.guards import require_bool
from erpweave.sources.conform import conform
from erpweave.sources.registry import Sources

SYSTEM_TAG = "__erpweave_system"
ORIGIN = "__erpweave_origin"  # number of the source system, in the order of ``sources.systems``


def _prepared(frame: DataFrame, table: str, system: str, isolate: bool, extra: Sequence[str] = ()) -> DataFrame:
    out = conform(frame, C.PREPARED_SCHEMAS[table], keep_extra=bool(extra))
    return out.withColumn(SYSTEM_TAG, F.lit(system)) if isolate else out


def _valuation_schema(frames: Sequence[DataFrame]) -> StructType:
    """The valuation columns in their prepared types; LAEPR in the systems' common type, else text."""
    found = {f.schema["LAEPR"].dataType for f in frames if "LAEPR" in f.columns}
    laepr = found.pop() if len(found) == 1 else StringType()
    flags = C.struct(("LVORM", StringType()), ("BWTAR", StringType()), ("LAEPR", laepr))
    return StructType([*C.PREPARED_SCHEMAS["MBEW"].fields, *flags.fields])


def local_material_integrated(
    spark: SparkSession,
    sources: Sources,
    global_material_column: str = "ZZMDGM",
    check_old_material_number: bool = True,
    check_material_deleted: bool = True,
    check_plant_deleted: bool = True,
    drop_duplicate_plants: bool = True,
    additional_plant_fields: list[str] | None = None,
    valuation_keys: Sequence[str] = ("MATNR", "BWKEY"),
    isolate_systems: bool = False,
) -> DataFrame:
    """Prepared, unioned and joined local material rows (before post-processing).

    ``isolate_systems=True`` adds the source system to every join key, so equal material
    numbers of different systems do not match (the reference matches them). ``FOREIGN``
    counts the joined rows of other systems; the final de-duplication takes the row with the
    fewest and drops the column.
    """
    require_bool(drop_duplicate_plants, "drop_duplicate_records")
    tables: dict[str, list[DataFrame]] = {t: [] for t in ("MARA", "MBEW", "MARC", "T001K", "T001W", "T001")}
    extra = additional_plant_fields or []
    loaded = {system: sources.load(spark, system, "MBEW") for system in sources.systems}
    valuation = _valuation_schema(list(loaded.values()))
    for number, system in enumerate(sources.systems):
        load = lambda table: sources.load(spark, system, table)
        prepared: dict[str, DataFrame] = {
            "MARA": prep_general_material_data(
                load("MARA"), global_material_column, check_old_material_number, check_material_deleted
            ),
            "MARC": prep_plant_data_for_material(load("MARC"), check_plant_deleted, False, extra or None),
            "T001K": load("T001K").select(*C.names(C.PREPARED_SCHEMAS["T001K"])),
            "T001W": prep_plant_and_branches(load("T001W")),
            "T001": prep_company_codes(load("T001")),
        }
        typed = {t: _prepared(frame, t, system, isolate_systems, extra if t == "MARC" else ()) for t, frame in prepared.items()}
        mbew = conform(loaded[system], valuation, allow_missing=True)
        typed["MBEW"] = mbew.withColumn(SYSTEM_TAG, F.lit(system)) if isolate_systems else mbew
        for table, frame in typed.items():
            tables[table].append(frame.withColumn(ORIGIN, F.lit(number)))
    # The systems are unioned before their windows and distincts, which run once with the
    # system in the key: the number of shuffles does not grow with the number of systems.
    union = {table: union_systems(frames) for table, frames in tables.items()}
    tags = [ORIGIN, *([SYSTEM_TAG] if isolate_systems else [])]
    # Valuations go by material before their window, whose rows are then in the order and the
    # place that the join by material needs.
    union["MBEW"] = prep_material_valuation(union["MBEW"].repartition("MATNR"), [*valuation_keys, ORIGIN], keep=tags)
    union["T001K"] = distinct_rows(union["T001K"])
    # Plant rows go by material from the start: their distinct, the joins with materials and
    # valuations and the final de-duplication then need no other shuffle of them while the
    # organisational tables are broadcast, and the rows that the joins fan out are not moved.
    union["MARC"] = union["MARC"].repartition("MATNR")
    if drop_duplicate_plants:
        union["MARC"] = distinct_rows(union["MARC"])
    return integration_local_material(
        union["MARA"],
        union["MBEW"],
        union["MARC"],
        union["T001K"],
        union["T001W"],
        union["T001"],
        extra_keys=[SYSTEM_TAG] if isolate_systems else (),
        origin=ORIGIN,
    ).drop(SYSTEM_TAG)


def process_local_material(
    spark: SparkSession,
    sources: Sources,
    mask: bool = True,
    mask_derived: bool = False,
    mask_salt: str | None = None,
    mask_key: str | None = None,
    count_duplicates: bool = False,
    check_keys: bool = False,
    **options,
) -> DataFrame:
    """Local material: one row per (system, material, plant), 19 contract columns.

    ``options`` go to :func:`local_material_integrated`. ``mask_derived`` also hashes the
    keys and ``global_mtl_id``, which otherwise keep the raw material number.
    ``check_keys`` runs the raising uniqueness check of both keys right away (one extra
    job over the key columns); :func:`erpweave.plans.harmonize_data` instead checks the
    written output without evaluating the plan twice.
    """
    integrated = local_material_integrated(spark, sources, **options)
    result = post_prep_local_material(integrated, count_duplicates=count_duplicates)
    extra = ["no_of_duplicates"] if count_duplicates else []
    result = result.select(*C.names(C.LOCAL_MATERIAL_CONTRACT), *extra)
    if mask:
        masked = C.LOCAL_MATERIAL_MASKED + (C.LOCAL_MATERIAL_DERIVED_IDS if mask_derived else [])
        result = mask_sensitive_columns(result, masked, mask_salt, mask_key)
    if not count_duplicates:
        check_schema(result, C.LOCAL_MATERIAL_CONTRACT)
    if check_keys:
        check_columns_unique(result, C.PRIMARY_KEYS)
    return result


def process_order_tables(
    spark: SparkSession,
    sources: Sources,
    global_material_column: str = "ZZMDGM",
    as_of: dt.date | str | Column | None = None,
    date_formats: list[str] | None = None,
    with_changes: bool = False,
    isolate_systems: bool = False,
    change_columns: Sequence[str] = ("OBJNR", "CHNGIND", "VALUE_NEW"),
) -> dict[str, DataFrame | None]:
    """The prepared tables of process order, unioned over the systems (CDPOS: None unless asked for)."""
    names = ["AFKO", "AFPO", "AUFK", "MARA_ORDER"]
    tables: dict[str, list[DataFrame]] = {t: [] for t in names}
    changes: list[DataFrame] = []
    for system in sources.systems:
        load = lambda table: sources.load(spark, system, table)
        prepared = {
            "AFKO": prep_sap_order_header_data(load("AFKO"), as_of, date_formats),
            "AFPO": prep_sap_order_item(load("AFPO"), date_formats),
            "AUFK": prep_sap_order_master_data(load("AUFK"), date_formats),
            "MARA_ORDER": prep_sap_general_material_data(load("MARA"), global_material_column),
        }
        for table, frame in prepared.items():
            tables[table].append(_prepared(frame, table, system, isolate_systems))
        if with_changes:
            cdpos = load("CDPOS").select(*change_columns)
            changes.append(cdpos.withColumn(SYSTEM_TAG, F.lit(system)) if isolate_systems else cdpos)
    union: dict[str, DataFrame | None] = {table: union_systems(frames) for table, frames in tables.items()}
    union["CDPOS"] = union_systems(changes) if with_changes else None
    return union


def process_order_integrated(spark: SparkSession, sources: Sources, isolate_systems: bool = False, **options) -> DataFrame:
    """Prepared, unioned and joined process order rows (before post-processing).

    ``options`` as for :func:`process_order_tables`; ``change_columns`` are the columns taken
    from the change items (OBJNR is the join key).
    """
    tables = process_order_tables(spark, sources, isolate_systems=isolate_systems, **options)
    integrated = integration_process_order(
        tables["AFKO"],
        tables["AFPO"],
        tables["AUFK"],
        tables["MARA_ORDER"],
        tables["CDPOS"],
        extra_keys=[SYSTEM_TAG] if isolate_systems else (),
    )
    return integrated.drop(SYSTEM_TAG)


def process_process_order(
    spark: SparkSession,
    sources: Sources,
    mask: bool = True,
    mask_derived: bool = False,
    mask_salt: str | None = None,
    mask_key: str | None = None,
    check_keys: bool = False,
    sign: str = "planned_minus_actual",
    **options,
) -> DataFrame:
    """Process order: one row per order item (grain not enforced), 44 contract columns.

    ``check_keys`` as for :func:`process_local_material`; ``sign`` as for
    :func:`erpweave.functions.deviation_days`.
    """
    integrated = process_order_integrated(spark, sources, **options)
    result = finished_process_order(integrated, options.get("date_formats"), mask, mask_derived, mask_salt, mask_key, sign)
    if check_keys:
        check_columns_unique(result, C.PRIMARY_KEYS)
    return result


def finished_process_order(
    integrated: DataFrame,
    date_formats: list[str] | None = None,
    mask: bool = True,
    mask_derived: bool = False,
    mask_salt: str | None = None,
    mask_key: str | None = None,
    sign: str = "planned_minus_actual",
) -> DataFrame:
    """Derivations, contract columns, masking and contract check over integrated order rows."""
    result = post_prep_process_order(integrated, date_formats, sign)
    result = result.select(*C.names(C.PROCESS_ORDER_CONTRACT))
    if mask:
        masked = C.PROCESS_ORDER_MASKED + (C.PROCESS_ORDER_DERIVED_IDS if mask_derived else [])
        result = mask_sensitive_columns(result, masked, mask_salt, mask_key)
    check_schema(result, C.PROCESS_ORDER_CONTRACT)
    return result


def rename_local_material(df: DataFrame) -> DataFrame:
    """Business column names (one projection)."""
    return df.withColumnsRenamed(C.LOCAL_MATERIAL_RENAME)


def rename_process_order(df: DataFrame) -> DataFrame:
    """Business column names (one projection)."""
    return df.withColumnsRenamed(C.PROCESS_ORDER_RENAME)

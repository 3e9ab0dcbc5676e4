"""Post-processing: keys, flags, buckets, dates and the final de-duplication.

All derivations are added with ``withColumns`` (one Project, collapsed by Catalyst), so
they run in the same whole-stage-codegen span as the join that feeds them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.functions import (
    deviation_days,
    key_skipping_nulls,
    key_with_blanks,
    late_bucket,
    mto_vs_mts,
    on_time_flag,
    to_date_safe,
)
from erpweave.operators.dedup import asc_nulls_last, first_per_key_counted, latest_per_key

# The plant before the material: the de-duplication leaves the rows sorted by these, and the
# masked plant names repeat in a file then. The system first, by which the output is laid out.
MATERIAL_GRAIN = ["SOURCE_SYSTEM_ERP", "WERKS", "MATNR"]
ORDER_GRAIN = ["AUFNR", "POSNR", "DWERK"]
# Number of joined tables whose row came from another system than the plant's row.
FOREIGN = "__erpweave_foreign"


def derive_intra_and_inter_primary_key(df: DataFrame) -> DataFrame:
    """Material keys: ``MATNR-WERKS`` and ``SYSTEM-MATNR-WERKS``; a null part is ''."""
    return df.withColumns(
        {
            "primary_key_intra": key_with_blanks("MATNR", "WERKS"),
            "primary_key_inter": key_with_blanks("SOURCE_SYSTEM_ERP", "MATNR", "WERKS"),
        }
    )


def _material_order(columns: Sequence[str]) -> list[str]:
    first = [c for c in (FOREIGN, "MANDT", "BWKEY", "BUKRS") if c in columns]
    return first + [c for c in columns if c not in first and c not in MATERIAL_GRAIN]


def material_dedup_order(columns: Sequence[str]) -> list[Column]:
    """Deterministic order for the final de-duplication: rows joined within the plant's own
    system first (if the systems are known), then client, valuation area and company code,
    then every remaining column, ascending with nulls last."""
    return asc_nulls_last(_material_order(columns))


def post_prep_local_material(
    df: DataFrame,
    order_by: Sequence[Column] | None = None,
    count_duplicates: bool = False,
) -> DataFrame:
    """One row per (system, material, plant), then keys, ``mtl_plant_emd``, ``global_mtl_id``.

    ``mtl_plant_emd`` is ``WERKS-NAME1`` (a null name leaves the plant alone) and
    ``global_mtl_id`` the global number, else the material number. The derived columns
    are functions of the surviving row, so they are added after the de-duplication: the
    window's shuffle carries only the input columns. With ``count_duplicates`` the rows
    sharing a grain key are counted in ``no_of_duplicates`` (in the default order only).
    """
    if count_duplicates:
        if order_by is not None:
            msg = "count_duplicates goes with the default order"
            raise ValueError(msg)
        survivors = first_per_key_counted(df, MATERIAL_GRAIN, _material_order(df.columns))
    else:
        order = list(order_by) if order_by is not None else material_dedup_order(df.columns)
        survivors = latest_per_key(df, MATERIAL_GRAIN, order)
    survivors = survivors.drop(FOREIGN)
    return derive_intra_and_inter_primary_key(survivors).withColumns(
        {
            "mtl_plant_emd": F.concat_ws("-", F.col("WERKS"), F.col("NAME1")),
            "global_mtl_id": F.coalesce(F.col("GLOBAL_MATERIAL_NUMBER"), F.col("MATNR")),
        }
    )


def derive_order_keys(df: DataFrame) -> DataFrame:
    """Order keys ``AUFNR_POSNR_DWERK`` and ``SYSTEM_AUFNR_POSNR_DWERK`` (nulls skipped)."""
    return df.withColumns(
        {
            "primary_key_intra": key_skipping_nulls(*ORDER_GRAIN),
            "primary_key_inter": key_skipping_nulls("SOURCE_SYSTEM_ERP", *ORDER_GRAIN),
        }
    )


def post_prep_process_order(
    df: DataFrame, date_formats: list[str] | None = None, sign: str = "planned_minus_actual"
) -> DataFrame:
    """Keys, on-time flag, day deviation, lateness bucket, MTO/MTS and timestamps.

    A missing ZZGLTRP_ORIG column is added as a typed null first. Deviation is planned
    minus actual (positive = delivered before the plan), as in the reference, unless ``sign``
    is "actual_minus_planned" (buckets follow it); the flag is 1 when planned >= actual.
    """
    if "ZZGLTRP_ORIG" not in df.columns:
        df = df.withColumn("ZZGLTRP_ORIG", F.lit(None).cast("date"))
    df = df.withColumns(
        {c: to_date_safe(c, df.schema[c].dataType, date_formats) for c in ("ZZGLTRP_ORIG", "LTRMI", "GSTRI")}
    )
    return (
        derive_order_keys(df)
        .withColumns(
            {
                "on_time_flag": on_time_flag(),
                "actual_on_time_deviation": deviation_days(sign=sign),
            }
        )
        .withColumns(
            {
                "late_delivery_bucket": late_bucket(),
                "mto_vs_mts_flag": mto_vs_mts(),
                "order_finish_timestamp": F.to_timestamp(F.col("LTRMI")),
                "order_start_timestamp": F.to_timestamp(F.col("GSTRI")),
            }
        )
    )

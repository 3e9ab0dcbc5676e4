"""Per-table preparation: filter, project, convert dates, deduplicate.

Each operator is ``DataFrame -> DataFrame`` and only adds Filter/Project/Window/Aggregate
nodes to the plan; filters come before projections so parquet sources get them pushed to
the scan, and the projection prunes wide extracts down to the needed columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from erpweave.contracts import ORDER_HEADER_DATES
from erpweave.functions import (
    month_start,
    no_split_valuation,
    not_deleted,
    not_deleted_or_blank,
    old_material_number_valid,
    to_date_safe,
)
from erpweave.operators.dedup import asc_nulls_last, desc_nulls_last, distinct_rows, latest_per_key
from erpweave.operators.guards import require_bool, require_dataframe, require_str

# ---------------------------------------------------------------------------------------
# Local material tables
# ---------------------------------------------------------------------------------------


def prep_general_material_data(
    df: DataFrame,
    col_mara_global_material_number: str,
    check_old_material_number_is_valid: bool = True,
    check_material_is_not_deleted: bool = True,
) -> DataFrame:
    """General material (MARA): drop retired and deleted materials, keep 4 columns.

    The configurable global number column is renamed ``GLOBAL_MATERIAL_NUMBER``.
    """
    require_dataframe(df)
    require_str(col_mara_global_material_number, "col_mara_global_material_number must be a string")
    require_bool(check_old_material_number_is_valid, "check_old_material_number_is_valid")
    require_bool(check_material_is_not_deleted, "check_material_is_not_deleted")

    if check_old_material_number_is_valid:
        df = df.filter(old_material_number_valid())
    if check_material_is_not_deleted:
        df = df.filter(not_deleted_or_blank())
    return df.select(
        "MANDT",
        "MATNR",
        "MEINS",
        F.col(col_mara_global_material_number).alias("GLOBAL_MATERIAL_NUMBER"),
    )


VALUATION_COLUMNS = ["MANDT", "MATNR", "BWKEY", "VPRSV", "VERPR", "STPRS", "PEINH", "BKLAS"]


# Latest evaluation first (a missing LAEPR loses); equal dates go to the higher prices,
# then the smaller codes, so the surviving row is the same on every run.
VALUATION_ORDER = [
    ("LAEPR", "desc"),
    ("VERPR", "desc"),
    ("STPRS", "desc"),
    ("VPRSV", "asc"),
    ("BKLAS", "asc"),
    ("PEINH", "desc"),
    ("MANDT", "asc"),
]


# Patterns, besides ISO, in which an extract may deliver LAEPR as text.
VALUATION_DATE_FORMATS = ("dd.MM.yyyy", "MM/dd/yyyy")


def evaluation_order(dtype: DataType, formats: Sequence[str] = VALUATION_DATE_FORMATS) -> list[Column]:
    """LAEPR, latest first and missing last.

    Text in any mix of forms ranks by one number, the moment it stands for as yyyyMMdd and a
    part of the day: compact and ISO dates with or without a time, and ``formats``. Digits that
    are no date count as that number; the rest comes last, as text.
    """
    if not isinstance(dtype, StringType):
        return desc_nulls_last(["LAEPR"])
    text = F.trim("LAEPR")
    moment = F.coalesce(
        F.when(text.rlike("^[0-9]{14}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))),
        F.when(text.rlike("^[0-9]{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd"))),
        F.when(text.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), text.try_cast("timestamp")),
        F.when(~text.rlike("^[0-9]*$"), to_date_safe("LAEPR", dtype, list(formats)).cast("timestamp")),
    )
    day = F.year(moment) * 10_000 + F.month(moment) * 100 + F.dayofmonth(moment)
    seconds = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    rank = F.coalesce((day + seconds / 86_400).cast("decimal(38,10)"), text.try_cast("decimal(38,10)"))
    return [rank.desc_nulls_last(), F.col("LAEPR").desc_nulls_last()]


def valuation_order(
    columns: Sequence[str], laepr: DataType | None = None, formats: Sequence[str] = VALUATION_DATE_FORMATS
) -> list[Column]:
    present = set(columns)
    order: list[Column] = []
    for name, direction in VALUATION_ORDER:
        if name == "LAEPR" and name in present and laepr is not None:
            order += evaluation_order(laepr, formats)
        elif name in present:
            order += (desc_nulls_last if direction == "desc" else asc_nulls_last)([name])
    return order


def prep_material_valuation(
    df: DataFrame,
    keys: Sequence[str] = ("MATNR", "BWKEY"),
    date_formats: Sequence[str] = VALUATION_DATE_FORMATS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Material valuation (MBEW): undeleted, not split-valuated, latest LAEPR per key.

    ``keys`` defaults to the reference's (MATNR, BWKEY); pass ("MANDT", "MATNR", "BWKEY")
    to keep clients apart. A LAEPR that arrives as text is converted for the ranking (see
    ``evaluation_order``; ``date_formats`` are tried after ISO). ``keep`` names further
    columns to carry along.
    """
    require_dataframe(df)
    kept = df.filter(not_deleted() & no_split_valuation())
    laepr = df.schema["LAEPR"].dataType if "LAEPR" in df.columns else None
    latest = latest_per_key(kept, list(keys), valuation_order(df.columns, laepr, date_formats))
    # One row per key is left: equal rows remain only where a key is not among the columns.
    columns = [*VALUATION_COLUMNS, *keep]
    return latest.select(*columns) if set(keys) <= set(columns) else distinct_rows(latest.select(*columns))


def prep_plant_data_for_material(
    df: DataFrame,
    check_deletion_flag_is_null: bool,
    drop_duplicate_records: bool,
    additional_fields: list | None = None,
) -> DataFrame:
    """Plant data for material (MARC): optional deletion filter, 3 columns plus extras."""
    require_dataframe(df)
    require_bool(check_deletion_flag_is_null, "check_deletion_flag_is_null")
    require_bool(drop_duplicate_records, "drop_duplicate_records")
    if additional_fields and not isinstance(additional_fields, list):
        msg = "additional_fields must be a list of columns"
        raise TypeError(msg)

    if check_deletion_flag_is_null:
        df = df.filter(not_deleted())
    columns = ["SOURCE_SYSTEM_ERP", "MATNR", "WERKS", *(additional_fields or [])]
    df = df.select(*columns)
    return distinct_rows(df) if drop_duplicate_records else df


def prep_plant_and_branches(df: DataFrame) -> DataFrame:
    """Plants/branches (T001W): 4 columns."""
    require_dataframe(df)
    return df.select("MANDT", "WERKS", "BWKEY", "NAME1")


def prep_valuation_data(df: DataFrame) -> DataFrame:
    """Valuation area (T001K): 3 columns, distinct."""
    require_dataframe(df)
    return distinct_rows(df.select("MANDT", "BWKEY", "BUKRS"))


def prep_company_codes(df: DataFrame) -> DataFrame:
    """Company codes (T001): 3 columns."""
    require_dataframe(df)
    return df.select("MANDT", "BUKRS", "WAERS")


# ---------------------------------------------------------------------------------------
# Process order tables
# ---------------------------------------------------------------------------------------

_ORDER_GUARD = "Invalid input DataFrame"


def _date(df: DataFrame, column: str, formats: list[str] | None) -> Column:
    return to_date_safe(column, df.schema[column].dataType, formats).alias(column)


def prep_sap_order_header_data(
    df: DataFrame,
    as_of: dt.date | str | Column | None = None,
    date_formats: list[str] | None = None,
) -> DataFrame:
    """Order header (AFKO): 18 columns with 10 dates, plus month-start dates.

    ``start_date`` is the first of the month of GSTRP and ``finish_date`` that of GLTRP;
    a missing date falls back to ``as_of`` (default: the query's current date).
    Unparseable date text becomes null rather than failing the query.
    """
    require_dataframe(df, _ORDER_GUARD)
    columns = [
        "SOURCE_SYSTEM_ERP",
        "MANDT",
        "AUFNR",
        *[_date(df, c, date_formats) for c in ORDER_HEADER_DATES],
        "DISPO",
        "FEVOR",
        "PLGRP",
        "FHORI",
        "AUFPL",
    ]
    return df.select(*columns).withColumns(
        {"start_date": month_start("GSTRP", as_of), "finish_date": month_start("GLTRP", as_of)}
    )


def prep_sap_order_item(df: DataFrame, date_formats: list[str] | None = None) -> DataFrame:
    """Order item (AFPO): 8 columns, LTRMI as date."""
    require_dataframe(df, _ORDER_GUARD)
    return df.select("AUFNR", "POSNR", "DWERK", "MATNR", "MEINS", "KDAUF", "KDPOS", _date(df, "LTRMI", date_formats))


def prep_sap_order_master_data(df: DataFrame, date_formats: list[str] | None = None) -> DataFrame:
    """Order master (AUFK): 7 columns, ERDAT and ZZGLTRP_ORIG as dates."""
    require_dataframe(df, _ORDER_GUARD)
    return df.select(
        "AUFNR",
        "OBJNR",
        _date(df, "ERDAT", date_formats),
        "ERNAM",
        "AUART",
        _date(df, "ZZGLTRP_ORIG", date_formats),
        "ZZPRO_TEXT",
    )


def prep_sap_general_material_data(df: DataFrame, col_global_material: str) -> DataFrame:
    """General material for orders (MARA): valid and undeleted, 4 columns."""
    require_dataframe(df, _ORDER_GUARD)
    require_str(col_global_material, "Invalid input column name")
    return df.filter(old_material_number_valid() & not_deleted_or_blank()).select(
        "MATNR",
        F.col(col_global_material).alias("GLOBAL_MATERIAL_NUMBER"),
        "NTGEW",
        "MTART",
    )

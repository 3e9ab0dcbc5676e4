"""Named queries over the fixture sources: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole fixture
tables of that scale factor. Queries that exercise a reader or writer first write a
fixture table to a fresh folder under the session's shared work folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from erpweave import contracts as C
from erpweave.operators import (
    derive_intra_and_inter_primary_key,
    derive_order_keys,
    distinct_rows,
    duplicate_keys,
    integration_local_material,
    integration_process_order,
    key_violations,
    latest_per_key,
    left_join,
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
    prep_valuation_data,
    preview,
    profile_data,
    union_systems,
)
from erpweave.operators.dedup import asc_nulls_last
from erpweave.operators.derive import FOREIGN, MATERIAL_GRAIN, material_dedup_order
from erpweave.operators.prep import valuation_order
from erpweave.plans.colocated import process_stored_orders, store_order_tables
from erpweave.plans.harmonize import harmonize_data, read_published, rejected_values
from erpweave.plans.pipelines import (
    local_material_integrated,
    process_local_material,
    process_order_integrated,
    process_process_order,
    rename_local_material,
    rename_process_order,
)
from erpweave.functions import not_deleted, not_deleted_or_blank, old_material_number_valid
from erpweave.session import scratch_path
from erpweave.sources.audit import AuditedSources, SourceAudit
from erpweave.sources.damaged import read_csv_lanes
from erpweave.sources.fixtures import SYSTEMS, OverlappingErpSources, TpchErpSources
from erpweave.sources.readers import read_csv_file, read_csv_typed
from erpweave.sources.registry import SourceRegistry, SystemLocation
from erpweave.sources.sinks import read_written, write_table

# Fixed reference day for every query, so current_date never reaches a result.
AS_OF = "2024-06-15"

Query = Callable[[SparkSession, str], DataFrame]


def _src(sf_dir: str) -> TpchErpSources:
    return TpchErpSources(sf_dir)


def _view(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return _src(sf_dir).view(spark, table)


# --- prepared tables (whole views) -----------------------------------------------------


def _mara_p(spark, sf_dir):
    return prep_general_material_data(_view(spark, sf_dir, "MARA"), "ZZMDGM")


def _mbew_p(spark, sf_dir):
    return prep_material_valuation(_view(spark, sf_dir, "MBEW"))


def _marc_p(spark, sf_dir):
    return prep_plant_data_for_material(_view(spark, sf_dir, "MARC"), True, True)


def _t001w_p(spark, sf_dir):
    return prep_plant_and_branches(_view(spark, sf_dir, "T001W"))


def _t001k_p(spark, sf_dir):
    return prep_valuation_data(_view(spark, sf_dir, "T001K"))


def _t001_p(spark, sf_dir):
    return prep_company_codes(_view(spark, sf_dir, "T001"))


def _afko_p(spark, sf_dir):
    return prep_sap_order_header_data(_view(spark, sf_dir, "AFKO"), AS_OF)


def _afpo_p(spark, sf_dir):
    return prep_sap_order_item(_view(spark, sf_dir, "AFPO"))


def _aufk_p(spark, sf_dir):
    return prep_sap_order_master_data(_view(spark, sf_dir, "AUFK"))


def _mara_o(spark, sf_dir):
    return prep_sap_general_material_data(_view(spark, sf_dir, "MARA"), "ZZMDGM")


def _lm_joined(spark, sf_dir):
    return local_material_integrated(spark, _src(sf_dir))


def _po_joined(spark, sf_dir):
    return process_order_integrated(spark, _src(sf_dir), as_of=AS_OF)


def _po_post(spark, sf_dir):
    return post_prep_process_order(_po_joined(spark, sf_dir))


def _local_material(spark, sf_dir, **kw):
    return process_local_material(spark, _src(sf_dir), **kw)


def _process_order(spark, sf_dir, **kw):
    return process_process_order(spark, _src(sf_dir), as_of=AS_OF, **kw)


# --- S: scans and sinks ----------------------------------------------------------------


def scan_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "t001w-csv")
    write_table(_view(spark, sf_dir, "T001W"), path, fmt="csv")
    return read_csv_file(spark, path, infer_schema=True)


def scan_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "marc-csv")
    write_table(_view(spark, sf_dir, "MARC"), path, fmt="csv")
    return read_csv_typed(spark, path, C.SOURCE_SCHEMAS["MARC"])


def scan_csv_damaged(spark, sf_dir):
    """Plant rows as CSV text, some with a cell too many or too few, some with a quoted line break:
    both lanes of the reader, as one table."""
    names = C.SOURCE_SCHEMAS["MARC"].fieldNames()
    marc = _view(spark, sf_dir, "MARC").select(*names)
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in names])
    kind = F.col("MATNR").cast("int") % 10
    lines = (
        F.when(kind == 3, F.array(F.concat(line, F.lit(",note,surplus"))))
        .when(kind == 7, F.array(line))
        .when(kind == 5, F.array(F.concat(line, F.lit(',"a note')), F.lit('of two lines"')))
        .otherwise(F.array(F.concat(line, F.lit(",note"))))
    )
    path = scratch_path(spark, "marc-damaged")
    # One text column whose name is the header line; nothing in it is quoted or separated.
    text = marc.select(F.explode(lines).alias(",".join([*names, "NOTE"])))
    text.write.options(header=True, sep="\u0001", quote="").csv(path)
    found = read_csv_lanes(spark, path, C.SOURCE_SCHEMAS["MARC"])
    rows = found.rows.select(F.lit("rows").alias("lane"), *names, F.lit(None).cast("string").alias("record"))
    return rows.unionByName(found.rejected.select(F.col("reason").alias("lane"), "record"), allowMissingColumns=True)


def scan_registry(spark, sf_dir):
    """Local material run from CSV extracts laid out per system (typed, by name)."""
    root = scratch_path(spark, "extracts")
    src = _src(sf_dir)
    locations = {}
    for i, system in enumerate(SYSTEMS, start=1):
        loc = SystemLocation(root=f"{root}/system_{i}", prefix=f"P{i}", fmt="csv")
        locations[system] = loc
        for table in ("MARA", "MBEW", "MARC", "T001K", "T001W", "T001"):
            write_table(src.load(spark, system, table), f"{loc.root}/{loc.prefix}_{table}.csv", fmt="csv", compression="gzip")
    return process_local_material(spark, SourceRegistry(locations))


def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "local-material-csv")
    write_table(rename_local_material(_local_material(spark, sf_dir)), path, fmt="csv", compression="gzip")
    return read_csv_typed(spark, path, C.renamed(C.LOCAL_MATERIAL_CONTRACT, C.LOCAL_MATERIAL_RENAME))


def sink_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "process-order-parquet")
    write_table(rename_process_order(_process_order(spark, sf_dir)), path, partition_by=["source_system_erp"])
    return read_written(spark, path, C.renamed(C.PROCESS_ORDER_CONTRACT, C.PROCESS_ORDER_RENAME))


def profile_columns(spark, sf_dir):
    """Profile of the valuations; numbers shown with 4 and 6 decimals to compare across engines."""
    mbew = _view(spark, sf_dir, "MBEW")
    shown = F.col("column_name").isin(*[f.name for f in mbew.schema.fields if isinstance(f.dataType, NumericType)])
    fixed = {
        c: F.when(shown, F.col(c).cast("double").cast("decimal(38,6)").cast("string")).otherwise(F.col(c))
        for c in ("min_value", "max_value")
    }
    return profile_data(mbew, decimals=4).withColumns(fixed)


def run_summary(spark, sf_dir):
    def count(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")

    return count("local_material", _local_material(spark, sf_dir)).unionByName(
        count("process_order", _process_order(spark, sf_dir))
    )


# --- F: filters ------------------------------------------------------------------------


def filter_valid_old_number(spark, sf_dir):
    return _view(spark, sf_dir, "MARA").filter(old_material_number_valid())


def filter_not_deleted_blank(spark, sf_dir):
    return _view(spark, sf_dir, "MARA").filter(not_deleted_or_blank())


def filter_not_deleted_null(spark, sf_dir):
    return _view(spark, sf_dir, "MARC").filter(not_deleted())


def latest_per_key_query(spark, sf_dir):
    mbew = _view(spark, sf_dir, "MBEW")
    order = valuation_order(mbew.columns) + asc_nulls_last(["LVORM", "BWTAR"])
    return latest_per_key(mbew, ["MATNR", "BWKEY"], order)


def duplicate_keys_query(spark, sf_dir):
    return duplicate_keys(_view(spark, sf_dir, "AFPO"), ["AUFNR", "POSNR"])


def prep_material_nochecks(spark, sf_dir):
    return prep_general_material_data(_view(spark, sf_dir, "MARA"), "ZZMDGM", False, False)


# --- P: projections, casts, renames ----------------------------------------------------


def prep_plant_material_extra(spark, sf_dir):
    return prep_plant_data_for_material(_view(spark, sf_dir, "MARC"), False, True, ["LVORM"])


def cast_dates(spark, sf_dir):
    """Header dates arriving as text: ISO for nine columns, compact yyyyMMdd for FTRMS."""
    afko = _view(spark, sf_dir, "AFKO")
    as_text = {c: F.col(c).cast("string") for c in C.ORDER_HEADER_DATES}
    as_text["FTRMS"] = F.date_format(F.col("FTRMS"), "yyyyMMdd")
    return prep_sap_order_header_data(afko.withColumns(as_text), AS_OF, date_formats=["yyyyMMdd"])


def derive_order_missing_date(spark, sf_dir):
    post = post_prep_process_order(_po_joined(spark, sf_dir).drop("ZZGLTRP_ORIG"))
    return post.select(
        "AUFNR", "POSNR", "DWERK", "ZZGLTRP_ORIG", "on_time_flag", "actual_on_time_deviation", "late_delivery_bucket"
    )


def rename_material(spark, sf_dir):
    return rename_local_material(post_prep_local_material(_lm_joined(spark, sf_dir)))


def rename_order(spark, sf_dir):
    return rename_process_order(_po_post(spark, sf_dir))


# --- J: joins --------------------------------------------------------------------------


def join_plant_material(spark, sf_dir):
    return left_join(_marc_p(spark, sf_dir), _mara_p(spark, sf_dir), "MATNR")


def join_branch(spark, sf_dir):
    return left_join(join_plant_material(spark, sf_dir), _t001w_p(spark, sf_dir), ["MANDT", "WERKS"], spread_null_keys=True)


def join_valuation(spark, sf_dir):
    return left_join(join_branch(spark, sf_dir), _mbew_p(spark, sf_dir), ["MANDT", "MATNR", "BWKEY"], spread_null_keys=True)


def join_company_area(spark, sf_dir):
    return left_join(join_valuation(spark, sf_dir), _t001k_p(spark, sf_dir), ["MANDT", "BWKEY"], spread_null_keys=True)


def integrate_material(spark, sf_dir):
    return integration_local_material(
        _mara_p(spark, sf_dir),
        _mbew_p(spark, sf_dir),
        _marc_p(spark, sf_dir),
        _t001k_p(spark, sf_dir),
        _t001w_p(spark, sf_dir),
        _t001_p(spark, sf_dir),
    )


def join_header_item(spark, sf_dir):
    return left_join(_afko_p(spark, sf_dir), _afpo_p(spark, sf_dir), "AUFNR", split_right_skew=True)


def join_order_master(spark, sf_dir):
    """Headers with order masters, then items: the order and options of the integration."""
    masters = left_join(_afko_p(spark, sf_dir), _aufk_p(spark, sf_dir), "AUFNR")
    return left_join(masters, _afpo_p(spark, sf_dir), "AUFNR", split_right_skew=True)


def integrate_order(spark, sf_dir):
    return integration_process_order(
        _afko_p(spark, sf_dir), _afpo_p(spark, sf_dir), _aufk_p(spark, sf_dir), _mara_o(spark, sf_dir)
    )


def integrate_order_changes(spark, sf_dir):
    return process_order_integrated(spark, _src(sf_dir), as_of=AS_OF, with_changes=True)


# --- A, W, L, U: aggregation, windows, preview, unions ---------------------------------


def key_violations_order(spark, sf_dir):
    return key_violations(_process_order(spark, sf_dir), C.PRIMARY_KEYS)


def key_violations_material(spark, sf_dir):
    return key_violations(_local_material(spark, sf_dir), C.PRIMARY_KEYS)


def distinct_rows_query(spark, sf_dir):
    return distinct_rows(_view(spark, sf_dir, "MARC"))


def dedup_material(spark, sf_dir):
    joined = _lm_joined(spark, sf_dir)
    return latest_per_key(joined, MATERIAL_GRAIN, material_dedup_order(joined.columns)).drop(FOREIGN)


def dedup_material_counts(spark, sf_dir):
    return post_prep_local_material(_lm_joined(spark, sf_dir), count_duplicates=True)


def preview_rows(spark, sf_dir):
    return preview(_local_material(spark, sf_dir), 5, ["primary_key_inter"])


def union_material(spark, sf_dir):
    src = _src(sf_dir)
    return union_systems(
        [prep_general_material_data(src.load(spark, s, "MARA"), "ZZMDGM") for s in src.systems],
        C.PREPARED_SCHEMAS["MARA"],
    )


def union_order(spark, sf_dir):
    src = _src(sf_dir)
    return union_systems(
        [prep_sap_order_header_data(src.load(spark, s, "AFKO"), AS_OF) for s in src.systems],
        C.PREPARED_SCHEMAS["AFKO"],
    )


def union_conformed(spark, sf_dir):
    """Two extracts typed differently (material number as number in one) conformed first."""
    src = _src(sf_dir)
    first, second = (src.load(spark, s, "MARA") for s in src.systems)
    second = second.withColumn("MATNR", F.col("MATNR").cast("long"))
    return union_systems([first, second], C.SOURCE_SCHEMAS["MARA"])


# --- D, M: derivations and masking -----------------------------------------------------


def derive_material_keys(spark, sf_dir):
    return derive_intra_and_inter_primary_key(_marc_p(spark, sf_dir))


def derive_material(spark, sf_dir):
    return post_prep_local_material(_lm_joined(spark, sf_dir)).select(
        "SOURCE_SYSTEM_ERP", "MATNR", "WERKS", "NAME1", "GLOBAL_MATERIAL_NUMBER", "mtl_plant_emd", "global_mtl_id"
    )


def post_material(spark, sf_dir):
    return post_prep_local_material(_lm_joined(spark, sf_dir))


def derive_order_keys_query(spark, sf_dir):
    return derive_order_keys(_po_joined(spark, sf_dir)).select(
        "SOURCE_SYSTEM_ERP", "AUFNR", "POSNR", "DWERK", "primary_key_intra", "primary_key_inter"
    )


def _po_columns(*columns: str) -> Query:
    def query(spark, sf_dir):
        return _po_post(spark, sf_dir).select("AUFNR", "POSNR", "DWERK", *columns)

    return query


def post_order(spark, sf_dir):
    return _po_post(spark, sf_dir)


def month_start_dates(spark, sf_dir):
    return _afko_p(spark, sf_dir).select("AUFNR", "GSTRP", "GLTRP", "start_date", "finish_date")


def mask_columns(spark, sf_dir):
    return mask_sensitive_columns(_view(spark, sf_dir, "AUFK"), ["OBJNR", "ERNAM"])


def derive_order(spark, sf_dir):
    """Order derivations on rows whose dates arrive as text: P5 re-casts them first."""
    joined = _po_joined(spark, sf_dir)
    as_text = {c: F.col(c).cast("string") for c in ("ZZGLTRP_ORIG", "LTRMI", "GSTRI")}
    return post_prep_process_order(joined.withColumns(as_text))


# --- C: contracts ----------------------------------------------------------------------


class _DriftedSources:
    """The fixture with the second system delivering some columns in other types, as an
    extract read with inferred types would (numbers for ids and units, text for dates)."""

    def __init__(self, sf_dir: str) -> None:
        self.inner = _src(sf_dir)
        self.systems = self.inner.systems

    def load(self, spark: SparkSession, system: str, table: str) -> DataFrame:
        df = self.inner.load(spark, system, table)
        if system != self.systems[-1]:
            return df
        drift = {
            "MBEW": {"PEINH": "int", "LAEPR": "string"},
            "MARA": {"NTGEW": "decimal(12,2)"},
            "AFKO": {c: "string" for c in C.ORDER_HEADER_DATES},
            "AFPO": {"POSNR": "int", "LTRMI": "string"},
            "AUFK": {"ERDAT": "string", "ZZGLTRP_ORIG": "string"},
        }.get(table, {})
        return df.withColumns({c: F.col(c).cast(t) for c, t in drift.items()})


def material_contract(spark, sf_dir):
    """Local material from type-drifted extracts: conformed back to the 19-column contract."""
    return process_local_material(spark, _DriftedSources(sf_dir))


def order_contract(spark, sf_dir):
    """Process order from type-drifted extracts: conformed back to the 44-column contract."""
    return process_process_order(spark, _DriftedSources(sf_dir), as_of=AS_OF)


# --- Z: pipelines ----------------------------------------------------------------------


def local_material(spark, sf_dir):
    return _local_material(spark, sf_dir)


def process_order(spark, sf_dir):
    return _process_order(spark, sf_dir)


def material_masked(spark, sf_dir):
    return _local_material(spark, sf_dir, mask_derived=True)


def order_masked(spark, sf_dir):
    return _process_order(spark, sf_dir, mask_derived=True)


def local_material_final(spark, sf_dir):
    return rename_local_material(_local_material(spark, sf_dir))


def process_order_final(spark, sf_dir):
    return rename_process_order(_process_order(spark, sf_dir))


# --- systems that share a client and numbers -------------------------------------------


def overlap_valuation(spark, sf_dir):
    """Latest valuation per system where one system's LAEPR is text."""
    src = OverlappingErpSources(sf_dir)
    return union_systems([prep_material_valuation(src.load(spark, s, "MBEW")) for s in src.systems])


def overlap_valuation_area(spark, sf_dir):
    """Valuation areas that the extracts hold twice."""
    src = OverlappingErpSources(sf_dir)
    return union_systems([prep_valuation_data(src.load(spark, s, "T001K")) for s in src.systems])


def overlap_joined(spark, sf_dir):
    return local_material_integrated(spark, OverlappingErpSources(sf_dir)).drop(FOREIGN)


def overlap_local_material(spark, sf_dir):
    """Local material where every join fans out over both systems; own rows win."""
    return process_local_material(spark, OverlappingErpSources(sf_dir))


def overlap_counts(spark, sf_dir):
    return process_local_material(spark, OverlappingErpSources(sf_dir), count_duplicates=True)


def local_material_isolated(spark, sf_dir):
    return process_local_material(spark, OverlappingErpSources(sf_dir), isolate_systems=True)


def overlap_order_changes(spark, sf_dir):
    """Orders with several changes each, and orders that both systems number alike."""
    return process_order_integrated(spark, OverlappingErpSources(sf_dir), as_of=AS_OF, with_changes=True)


def overlap_order_hot(spark, sf_dir):
    """The same joins with every key of the split joins salted: a threshold of one row."""
    src = OverlappingErpSources(sf_dir)
    afko = union_systems([prep_sap_order_header_data(src.load(spark, s, "AFKO"), AS_OF) for s in src.systems])
    afpo = union_systems([prep_sap_order_item(src.load(spark, s, "AFPO")) for s in src.systems])
    return left_join(afko, afpo, "AUFNR", split_right_skew=True, hot_key_rows=2)


def process_order_isolated(spark, sf_dir):
    return process_process_order(spark, OverlappingErpSources(sf_dir), as_of=AS_OF, isolate_systems=True)


def order_deviation_late_positive(spark, sf_dir):
    """Deviation with lateness positive, and the buckets that follow from it."""
    post = post_prep_process_order(_po_joined(spark, sf_dir), sign="actual_minus_planned")
    return post.select("AUFNR", "POSNR", "DWERK", "actual_on_time_deviation", "late_delivery_bucket")


# --- published output and lost values ---------------------------------------------------


class _NumberedSources(TpchErpSources):
    """The fixture with system ids that read as numbers: 001 and 010."""

    def load(self, spark: SparkSession, system: str, table: str) -> DataFrame:
        df = super().load(spark, system, table)
        if "SOURCE_SYSTEM_ERP" not in df.columns:
            return df
        return df.withColumn("SOURCE_SYSTEM_ERP", F.lit("001" if system == "SYS1" else "010"))


def harmonize_published(spark, sf_dir):
    """The run's own output, read back: local material of systems 001 and 010."""
    root = scratch_path(spark, "published")
    harmonize_data(spark, _NumberedSources(sf_dir), root, on_key_violation="report", order_options={"as_of": AS_OF})
    return read_published(spark, root, "local_material")


class _UntidySources(TpchErpSources):
    """The fixture with prices and dates as text, some in forms that no type accepts."""

    def load(self, spark: SparkSession, system: str, table: str) -> DataFrame:
        df = super().load(spark, system, table)
        if table == "MBEW":
            text = "CASE WHEN STPRS % 5 = 0 THEN concat(CAST(CAST(STPRS AS INT) AS STRING), ',50-') ELSE CAST(STPRS AS STRING) END"
            return df.withColumn("STPRS", F.expr(text))
        if table == "AFPO":
            text = "CASE WHEN POSNR = '2' THEN date_format(LTRMI, 'yyyyMMdd') WHEN POSNR = '3' THEN 'soon' ELSE CAST(LTRMI AS STRING) END"
            return df.withColumn("LTRMI", F.expr(text))
        return df


def rejects_registry(spark, sf_dir):
    """Losses of the valuation extracts (CSV, prices in forms that no type takes), counted on the
    plan that builds local material from them."""
    root = scratch_path(spark, "untidy-extracts")
    src, locations = _UntidySources(sf_dir), {}
    for i, system in enumerate(SYSTEMS, start=1):
        loc = locations[system] = SystemLocation(root=f"{root}/system_{i}", prefix=f"P{i}", fmt="csv")
        for table in ("MARA", "MBEW", "MARC", "T001K", "T001W", "T001"):
            write_table(src.load(spark, system, table), f"{loc.root}/{loc.prefix}_{table}.csv", fmt="csv")
    audit = SourceAudit()
    sources = AuditedSources(SourceRegistry(locations, damaged="drop"), audit)
    process_local_material(spark, sources).write.format("noop").mode("overwrite").save()
    return audit.report(spark).filter("table_name = 'MBEW'")


def harmonize_published_order(spark, sf_dir):
    """The order half of a versioned run, read back through its commit."""
    root = scratch_path(spark, "versions")
    harmonize_data(
        spark, _src(sf_dir), root, on_key_violation="report", order_options={"as_of": AS_OF}, versioned=True
    )
    return read_published(spark, root, "process_order")


def process_order_stored(spark, sf_dir):
    """A second run of process order: its facts come from tables bucketed by order number."""
    prefix = f"orders_{uuid.uuid4().hex}"
    store_order_tables(spark, _src(sf_dir), prefix, location=scratch_path(spark, "orders"), as_of=AS_OF)
    return process_stored_orders(spark, prefix)


def key_violations_stored(spark, sf_dir):
    """The two-phase key check over a stored table."""
    path = scratch_path(spark, "keys")
    _process_order(spark, sf_dir).select(*C.PRIMARY_KEYS).write.parquet(path)
    return key_violations(spark.read.parquet(path), C.PRIMARY_KEYS, reread=True)


class _NoOddPlants(TpchErpSources):
    """The fixture without the plant rows of every second material: a run with other results."""

    def load(self, spark: SparkSession, system: str, table: str) -> DataFrame:
        df = super().load(spark, system, table)
        return df.filter("crc32(MATNR) % 2 = 0") if table == "MARC" else df


def harmonize_raise(spark, sf_dir):
    """A run in ``raise`` mode that meets duplicated order keys: readers still see the run before."""
    root = scratch_path(spark, "raising")
    options = {"order_options": {"as_of": AS_OF}, "versioned": True}
    harmonize_data(spark, _src(sf_dir), root, on_key_violation="report", **options)
    try:
        harmonize_data(spark, _NoOddPlants(sf_dir), root, on_key_violation="raise", **options)
    except ValueError:
        return read_published(spark, root, "local_material")
    msg = "the fixture's order keys are not unique, so nothing may be published"
    raise AssertionError(msg)


def conform_rejects_query(spark, sf_dir):
    """Values that typing the extracts turns into null, per system and column."""
    return rejected_values(spark, _UntidySources(sf_dir), ["MBEW", "AFPO"], date_formats=["yyyyMMdd"])


QUERIES: dict[str, Query] = {
    # S: scans, sinks, profile
    "scan_csv_inferred": scan_csv_inferred,
    "scan_csv_typed": scan_csv_typed,
    "scan_csv_damaged": scan_csv_damaged,
    "scan_registry": scan_registry,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "profile_columns": profile_columns,
    "run_summary": run_summary,
    # F: filters
    "filter_valid_old_number": filter_valid_old_number,
    "filter_not_deleted_blank": filter_not_deleted_blank,
    "prep_material_order": _mara_o,
    "filter_not_deleted_null": filter_not_deleted_null,
    "latest_per_key": latest_per_key_query,
    "duplicate_keys": duplicate_keys_query,
    "prep_material_nochecks": prep_material_nochecks,
    # P and T: projections and table preparation
    "prep_material": _mara_p,
    "prep_valuation_latest": _mbew_p,
    "prep_plant_material": _marc_p,
    "prep_plant_material_extra": prep_plant_material_extra,
    "prep_plant": _t001w_p,
    "prep_valuation_area": _t001k_p,
    "prep_company": _t001_p,
    "prep_order_header": _afko_p,
    "prep_order_item": _afpo_p,
    "prep_order_master": _aufk_p,
    "cast_dates": cast_dates,
    "derive_order_missing_date": derive_order_missing_date,
    "rename_material": rename_material,
    "rename_order": rename_order,
    # J: joins
    "join_plant_material": join_plant_material,
    "join_branch": join_branch,
    "join_valuation": join_valuation,
    "join_company_area": join_company_area,
    "integrate_material": integrate_material,
    "join_header_item": join_header_item,
    "join_order_master": join_order_master,
    "integrate_order": integrate_order,
    "integrate_order_changes": integrate_order_changes,
    # A, W, L, U
    "key_violations": key_violations_order,
    "key_violations_material": key_violations_material,
    "distinct_rows": distinct_rows_query,
    "dedup_material": dedup_material,
    "dedup_material_counts": dedup_material_counts,
    "preview_rows": preview_rows,
    "union_material": union_material,
    "union_order": union_order,
    "union_conformed": union_conformed,
    # D, M
    "derive_material_keys": derive_material_keys,
    "derive_material": derive_material,
    "post_material": post_material,
    "derive_order_keys": derive_order_keys_query,
    "on_time_flag": _po_columns("ZZGLTRP_ORIG", "LTRMI", "on_time_flag"),
    "on_time_deviation": _po_columns("ZZGLTRP_ORIG", "LTRMI", "actual_on_time_deviation"),
    "late_bucket": _po_columns("actual_on_time_deviation", "late_delivery_bucket"),
    "mto_mts": _po_columns("KDAUF", "mto_vs_mts_flag"),
    "order_timestamps": _po_columns("LTRMI", "GSTRI", "order_finish_timestamp", "order_start_timestamp"),
    "post_order": post_order,
    "derive_order": derive_order,
    "month_start_dates": month_start_dates,
    "mask_columns": mask_columns,
    "material_masked": material_masked,
    "order_masked": order_masked,
    # C: contracts
    "material_contract": material_contract,
    "order_contract": order_contract,
    # Z: pipelines
    "local_material": local_material,
    "process_order": process_order,
    "local_material_final": local_material_final,
    "process_order_final": process_order_final,
    # Shared client and numbers, published output, lost values
    "overlap_valuation": overlap_valuation,
    "overlap_valuation_area": overlap_valuation_area,
    "overlap_joined": overlap_joined,
    "overlap_local_material": overlap_local_material,
    "overlap_counts": overlap_counts,
    "local_material_isolated": local_material_isolated,
    "overlap_order_changes": overlap_order_changes,
    "overlap_order_hot": overlap_order_hot,
    "process_order_isolated": process_order_isolated,
    "order_deviation_late_positive": order_deviation_late_positive,
    "harmonize_published": harmonize_published,
    "harmonize_published_order": harmonize_published_order,
    "harmonize_raise": harmonize_raise,
    "process_order_stored": process_order_stored,
    "key_violations_stored": key_violations_stored,
    "conform_rejects": conform_rejects_query,
    "rejects_registry": rejects_registry,
}

"""Order tables stored by order number, so that re-runs join them where they lie.

Headers, masters and items are prepared once and written as tables bucketed (and sorted) by the
join key. A later run of process order reads matching buckets side by side: joins J6 and J7
need no exchange and no hash of the facts, however often they run.

A bucket is one task, so what would make one bucket large is kept out of it when the tables are
written: items of an order with more than ``hot_key_rows`` items go to a table of their own
(not bucketed), and the orders concerned (at most ``MAX_HOT_KEYS``, as for salted joins) to a
small table. Their headers, and headers of a null number, take the salted join instead; the
union of both ways is exactly the left join. Hotter keys win where there are more hot keys.

The tables are registered in the session's catalog, for later sessions where that is a
shared metastore.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erpweave.operators.integrate import HOT_KEY_ROWS, hot_keys, left_join, order_rows_with_materials
from erpweave.plans.pipelines import SYSTEM_TAG, finished_process_order, process_order_tables
from erpweave.sources.registry import Sources

#: Suffixes of the stored tables.
HEADERS, MASTERS, ITEMS = "afko", "aufk", "afpo"
HOT_ITEMS, HOT_ORDERS, MATERIALS, CHANGES = "afpo_hot", "hot_orders", "mara", "cdpos"


def _keys(isolate_systems: bool) -> list[str]:
    return [SYSTEM_TAG, "AUFNR"] if isolate_systems else ["AUFNR"]


def _save(df: DataFrame, name: str, location: str | None, buckets: int = 0, keys: list[str] | None = None) -> None:
    if buckets:
        # One file per bucket and not one per task and bucket.
        df = df.repartition(buckets, *keys)
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{name}")
    writer.saveAsTable(name)


def store_order_tables(
    spark: SparkSession,
    sources: Sources,
    prefix: str,
    buckets: int | None = None,
    hot_key_rows: int = HOT_KEY_ROWS,
    isolate_systems: bool = False,
    location: str | None = None,
    **options,
) -> None:
    """Prepare the order tables of ``sources`` and store them as ``{prefix}_*``.

    Their files lie in the warehouse, or under ``location`` (a folder that all executors share).

    ``buckets`` should be a multiple of the cluster's cores that gives buckets of 100 to 200 MB
    (default: the session's shuffle partitions). ``options`` as for ``process_order_tables``.
    """
    tables = process_order_tables(spark, sources, isolate_systems=isolate_systems, **options)
    keys = _keys(isolate_systems)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    _save(hot_keys(tables["AFPO"], keys, hot_key_rows).select(*keys), f"{prefix}_{HOT_ORDERS}", location)
    hot = F.broadcast(spark.table(f"{prefix}_{HOT_ORDERS}"))  # at most MAX_HOT_KEYS rows
    _save(tables["AFPO"].join(hot, keys, "left_semi"), f"{prefix}_{HOT_ITEMS}", location)
    # Items of no order number match no header: they are in neither table.
    _save(tables["AFPO"].dropna(subset=keys).join(hot, keys, "left_anti"), f"{prefix}_{ITEMS}", location, n, keys)
    _save(tables["AUFK"].dropna(subset=keys), f"{prefix}_{MASTERS}", location, n, keys)
    # Headers of no order number are many rows of one bucket: they stay outside.
    whole = ~F.isnull("AUFNR")
    _save(tables["AFKO"].filter(whole), f"{prefix}_{HEADERS}", location, n, keys)
    _save(tables["AFKO"].filter(~whole), f"{prefix}_{HEADERS}_unnumbered", location)
    _save(tables["MARA_ORDER"], f"{prefix}_{MATERIALS}", location)
    if tables["CDPOS"] is not None:
        _save(tables["CDPOS"], f"{prefix}_{CHANGES}", location)


def stored_order_rows(spark: SparkSession, prefix: str, isolate_systems: bool = False) -> DataFrame:
    """AFKO ⟕ AUFK ⟕ AFPO of the stored tables; no exchange but for hot or unnumbered orders."""
    keys = _keys(isolate_systems)

    def table(suffix: str) -> DataFrame:
        return spark.table(f"{prefix}_{suffix}")

    with_master = left_join(table(HEADERS), table(MASTERS), keys)
    unnumbered = left_join(table(f"{HEADERS}_unnumbered"), table(MASTERS).limit(0), keys)
    if table(HOT_ORDERS).isEmpty():
        rows = left_join(with_master, table(ITEMS), keys)
    else:
        hot = F.broadcast(table(HOT_ORDERS))
        cold = left_join(with_master.join(hot, keys, "left_anti"), table(ITEMS), keys)
        rows = cold.unionByName(
            left_join(with_master.join(hot, keys, "left_semi"), table(HOT_ITEMS), keys, split_right_skew=True)
        )
    return rows.unionByName(left_join(unnumbered, table(ITEMS).limit(0), keys))


def process_stored_orders(
    spark: SparkSession,
    prefix: str,
    with_changes: bool = False,
    isolate_systems: bool = False,
    date_formats: list[str] | None = None,
    **options,
) -> DataFrame:
    """Process order from the stored tables: the rows of ``process_process_order``.

    ``options``: mask, mask_derived, mask_salt, mask_key, sign.
    """

    def table(suffix: str) -> DataFrame:
        return spark.table(f"{prefix}_{suffix}")

    integrated = order_rows_with_materials(
        stored_order_rows(spark, prefix, isolate_systems),
        table(HEADERS),
        table(ITEMS),
        table(MASTERS),
        table(MATERIALS),
        table(CHANGES) if with_changes else None,
        [SYSTEM_TAG] if isolate_systems else (),
    )
    return finished_process_order(integrated.drop(SYSTEM_TAG), date_formats, **options)


def drop_order_tables(spark: SparkSession, prefix: str) -> None:
    """Remove the stored tables of ``prefix``."""
    for suffix in (HEADERS, f"{HEADERS}_unnumbered", MASTERS, ITEMS, HOT_ITEMS, HOT_ORDERS, MATERIALS, CHANGES):
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{suffix}")

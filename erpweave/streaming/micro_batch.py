"""Incremental runs with Structured Streaming.

The row-wise operators (preparation filters and projections, keys, flags, buckets,
timestamps, masking, renames) hold no state, so they apply unchanged to a streaming
DataFrame. ``stream_process_orders`` runs them over a stream of new order-header extracts
joined to the (static) prepared items, order master and material tables, and appends the
result with the exactly-once parquet file sink.

A header whose items are not yet in that static table is written with null item columns.
``run_order_batches`` takes headers and items as streams instead: it keeps what it received
and joins an order again whenever one of its parts arrives. ``run_micro_batches`` applies any
batch transform to each micro-batch with ``foreachBatch`` and overwrites a folder named after
the batch id, so a retried batch replaces its own output instead of appending it twice; with
``keys`` it also drops rows whose key an earlier batch has written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from erpweave import contracts as C
from erpweave.operators import (
    integration_process_order,
    mask_sensitive_columns,
    post_prep_process_order,
    prep_sap_order_header_data,
    prep_sap_order_item,
)
from erpweave.operators.dedup import asc_nulls_last, latest_per_key
from erpweave.session import scratch_path
from erpweave.sources.sinks import write_table


def stream_process_orders(
    spark: SparkSession,
    header_dir: str,
    header_schema: StructType,
    items: DataFrame,
    master: DataFrame,
    material: DataFrame,
    output_path: str,
    checkpoint_location: str | None = None,
    as_of: dt.date | str | Column | None = None,
    mask: bool = True,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Process order rows for every new header file in ``header_dir`` (parquet).

    ``items``, ``master`` and ``material`` are the prepared AFPO, AUFK and MARA tables
    (static). Headers are the preserved side of the joins, so every join is stream-static.
    """
    reader = spark.readStream.schema(header_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    headers = prep_sap_order_header_data(reader.parquet(header_dir), as_of)
    rows = post_prep_process_order(integration_process_order(headers, items, master, material))
    rows = rows.select(*C.names(C.PROCESS_ORDER_CONTRACT))
    if mask:
        rows = mask_sensitive_columns(rows, C.PROCESS_ORDER_MASKED)
    writer = (
        rows.writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_location or scratch_path(spark, "stream-checkpoint"))
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_micro_batches(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    output_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    keys: Sequence[str] = (),
) -> StreamingQuery:
    """Apply a batch transform to each micro-batch.

    Each batch is written to ``{output_path}/batch_id={id}`` with overwrite, which makes
    the sink idempotent when Spark re-runs a failed batch. A transform that de-duplicates or
    checks keys sees one batch only; with ``keys`` a row is written just for the first batch
    that holds its key (null is a key value), by an anti join with the earlier batches.
    """
    spark = stream.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch)
        if keys:
            rows = rows.dropDuplicates(list(keys))
            earlier = _earlier(spark, output_path, rows.schema, batch_id)
            same = [rows[k].eqNullSafe(earlier[k]) for k in keys]
            rows = rows.join(earlier, reduce(lambda a, b: a & b, same), "left_anti")
        write_table(rows, f"{output_path}/batch_id={batch_id}", partition_by=None)

    writer = stream.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_location or scratch_path(spark, "batch-checkpoint")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _earlier(spark: SparkSession, path: str, schema: StructType, before: int) -> DataFrame:
    """All rows of the batch folders with a smaller id (none yet: an empty frame)."""
    typed = StructType([*[StructField(f.name, f.dataType) for f in schema.fields], StructField("batch_id", LongType())])
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        return spark.createDataFrame([], typed)
    return spark.read.schema(typed).parquet(path).filter(F.col("batch_id") < before)


def _all_until(spark: SparkSession, path: str, schema: StructType, batch_id: int) -> DataFrame:
    return _earlier(spark, path, schema, batch_id + 1)


def _newest_delivery(rows: DataFrame, grain: Sequence[str]) -> DataFrame:
    """All rows of the newest batch of each key; of a null AUFNR the rows of all batches."""
    last = F.max("batch_id").over(Window.partitionBy(*grain))
    return rows.withColumn("__last", last).filter(F.col("AUFNR").isNull() | (F.col("batch_id") == F.col("__last"))).drop("batch_id", "__last")


def run_order_batches(
    headers: DataFrame,
    items: DataFrame,
    master: DataFrame,
    material: DataFrame,
    output_path: str,
    state_path: str,
    checkpoint_location: str | None = None,
    as_of: dt.date | str | Column | None = None,
    mask: bool = True,
    available_now: bool = True,
) -> StreamingQuery:
    """Process order rows from a stream of AFKO headers and a stream of AFPO items.

    Items may come before or after their header. Both streams are kept under ``state_path``;
    each batch joins again all orders that it touches and writes them whole to
    ``{output_path}/batch_id={id}``, so ``current_orders`` (the latest version of every order)
    equals a batch run over everything received. A header or item that is delivered again
    replaces its older version: all rows of its newest batch stay. Rows of no order number have
    no older version and all stay. AFPO has no system; give the items a SOURCE_SYSTEM_ERP column
    where systems share order numbers. Items without it keep one row of each (order, position,
    plant). ``master`` and ``material`` are prepared static tables.
    """
    spark = headers.sparkSession
    header_schema, item_schema = headers.schema, items.schema
    header_grain, item_grain = ["SOURCE_SYSTEM_ERP", "AUFNR"], ["AUFNR", "POSNR", "DWERK"]
    if "SOURCE_SYSTEM_ERP" in items.columns:
        item_grain = ["SOURCE_SYSTEM_ERP", *item_grain]
    kind = "__erpweave_kind"
    both = headers.select(F.lit("h").alias(kind), F.struct(*headers.columns).alias("h"), F.lit(None).cast(item_schema).alias("i")).unionByName(
        items.select(F.lit("i").alias(kind), F.lit(None).cast(header_schema).alias("h"), F.struct(*items.columns).alias("i"))
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        for name in ("h", "i"):
            write_table(batch.filter(F.col(kind) == name).select(f"{name}.*"), f"{state_path}/{name}/batch_id={batch_id}")
        known = {n: _all_until(spark, f"{state_path}/{n}", s, batch_id) for n, s in (("h", header_schema), ("i", item_schema))}
        touched = [known[n].filter(F.col("batch_id") == batch_id).select("AUFNR") for n in ("h", "i")]
        orders = touched[0].union(touched[1]).distinct()
        newest = {}
        for n, grain in (("h", header_grain), ("i", item_grain)):
            rows = known[n].join(orders, known[n]["AUFNR"].eqNullSafe(orders["AUFNR"]), "left_semi")
            if "SOURCE_SYSTEM_ERP" in grain:
                newest[n] = _newest_delivery(rows, grain)
            else:
                rest = asc_nulls_last([c for c in rows.columns if c not in (*grain, "batch_id")])
                newest[n] = latest_per_key(rows, grain, [F.col("batch_id").desc(), *rest]).drop("batch_id")
        joined = integration_process_order(
            prep_sap_order_header_data(newest["h"], as_of), prep_sap_order_item(newest["i"]), master, material
        )
        rows = post_prep_process_order(joined).select(*C.names(C.PROCESS_ORDER_CONTRACT))
        if mask:
            rows = mask_sensitive_columns(rows, C.PROCESS_ORDER_MASKED)
        write_table(rows, f"{output_path}/batch_id={batch_id}")

    writer = both.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_location or scratch_path(spark, "order-checkpoint")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def current_orders(spark: SparkSession, output_path: str) -> DataFrame:
    """The latest version of every order that ``run_order_batches`` has written."""
    rows = _earlier(spark, output_path, C.PROCESS_ORDER_CONTRACT, 1 << 62)
    last = _earlier(spark, output_path, C.PROCESS_ORDER_CONTRACT, 1 << 62).groupBy("AUFNR").agg(F.max("batch_id").alias("batch_id"))
    same = rows["AUFNR"].eqNullSafe(last["AUFNR"]) & (rows["batch_id"] == last["batch_id"])
    return rows.join(last, same, "left_semi").select(*C.names(C.PROCESS_ORDER_CONTRACT))

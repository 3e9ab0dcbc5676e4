"""Order batches of two systems that share order numbers, against the batch run with all its rows."""

import tempfile

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from erpweave import contracts as C
from erpweave.operators import (
    integration_process_order,
    mask_sensitive_columns,
    post_prep_process_order,
    prep_sap_order_header_data,
    prep_sap_order_item,
)
from erpweave.plans.catalog import AS_OF, QUERIES
from erpweave.sources.fixtures import OverlappingErpSources
from erpweave.sources.sinks import write_table
from erpweave.streaming import current_orders, run_order_batches


def test_items_of_both_systems_and_headers_of_no_number_stay(spark):
    src = OverlappingErpSources(SF_SMALL)
    load = lambda table: src.load(spark, "SYS1", table).withColumn("SOURCE_SYSTEM_ERP", F.lit("SYS1")).unionByName(
        src.load(spark, "SYS2", table).withColumn("SOURCE_SYSTEM_ERP", F.lit("SYS2"))
    )
    headers, items = load("AFKO").filter("AUFNR % 10 < 4"), load("AFPO").filter("AUFNR % 10 < 4")
    headers = headers.unionByName(headers.limit(2).withColumn("AUFNR", F.lit(None).cast(headers.schema["AUFNR"].dataType)))
    root, out = tempfile.mkdtemp(prefix="erpweave-systems-in-"), tempfile.mkdtemp(prefix="erpweave-systems-out-")
    write_table(headers, f"{root}/h", single_file=True)
    write_table(items.filter("POSNR < '3'"), f"{root}/i/1", single_file=True)
    write_table(items.filter("POSNR > '1'"), f"{root}/i/2", single_file=True)  # position 2 again
    headers = spark.read.parquet(f"{root}/h")
    read = lambda schema, path: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    master, material = QUERIES["prep_order_master"](spark, SF_SMALL), QUERIES["prep_material_order"](spark, SF_SMALL)
    run_order_batches(
        read(headers.schema, f"{root}/h"), read(items.schema, f"{root}/i/*"), master, material,
        f"{out}/rows", f"{out}/state", f"{out}/ckpt", as_of=AS_OF,
    ).awaitTermination()
    joined = integration_process_order(prep_sap_order_header_data(headers, AS_OF), prep_sap_order_item(items), master, material)
    expected = mask_sensitive_columns(post_prep_process_order(joined).select(*C.names(C.PROCESS_ORDER_CONTRACT)), C.PROCESS_ORDER_MASKED)
    got = rows(current_orders(spark, f"{out}/rows"))
    assert got == rows(expected) and sum(r[expected.columns.index("AUFNR")] is None for r in got) == 2

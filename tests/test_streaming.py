"""Streaming adapter: stateless order operators on a stream, batch operators per micro-batch."""

import tempfile

from conftest import SF_SMALL, rows

from erpweave.operators import key_violations
from erpweave.plans.catalog import AS_OF, QUERIES
from erpweave.sources.fixtures import TpchErpSources
from erpweave.sources.sinks import write_table
from erpweave.streaming import current_orders, run_micro_batches, run_order_batches, stream_process_orders


def test_stream_process_orders_equals_batch(spark):
    src = TpchErpSources(SF_SMALL)
    root = tempfile.mkdtemp(prefix="erpweave-stream-in-")
    for system in src.systems:  # one extract file per system -> one micro-batch each
        write_table(src.load(spark, system, "AFKO"), f"{root}/{system}", single_file=True)
    schema = src.load(spark, "SYS1", "AFKO").schema
    items = QUERIES["prep_order_item"](spark, SF_SMALL)
    master = QUERIES["prep_order_master"](spark, SF_SMALL)
    material = QUERIES["prep_material_order"](spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="erpweave-stream-out-")
    query = stream_process_orders(
        spark, f"{root}/*/*.parquet", schema, items, master, material, f"{out}/rows", f"{out}/ckpt",
        as_of=AS_OF, max_files_per_trigger=1,
    )
    query.awaitTermination()
    streamed = spark.read.parquet(f"{out}/rows")
    expected = QUERIES["process_order"](spark, SF_SMALL)
    assert rows(streamed.select(*expected.columns)) == rows(expected)


def test_micro_batches_run_batch_operators(spark):
    data = tempfile.mkdtemp(prefix="erpweave-mb-in-")
    QUERIES["process_order"](spark, SF_SMALL).write.parquet(f"{data}/po")
    stream = spark.readStream.schema(spark.read.parquet(f"{data}/po").schema).parquet(f"{data}/po")
    out = tempfile.mkdtemp(prefix="erpweave-mb-out-")
    query = run_micro_batches(
        stream, lambda b: key_violations(b, ["primary_key_intra"]), f"{out}/report", f"{out}/ckpt"
    )
    query.awaitTermination()
    report = spark.read.parquet(f"{out}/report/*").collect()
    assert sum(r["duplicated_values"] for r in report) >= 1


def test_keys_are_written_once_over_all_batches(spark):
    data = tempfile.mkdtemp(prefix="erpweave-keys-in-")
    for i, part in enumerate([[("a", 1), ("b", 1), (None, 1)], [("b", 2), ("c", 2), ("c", 2)], [(None, 3), ("d", 3)]]):
        spark.createDataFrame(part, "k STRING, v INT").coalesce(1).write.parquet(f"{data}/{i}")
    stream = spark.readStream.schema("k STRING, v INT").option("maxFilesPerTrigger", 1).parquet(f"{data}/*/*.parquet")
    out = tempfile.mkdtemp(prefix="erpweave-keys-out-")
    run_micro_batches(stream, lambda b: b, f"{out}/rows", f"{out}/ckpt", keys=["k"]).awaitTermination()
    assert sorted((str(r.k), r.v) for r in spark.read.parquet(f"{out}/rows").collect()) == [("None", 1), ("a", 1), ("b", 1), ("c", 2), ("d", 3)]


def test_late_items_are_joined_again(spark):
    src = TpchErpSources(SF_SMALL)
    root = tempfile.mkdtemp(prefix="erpweave-late-in-")
    headers, items = src.view(spark, "AFKO"), src.view(spark, "AFPO")
    # First all headers, then the items in two files, the second with old rows delivered again.
    write_table(headers, f"{root}/h", single_file=True)
    write_table(items.filter("POSNR < '3'"), f"{root}/i/1", single_file=True)
    write_table(items.filter("POSNR > '1'"), f"{root}/i/2", single_file=True)
    read = lambda schema, path: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = tempfile.mkdtemp(prefix="erpweave-late-out-")
    run_order_batches(
        read(headers.schema, f"{root}/h"), read(items.schema, f"{root}/i/*"), QUERIES["prep_order_master"](spark, SF_SMALL),
        QUERIES["prep_material_order"](spark, SF_SMALL), f"{out}/rows", f"{out}/state", f"{out}/ckpt", as_of=AS_OF,
    ).awaitTermination()
    current = current_orders(spark, f"{out}/rows")
    # The grain of the items is (order, position, plant): the state keeps one row of each.
    expected = QUERIES["process_order"](spark, SF_SMALL)
    grain = ["AUFNR", "POSNR", "DWERK"]
    assert current.columns == expected.columns
    assert rows(current, *grain) == rows(expected.dropDuplicates(grain), *grain)
    full = {tuple(r) for r in expected.collect()}
    assert all(tuple(r) in full for r in current.collect())

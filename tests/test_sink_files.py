"""What the writers put on disk."""

import time
from pathlib import Path

from conftest import SF_SMALL, rows
from erpweave.plans.catalog import QUERIES
from erpweave.plans.harmonize import _check
from erpweave.sources.sinks import _CLEANUP_CONF, _WRITERS_CONF, _open_writers, write_table


def test_parquet_is_zstd_and_csv_can_be_compressed(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "CAST(id % 3 AS STRING) AS system")
    write_table(df, f"{tmp_path}/p", partition_by=["system"])
    write_table(df, f"{tmp_path}/c", fmt="csv", compression="gzip")
    assert all(p.name.endswith(".zstd.parquet") for p in Path(tmp_path, "p").rglob("part-*"))
    assert all(p.name.endswith(".csv.gz") for p in Path(tmp_path, "c").glob("part-*"))
    assert rows(spark.read.parquet(f"{tmp_path}/p").select("id", "system").selectExpr("id", "CAST(system AS STRING)")) == rows(df)


def test_partitioned_write_keeps_files_open_and_restores_the_setting(spark, tmp_path):
    before = spark.conf.get(_WRITERS_CONF, None)
    with _open_writers(spark), _open_writers(spark):
        assert int(spark.conf.get(_WRITERS_CONF)) > 1
    assert spark.conf.get(_WRITERS_CONF, None) == before
    # More values than files that may be open.
    df = spark.range(1000).selectExpr("id", "CAST(id % 50 AS INT) AS k").coalesce(1)
    write_table(df, f"{tmp_path}/p", partition_by=["k"])
    assert rows(spark.read.parquet(f"{tmp_path}/p").select("id", "k")) == rows(df)


def test_material_rows_are_written_plant_by_plant(spark):
    plan = QUERIES["local_material"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    last = next(line for line in plan.splitlines() if " Sort [" in line)
    assert last.index("SOURCE_SYSTEM_ERP") < last.index("WERKS") < last.index("MATNR"), last


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files() -> set[str]:
        return {b for b in disk.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}

    conf, before = spark.conf.get(_CLEANUP_CONF, None), files()
    df = spark.range(1000).selectExpr("id % 7 AS k", "id").repartition(4, "k")
    write_table(df, f"{tmp_path}/p")
    write_table(df, f"{tmp_path}/q", partition_by=["k"])
    for _ in range(50):  # they are deleted beside the write
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(_CLEANUP_CONF, None) == conf
    assert rows(spark.read.parquet(f"{tmp_path}/p").select("k", "id")) == rows(df)


def test_a_key_check_leaves_no_shuffle_files(spark, tmp_path):
    """Both phases: the digests that are counted, and the texts of those that occur again."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files() -> set[str]:
        return {b for b in disk.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}

    write_table(spark.range(1000).selectExpr("CAST(id % 900 AS STRING) AS k").repartition(4), f"{tmp_path}/p")
    written, before = spark.read.parquet(f"{tmp_path}/p"), files()
    assert _check(written, ["k"])["k"] == {"distinct_values": 900, "duplicated_values": 100, "duplicated_rows": 200, "null_rows": 0}
    for _ in range(50):  # they are deleted beside the check
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before

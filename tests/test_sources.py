"""CSV readers (inferred and declared schema), the source registry and the writers."""

import tempfile
from pathlib import Path

from conftest import rows
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from erpweave import contracts as C
from erpweave.sources import SourceRegistry, SystemLocation, read_csv_file, read_csv_typed, write_table

CSV = "﻿name,age,code\nAlice,25,0001\nBob,30,0002\nCharlie,35,0003\n"


def _csv(text: str = CSV) -> str:
    path = Path(tempfile.mkdtemp(prefix="erpweave-csv-")) / "data.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_inferred_schema_turns_ids_into_numbers(spark):
    df = read_csv_file(spark, _csv(), infer_schema=True)
    assert df.count() == 3 and df.columns == ["name", "age", "code"]
    assert isinstance(df.schema["age"].dataType, IntegerType)
    assert rows(df, "code")[0] == (1,)  # leading zeros lost: the reason typed reads are the default


def test_positional_schema(spark):
    schema = StructType(
        [StructField("name", StringType()), StructField("age", IntegerType()), StructField("code", StringType())]
    )
    df = read_csv_file(spark, _csv(), infer_schema=False, schema=schema)
    assert df.schema == schema and rows(df, "code")[0] == ("0001",)


def test_typed_by_name_prunes_and_keeps_text_ids(spark):
    df = read_csv_typed(spark, _csv(), C.struct(("code", C.S), ("age", C.F64)))
    assert df.columns == ["code", "age"]
    assert rows(df) == [("0001", 25.0), ("0002", 30.0), ("0003", 35.0)]


def test_registry_paths_and_loading(spark):
    root = Path(tempfile.mkdtemp(prefix="erpweave-reg-"))
    (root / "system_1").mkdir()
    (root / "system_1" / "PRE_T001.csv").write_text("MANDT,BUKRS,WAERS,SPRAS\n100,0001,EUR,D\n", encoding="utf-8")
    reg = SourceRegistry({"SYS1": SystemLocation(str(root / "system_1"), "PRE")})
    assert reg.systems == ["SYS1"]
    assert reg.path("SYS1", "T001").endswith("system_1/PRE_T001.csv")
    df = reg.load(spark, "SYS1", "T001")
    assert df.columns == ["MANDT", "BUKRS", "WAERS"] and rows(df) == [("100", "0001", "EUR")]


def test_write_partitioned_parquet_and_single_file_csv(spark):
    df = spark.createDataFrame([("SYS1", 1), ("SYS2", 2), ("SYS1", 3)], "source_system_erp STRING, v INT")
    out = tempfile.mkdtemp(prefix="erpweave-out-")
    write_table(df, f"{out}/p", partition_by=["source_system_erp"])
    assert sorted(p.name for p in Path(f"{out}/p").iterdir() if p.is_dir()) == [
        "source_system_erp=SYS1",
        "source_system_erp=SYS2",
    ]
    assert spark.read.parquet(f"{out}/p").filter("source_system_erp = 'SYS2'").count() == 1
    write_table(df, f"{out}/c", fmt="csv", single_file=True)
    assert len(list(Path(f"{out}/c").glob("part-*.csv"))) == 1
    assert rows(read_csv_typed(spark, f"{out}/c", C.struct(("v", C.I32))), "v") == [(1,), (2,), (3,)]


def test_recommended_conf_applies_to_a_running_session(spark):
    from erpweave import apply_recommended_conf, recommended_conf

    before = spark.conf.get("spark.sql.shuffle.partitions")
    apply_recommended_conf(spark, shuffle_partitions=int(before))
    for key, value in recommended_conf().items():
        assert spark.conf.get(key) == value


def test_filters_and_projection_reach_a_parquet_extract(spark):
    from erpweave.operators import prep_general_material_data, prep_material_valuation
    from erpweave.sources.fixtures import TpchErpSources

    src = TpchErpSources("/root/testdata/sf0.001")
    root = tempfile.mkdtemp(prefix="erpweave-pq-")
    for table in ("MARA", "MBEW"):
        write_table(src.load(spark, "SYS1", table), f"{root}/PRE_{table}.parquet")
    reg = SourceRegistry({"SYS1": SystemLocation(root, "PRE", fmt="parquet")})

    mara = prep_general_material_data(reg.load(spark, "SYS1", "MARA"), "ZZMDGM")
    plan = mara._jdf.queryExecution().executedPlan().toString().replace(" ", "")
    assert "PushedFilters:[Or(IsNull(BISMT),Not(In(BISMT" in plan  # the blank test uses trim: not pushable
    assert "ReadSchema:struct<MANDT:string,MATNR:string,MEINS:string,ZZMDGM:string,BISMT:string,LVORM:string>" in plan

    mbew = prep_material_valuation(reg.load(spark, "SYS1", "MBEW"))
    plan = mbew._jdf.queryExecution().executedPlan().toString().replace(" ", "")
    assert "IsNull(LVORM)" in plan and "IsNull(BWTAR)" in plan


def test_clear_scratch_removes_only_this_application(spark, tmp_path):
    import os

    from erpweave.session import clear_scratch, scratch_path, work_dir

    mine = scratch_path(spark, "mine")
    spark.range(3).write.parquet(mine)
    other = f"{work_dir(spark)}/erpweave/another-application/kept"
    spark.range(3).write.parquet(other, mode="overwrite")
    clear_scratch(spark)
    local = lambda path: path.removeprefix("file:").replace("///", "/")
    assert not os.path.exists(local(mine)) and os.path.exists(local(other))

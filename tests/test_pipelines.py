"""End-to-end data sets on the driver's tables: oracle parity, run modes, determinism, plans."""

import tempfile

import pytest
from conftest import SF_SMALL
from oracle_check import compare, duck

import __spark_entry__ as entry
from erpweave.plans import harmonize_data
from erpweave.plans.catalog import AS_OF, QUERIES
from erpweave.sources.fixtures import TpchErpSources

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, SF_SMALL, name, QUERIES[name], SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "order_number" in df.columns


def test_harmonize_raise_and_report(spark):
    src = TpchErpSources(SF_SMALL)
    out = tempfile.mkdtemp(prefix="erpweave-run-")
    with pytest.raises(ValueError, match="is not unique"):
        harmonize_data(spark, src, f"{out}/a", order_options={"as_of": AS_OF})
    # Order keys are duplicated in the fixture: nothing at all is published, not even the
    # local material whose keys are unique.
    import os

    assert not os.path.exists(f"{out}/a/local_material") and not os.path.exists(f"{out}/a/process_order")
    res = harmonize_data(spark, src, f"{out}/b", on_key_violation="report", order_options={"as_of": AS_OF})
    assert res["local_material"].keys_unique
    published = spark.read.parquet(f"{out}/b/local_material")
    assert published.count() == res["local_material"].rows
    assert "material_number" in published.columns
    assert spark.read.parquet(f"{out}/b/process_order").count() == res["process_order"].rows


@pytest.mark.parametrize("name", ["local_material", "process_order"])
def test_same_rows_for_any_shuffle_partitioning(spark, name):
    def snapshot():
        return sorted(tuple(map(repr, r)) for r in QUERIES[name](spark, SF_SMALL).collect())

    first = snapshot()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert snapshot() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("name", ["local_material_final", "process_order_final"])
def test_plan_is_jvm_only_pruned_and_parallel(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "SinglePartition" not in plan
    # Only the columns the pipeline uses are read: lineitem has 11 columns.
    assert "l_tax" not in plan and "l_discount" not in plan


def test_isolated_systems_only_match_their_own_materials(spark):
    from pyspark.sql import functions as F

    from erpweave.plans import process_process_order

    src = TpchErpSources(SF_SMALL)
    shared = process_process_order(spark, src, as_of=AS_OF, mask=False)
    isolated = process_process_order(spark, src, as_of=AS_OF, mask=False, isolate_systems=True)
    assert isolated.count() == shared.count()
    # Items whose material number belongs to the other system keep no material data.
    cross = F.col("SOURCE_SYSTEM_ERP") != F.when(F.col("MATNR").cast("long") % 2 == 0, "SYS1").otherwise("SYS2")
    assert isolated.filter(cross & F.col("MTART").isNotNull()).count() == 0
    assert shared.filter(cross & F.col("MTART").isNotNull()).count() > 0


def test_pipelines_can_check_keys_right_away(spark):
    from erpweave.plans import process_local_material, process_process_order

    src = TpchErpSources(SF_SMALL)
    assert process_local_material(spark, src, check_keys=True).count() > 0
    with pytest.raises(ValueError, match="Column 'primary_key_intra' is not unique"):
        process_process_order(spark, src, as_of=AS_OF, check_keys=True)


@pytest.mark.parametrize(("name", "max_exchanges"), [("local_material_final", 14), ("process_order_final", 8)])
def test_shuffle_count_without_broadcasts(spark, name, max_exchanges):
    """The large-scale shape (nothing broadcastable): each join, window and distinct adds at
    most one hash exchange per side."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") <= max_exchanges
    assert len(plan.splitlines()) < 250


def test_pipelines_on_empty_extracts(spark):
    from erpweave import contracts as C
    from erpweave.plans import process_local_material, process_process_order

    class Empty:
        systems = ["SYS1", "SYS2"]

        def __init__(self):
            self.inner = TpchErpSources(SF_SMALL)

        def load(self, spark_, system, table):
            return self.inner.load(spark_, system, table).filter("false")

    material = process_local_material(spark, Empty())
    order = process_process_order(spark, Empty(), as_of=AS_OF)
    assert material.count() == 0 and order.count() == 0
    assert material.columns == C.names(C.LOCAL_MATERIAL_CONTRACT)
    out = tempfile.mkdtemp(prefix="erpweave-empty-")
    res = harmonize_data(spark, Empty(), out, order_options={"as_of": AS_OF})
    assert res["local_material"].rows == 0 and res["process_order"].rows == 0


def test_published_types_order_and_no_leftovers(spark):
    import os

    from erpweave import contracts as C
    from erpweave.plans.catalog import _NumberedSources, _UntidySources
    from erpweave.plans.harmonize import publish, read_published
    from erpweave.plans.pipelines import process_local_material, rename_local_material

    out = tempfile.mkdtemp(prefix="erpweave-published-")
    material = process_local_material(spark, _NumberedSources(SF_SMALL))
    for _ in range(2):  # a second run replaces the first
        result = publish(material, "local_material", f"{out}/local_material", rename_local_material, on_key_violation="raise")
    back = read_published(spark, out, "local_material")
    assert back.schema == C.renamed(C.LOCAL_MATERIAL_CONTRACT, C.LOCAL_MATERIAL_RENAME)
    assert {r.source_system_erp for r in back.select("source_system_erp").distinct().collect()} == {"001", "010"}
    assert back.count() == result.rows and os.listdir(out) == ["local_material"]
    res = harmonize_data(
        spark, _UntidySources(SF_SMALL), f"{out}/untidy", on_key_violation="off", order_options={"as_of": AS_OF}, report_rejects=True
    )
    assert set(res["local_material"].rejects) == {("SYS1", "MBEW", "STPRS"), ("SYS2", "MBEW", "STPRS")}
    assert {k[1:] for k in res["process_order"].rejects} == {("AFPO", "LTRMI")}


def test_scans_of_the_order_joins(spark):
    """Headers, masters and materials are read once per system, items once more to find hot keys."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["process_order_final"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scans = plan.count("FileScan parquet")
    assert scans <= 8 + 4, scans  # 4 tables of 2 systems; AFPO's hot keys are listed on both sides of the join, run once


def test_work_dir_must_be_shared_on_a_cluster():
    from erpweave.session import work_dir

    class Conf:
        def get(self, key, default=None):
            return "local-cluster[2,1,1024]" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Session())

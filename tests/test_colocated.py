"""Order tables stored by order number: the same rows as a run from the extracts, without exchanges."""

import uuid
from collections import Counter

import pytest
from conftest import SF_SMALL

from erpweave.plans import process_process_order
from erpweave.plans.catalog import AS_OF
from erpweave.plans.colocated import drop_order_tables, process_stored_orders, store_order_tables, stored_order_rows
from erpweave.sources.fixtures import OverlappingErpSources, TpchErpSources


@pytest.fixture
def prefix(spark):
    name = f"stored_{uuid.uuid4().hex[:8]}"
    yield name
    drop_order_tables(spark, name)


def _counted(df):
    return Counter(tuple(map(repr, r)) for r in df.collect())


class _Gaps(TpchErpSources):
    """A third of all headers without a number, half of the items in one order, masters missing."""

    def load(self, spark, system, table):
        df = super().load(spark, system, table)
        if table == "AFKO":
            return df.selectExpr("* EXCEPT (AUFNR)", "IF(crc32(AUFNR) % 3 = 0, NULL, AUFNR) AS AUFNR").select(*df.columns)
        if table == "AFPO":
            first = spark.read.parquet(f"{SF_SMALL}/orders.parquet").selectExpr("min(o_orderkey) AS k").first().k
            number = f"IF(crc32(AUFNR) % 2 = 0, '{first + 1}', IF(crc32(AUFNR) % 5 = 0, NULL, AUFNR)) AS AUFNR"
            return df.selectExpr("* EXCEPT (AUFNR)", number).select(*df.columns)
        return df.filter("crc32(AUFNR) % 4 > 0") if table == "AUFK" else df


@pytest.mark.parametrize("isolate", [False, True])
@pytest.mark.parametrize("sources", [TpchErpSources, OverlappingErpSources, _Gaps])
def test_stored_rows_equal_a_run_from_the_extracts(spark, prefix, sources, isolate):
    src = sources(SF_SMALL)
    changes = sources is not _Gaps
    options = {"as_of": AS_OF, "isolate_systems": isolate, "with_changes": changes}
    store_order_tables(spark, src, prefix, buckets=4, hot_key_rows=200, **options)
    hot = spark.table(f"{prefix}_hot_orders").count()
    assert hot == (1 if sources is _Gaps and not isolate else hot)
    want = process_process_order(spark, src, **options)
    assert _counted(process_stored_orders(spark, prefix, changes, isolate)) == _counted(want)


def test_joins_of_stored_facts_need_no_exchange(spark, prefix, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store_order_tables(spark, TpchErpSources(SF_SMALL), prefix, buckets=4, location=str(tmp_path), as_of=AS_OF)
        rows = stored_order_rows(spark, prefix)
        rows.write.format("noop").mode("overwrite").save()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert "Exchange" not in plan, plan
        # A whole run exchanges for the materials (J8) only: both sides of one join.
        whole = process_stored_orders(spark, prefix)._jdf.queryExecution().executedPlan().toString()
        assert whole.count("Exchange hashpartitioning") == 2 and whole.count("Bucketed: true") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

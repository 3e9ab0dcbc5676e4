"""Hot groups: null join keys are spread over reducers, and a hot right-side key of a
one-to-many join is salted over several tasks."""

import pytest
from pyspark.sql import functions as F

from erpweave.operators import left_join

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _largest_partition_share(df) -> float:
    sizes = [r["n"] for r in df.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()]
    return max(sizes) / sum(sizes)


def test_hot_right_key_is_salted_over_tasks(skew_conf):
    spark = skew_conf
    headers = spark.range(0, 2000).selectExpr("CAST(id AS STRING) AS AUFNR", "id AS h")
    # A third of the items spread over all orders, two thirds on order 7.
    items = spark.range(0, 60000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN CAST(id % 2000 AS STRING) ELSE '7' END AS AUFNR", "id AS i"
    )
    plain = left_join(headers, items, "AUFNR")
    split = left_join(headers, items, "AUFNR", split_right_skew=True, hot_key_rows=1000)
    assert _largest_partition_share(plain) > 0.6
    assert _largest_partition_share(split) < 0.3
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))


def test_null_keys_spread_over_reducers(skew_conf):
    spark = skew_conf
    # A third of the left rows have a null key (as MANDT after a filtered material).
    left = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(id % 50 AS STRING) END AS k", "id")
    right = spark.range(0, 50).selectExpr("CAST(id AS STRING) AS k", "id AS r")
    plain = left_join(left, right, "k")
    spread = left_join(left, right, "k", spread_null_keys=True)
    assert _largest_partition_share(plain) > 0.33
    assert _largest_partition_share(spread) < 0.25
    assert sorted(map(repr, spread.collect())) == sorted(map(repr, plain.collect()))


def test_hot_key_threshold_from_session(skew_conf):
    spark = skew_conf
    headers = spark.range(0, 100).selectExpr("CAST(id AS STRING) AS k", "id AS h")
    items = spark.range(0, 5000).selectExpr("CASE WHEN id % 2 = 0 THEN '7' ELSE CAST(id % 100 AS STRING) END AS k", "id AS i")
    spark.conf.set("erpweave.hotKeyRows", "100")
    try:
        split = left_join(headers, items, "k", split_right_skew=True)
        assert _largest_partition_share(split) < 0.3
    finally:
        spark.conf.unset("erpweave.hotKeyRows")
    assert sorted(map(repr, split.collect())) == sorted(map(repr, left_join(headers, items, "k").collect()))

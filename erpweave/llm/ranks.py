"""Positions of rows within their groups in a global order, without a window over a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from erpweave.llm.stored import stored


def ranked(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order`` within ``group``) and ``n`` (rows of the group).

    Ranges of (group, order) are sorted and written; a range's rows are numbered where they
    lie, and the row counts of the ranges before it shift the numbers. A hot group, or a hot
    value of ``order``, spreads over many ranges. The one window runs over the ranges of a
    group. ``group`` must not be null; null sorts first in ``order``; equal rows share out
    their positions as they come. ``rows`` should be a stored table, as it is read twice.
    """
    spark = rows.sparkSession
    keys = [group, *order]
    spread = rows.withColumn("line", F.monotonically_increasing_id())
    ranges = (
        spread.repartitionByRange(*keys, "line")
        .sortWithinPartitions(*keys, "line")
        .withColumn("line", F.monotonically_increasing_id())
        .withColumn("range", F.spark_partition_id())
    )
    ranges = stored(spark, ranges, f"{name}-ranges")
    counts = ranges.groupBy(group, "range").agg(F.min("line").alias("first"), F.count("*").alias("here"))
    along = Window.partitionBy(group).orderBy("range")
    before = F.coalesce(F.sum("here").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(
        group,
        "range",
        (before - F.col("first")).alias("shift"),
        F.sum("here").over(Window.partitionBy(group)).alias("n"),
    )
    return (
        ranges.join(stored(spark, starts, f"{name}-starts"), [group, "range"])
        .withColumn("pos", F.col("line") + F.col("shift"))
        .drop("line", "shift", "range")
    )

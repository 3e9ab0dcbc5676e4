"""Keep-one-row-per-key operators.

``latest_per_key`` is ``row_number() = 1`` over a window with a *total* order, so the
surviving row never depends on shuffle order. Catalyst plans the ``= 1`` filter as a
``WindowGroupLimit``: a partial top-1 runs before the shuffle, so a hot key sends at most
one row per map task across the network, and the final top-1 runs after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW_NUMBER = "__erpweave_row_number"


def asc_nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def desc_nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row of each key group under ``order_by`` (give a total order)."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_ROW_NUMBER, F.row_number().over(window)).filter(F.col(_ROW_NUMBER) == 1).drop(_ROW_NUMBER)


def first_per_key_counted(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str = "no_of_duplicates"
) -> DataFrame:
    """First row of each key group with the number of rows that share the key.

    ``order_by`` names columns, ascending with nulls last; all other columns follow in their
    order, so the order is total. One aggregation of (least row, count): its partial step
    leaves one row per key and map task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = [*order_by, *rest]
    cells = [x for c in ranked for x in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(f"v_{c}"))]
    least = df.groupBy(*keys).agg(F.min(F.struct(*cells)).alias("__least"), F.count(F.lit(1)).alias(name))
    values = {c: F.col("__least").getField(f"v_{c}").alias(c) for c in ranked}
    return least.select(*[values.get(c, F.col(c)) for c in df.columns], name)


def distinct_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop exact duplicates (map-side partial aggregation before the shuffle)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count (GROUP BY ... HAVING)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)

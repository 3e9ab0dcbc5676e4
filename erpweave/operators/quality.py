"""Masking, key uniqueness, schema contracts, profiling and previews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from erpweave.functions import hmac_sha256_hex, sha256_hex
from erpweave.session import scratch_path
from erpweave.sources.sinks import shuffles_freed


def mask_sensitive_columns(
    df: DataFrame, sensitive_columns: Sequence[str], salt: str | None = None, key: str | None = None
) -> DataFrame:
    """Replace each listed column by the SHA-256 hex of its text (null stays null).

    Every name is checked before anything is built; an unknown one raises ``ValueError``.
    ``salt`` (optional) is prepended to the text before hashing. With ``key`` the hash is an
    HMAC-SHA-256 under that key, which numbers that can be enumerated need.
    """
    if salt and key:
        msg = "give a salt or a key, not both"
        raise ValueError(msg)
    for name in sensitive_columns:
        if name not in df.columns:
            msg = f"Column '{name}' not found in DataFrame."
            raise ValueError(msg)
    if not sensitive_columns:
        return df
    masked = {name: hmac_sha256_hex(name, key) if key else sha256_hex(name, salt) for name in sensitive_columns}
    return df.withColumns(masked)


def _require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    for name in columns:
        if name not in df.columns:
            msg = f"Column '{name}' is not present in the DataFrame."
            raise ValueError(msg)


def _digest(value: Column) -> Column:
    """What the first phase of the key check counts in place of a text. Any function will do:
    texts that share a digest are told apart in the second phase."""
    return F.xxhash64(value)


def key_violations(df: DataFrame, columns: Sequence[str], reread: bool = False) -> DataFrame:
    """Uniqueness report, one row per checked column.

    Each column is checked on its own (not as a composite key). Null is a value: two null
    keys are a duplicate; ``null_rows`` reports them separately.

    By default ``df`` is evaluated once, in one lazy aggregation: the key columns are unpivoted
    to (column_name, value), counted per value with map-side partial aggregation, and the
    counts are folded per column. With ``reread``, for a stored table that is cheap to read
    again, the check takes two phases that shuffle no text of a unique key (``_two_phases``).
    """
    _require_columns(df, columns)
    if reread:
        return _two_phases(df, list(columns))
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    per_value = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    dup = F.col("n") > 1
    return per_value.groupBy("column_name").agg(
        F.count(F.lit(1)).cast("long").alias("distinct_values"),
        F.sum(F.when(dup, 1).otherwise(0)).cast("long").alias("duplicated_values"),
        F.sum(F.when(dup, F.col("n")).otherwise(0)).cast("long").alias("duplicated_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).cast("long").alias("null_rows"),
    )


def _two_phases(df: DataFrame, names: list[str]) -> DataFrame:
    """First 56-bit digests of the key texts are counted: a digest that occurs once is a unique
    key. Only texts under a digest that occurs again are counted as texts, so colliding digests
    cost time but never change a number. Without such digests there is no second phase.

    A row of the first shuffle is two numbers whatever the keys' length. The first phase runs
    when this is called.
    """
    spark = df.sparkSession
    if len(names) > 128:
        msg = "at most 128 key columns can be checked at once"
        raise ValueError(msg)
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(f"v{i}") for i, c in enumerate(names)])

    def digests(i: int) -> Column:
        """56 bits of a text's digest, a mark and the column's number in one long: that and a
        count is all that the first phase shuffles. A null text has the number alone."""
        value = F.col(f"v{i}")
        marked = F.shiftleft(_digest(value).cast("long"), 8).bitwiseOR(F.lit(128 + i).cast("long"))
        return F.when(value.isNotNull(), marked).otherwise(F.lit(i).cast("long")).alias("h")

    numbers = reduce(DataFrame.union, [texts.select(digests(i)) for i in range(len(names))])
    counted = (
        numbers.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("h").bitwiseAND(127).cast("int").alias("k"),
            F.when(F.col("h").bitwiseAND(128) != 0, F.col("h")).alias("h"),
            "n",
        )
    )
    again = F.col("h").isNotNull() & (F.col("n") > 1)
    seen = Observation()
    totals = [F.count_if(again).alias("suspects")]
    for i in range(len(names)):
        own = F.col("k") == i
        totals += [
            F.count_if(own & F.col("h").isNotNull() & (F.col("n") == 1)).alias(f"single{i}"),
            F.coalesce(F.sum(F.when(own & F.col("h").isNull(), F.col("n"))), F.lit(0)).alias(f"nulls{i}"),
        ]
    path = scratch_path(spark, "key-suspects")
    with shuffles_freed(spark):
        counted.observe(seen, *totals).filter(again).select("h").write.parquet(path)
    found = seen.get
    known = [(i, found[f"single{i}"], found[f"nulls{i}"]) for i in range(len(names))]
    parts = spark.createDataFrame(known, "k int, single long, nulls long").select(
        "k",
        (F.col("single") + F.when(F.col("nulls") > 0, 1).otherwise(0)).cast("long").alias("distinct_values"),
        F.when(F.col("nulls") > 1, 1).otherwise(0).cast("long").alias("duplicated_values"),
        F.when(F.col("nulls") > 1, F.col("nulls")).otherwise(0).cast("long").alias("duplicated_rows"),
        F.col("nulls").alias("null_rows"),
    )
    if found["suspects"]:
        long = reduce(
            DataFrame.union,
            [
                texts.filter(F.col(f"v{i}").isNotNull()).select(F.lit(i).alias("k"), digests(i), F.col(f"v{i}").alias("value"))
                for i in range(len(names))
            ],
        )
        suspects = spark.read.schema("h long").parquet(path)  # of known size: broadcast if small
        exact = long.join(suspects, "h", "left_semi").groupBy("k", "h", "value").agg(F.count(F.lit(1)).alias("n"))
        dup = F.col("n") > 1
        parts = parts.unionByName(
            exact.groupBy("k").agg(
                F.count(F.lit(1)).alias("distinct_values"),
                F.count_if(dup).alias("duplicated_values"),
                F.coalesce(F.sum(F.when(dup, F.col("n"))), F.lit(0)).cast("long").alias("duplicated_rows"),
                F.lit(0).cast("long").alias("null_rows"),
            )
        )
    counts = ["distinct_values", "duplicated_values", "duplicated_rows", "null_rows"]
    return (
        parts.groupBy("k")
        .agg(*[F.sum(c).cast("long").alias(c) for c in counts])
        .filter("distinct_values > 0")
        .select(F.element_at(F.array(*[F.lit(c) for c in names]), F.col("k") + 1).alias("column_name"), *counts)
    )


def check_columns_unique(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Raise ``ValueError`` for the first listed column holding a duplicated value.

    Runs one job for all columns; returns ``{column: duplicated values}`` (all zero) when
    every column is unique. An empty list checks nothing.
    """
    _require_columns(df, columns)
    if not columns:
        return {}
    found = {row["column_name"]: row["duplicated_values"] for row in key_violations(df, columns).collect()}
    for name in columns:
        if found.get(name, 0) > 0:
            msg = f"Column '{name}' is not unique. Found {found[name]} duplicate values."
            raise ValueError(msg)
    return {name: 0 for name in columns}


class SchemaContractError(ValueError):
    """The output schema differs from its contract."""


def check_schema(df: DataFrame, contract: StructType, ignore_nullable: bool = True) -> None:
    """Compare names, order and types with the contract (analysis only, no job)."""
    actual = [(f.name, f.dataType, f.nullable) for f in df.schema.fields]
    expected = [(f.name, f.dataType, f.nullable) for f in contract.fields]
    if ignore_nullable:
        actual = [a[:2] for a in actual]
        expected = [e[:2] for e in expected]
    if actual != expected:
        diff = [f"{a} != {e}" for a, e in zip(actual, expected, strict=False) if a != e]
        if len(actual) != len(expected):
            diff.append(f"{len(actual)} columns != {len(expected)} columns")
        msg = "Schema differs from the contract: " + "; ".join(diff)
        raise SchemaContractError(msg)


def profile_data(df: DataFrame, decimals: int | None = None) -> DataFrame:
    """Per-column profile in long form from one global aggregation.

    Columns: column_name, non_null, nulls, mean, stddev (doubles for numeric columns, rounded
    only if ``decimals`` is given), min_value, max_value (Spark's text of the value in its own
    type, so no digit is lost; NaN sorts above every number, as in Spark).
    """

    def number(value: Column) -> Column:
        value = value.cast("double")
        return value if decimals is None else F.round(value, decimals)

    stats = []
    for i, field in enumerate(df.schema.fields):
        c = F.col(field.name)
        numeric = isinstance(field.dataType, NumericType)
        no_number = F.lit(None).cast("double")
        stats += [
            F.count(c).alias(f"n{i}"),
            F.count_if(c.isNull()).alias(f"z{i}"),
            (number(F.avg(c)) if numeric else no_number).alias(f"m{i}"),
            (number(F.stddev_samp(c.cast("double"))) if numeric else no_number).alias(f"s{i}"),
            F.min(c).cast("string").alias(f"lo{i}"),
            F.max(c).cast("string").alias(f"hi{i}"),
        ]
    wide = df.agg(*stats)
    rows = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col(f"n{i}").alias("non_null"),
                F.col(f"z{i}").alias("nulls"),
                F.col(f"m{i}").alias("mean"),
                F.col(f"s{i}").alias("stddev"),
                F.col(f"lo{i}").alias("min_value"),
                F.col(f"hi{i}").alias("max_value"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    return wide.select(F.inline(rows))


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows, in ``order_by`` order when given (a per-partition top-n merge)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)

"""Readers for ERP extracts: CSV (inferred or declared schema) and parquet."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from erpweave.sources.conform import conform

ENCODING = "utf-8"


def read_csv_file(
    spark: SparkSession,
    file_directory: str | Path,
    infer_schema: bool = True,
    schema: StructType | str | None = None,
) -> DataFrame:
    """CSV with a header row, like the reference's reader.

    ``infer_schema=True`` runs an extra pass over the files to guess types (numeric-looking
    identifiers become numbers). Otherwise ``schema`` is applied by position.
    Read errors propagate.
    """
    reader = spark.read.option("header", True).option("encoding", ENCODING)
    if infer_schema:
        return reader.option("inferSchema", True).csv(str(file_directory))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(str(file_directory))


def read_csv_typed(spark: SparkSession, path: str | Path, schema: StructType) -> DataFrame:
    """CSV with the declared schema applied *by column name* (no inference pass).

    Every column is read as text under its header name, then the schema's columns are
    selected and cast. Wide extracts (100+ columns) are pruned to the declared ones: the
    CSV parser only converts the columns the plan reads.
    """
    raw = spark.read.option("header", True).option("encoding", ENCODING).csv(str(path))
    return conform(raw, schema)


def read_table(spark: SparkSession, path: str | Path, fmt: str, schema: StructType | None = None) -> DataFrame:
    """Read one extract in ``csv`` or ``parquet`` and conform it to ``schema`` if given."""
    if fmt == "csv":
        return read_csv_typed(spark, path, schema) if schema is not None else read_csv_file(spark, path, False)
    df = spark.read.format(fmt).load(str(path))
    return conform(df, schema) if schema is not None else df

"""Tables written to the shared work folder between steps (lineage cut, known sizes)."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from erpweave.session import scratch_path


def stored(spark: SparkSession, df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` under the shared work folder and read it back.

    A lost executor then costs a re-read instead of a re-run, and Spark knows the size of
    what it joins, so that it broadcasts only what is under its threshold.
    """
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Matters for a checkout that is on the driver's ``sys.path`` only; on a cluster the package
    is installed, or shipped with ``addPyFile``, under the same or another path.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])

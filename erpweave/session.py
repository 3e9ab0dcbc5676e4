"""Session settings and the shared work folder.

The library never builds its own session for production use: the caller supplies one.
``recommended_conf`` lists the settings the plans are designed for, and ``local_session``
builds a small local session for tests and benchmarks only.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on. AQE re-plans joins at run time (broadcasts a side only when
# its measured size is under the threshold, splits skewed shuffle partitions, and
# coalesces small ones); the shuffle partition count is sized per cluster by the caller.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}


def recommended_conf(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Return the settings the plans are designed for."""
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf


def apply_recommended_conf(spark: SparkSession, shuffle_partitions: int | None = None) -> None:
    """Set the recommended SQL settings on an existing session (all are runtime settings).

    Call it once on the cluster's session before building plans; it only touches the
    ``spark.sql.*`` settings listed in ``RECOMMENDED_CONF``.
    """
    for key, value in recommended_conf(shuffle_partitions).items():
        spark.conf.set(key, value)


def local_session(
    cores: int = 8,
    shuffle_partitions: int = 8,
    app_name: str = "erpweave",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or return) a local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in recommended_conf(shuffle_partitions).items():
        builder = builder.config(key, value)
    # Small local shuffles: let AQE keep one partition per core instead of merging them
    # into 1 MB partitions (at cluster scale the advisory size decides anyway).
    builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    directory = spark.conf.get("spark.checkpoint.dir", None)
    if directory:
        return directory
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext on a Spark Connect session
        return None


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a machine-local folder is not visible to
    other executors). Only a local-mode session without the setting gets a fresh temporary
    folder, which is then also registered as its checkpoint folder.
    """
    directory = _configured_checkpoint_dir(spark)
    if directory:
        return directory.rstrip("/")
    if not re.match(r"local(\[|$)", str(spark.conf.get("spark.master", ""))):
        msg = "spark.checkpoint.dir must name a shared folder on a cluster"
        raise RuntimeError(msg)
    directory = tempfile.mkdtemp(prefix="erpweave-")
    try:
        spark.sparkContext.setCheckpointDir(directory)
        return _configured_checkpoint_dir(spark).rstrip("/")
    except Exception:  # noqa: BLE001 - Spark Connect: keep the folder for this process
        spark.conf.set("spark.checkpoint.dir", directory)
        return directory


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared work folder, in this application's own part of it."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/erpweave/{spark.conf.get('spark.app.id', 'session')}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application once their results are written.

    Results that are still lazy read these tables, so call it at the end of a run.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

"""Writers for the unified data sets."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


#: Files (of different partition values) that a task holds open before Spark sorts its rest.
OPEN_WRITERS = 4
_WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"
_open_lock = threading.Lock()
_open_writes: dict[int, tuple[int, str | None]] = {}  # per session: writes under way, the setting before


_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaned_writes: dict[int, tuple[int, str | None]] = {}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """While a write or a check runs, Spark deletes its shuffle files as soon as it ends (else they stay until
    the driver collects its garbage, beside those of the next one). A setting of the caller's stays."""
    key = id(spark)
    with _open_lock:
        writes, before = _cleaned_writes.get(key, (0, None))
        if not writes:
            before = spark.conf.get(_CLEANUP_CONF, None)
            spark.conf.set(_CLEANUP_CONF, "true")
        _cleaned_writes[key] = (writes + 1, before)
    try:
        yield
    finally:
        with _open_lock:
            writes, before = _cleaned_writes.pop(key)
            if writes > 1:
                _cleaned_writes[key] = (writes - 1, before)
            elif before is None:
                spark.conf.unset(_CLEANUP_CONF)
            else:
                spark.conf.set(_CLEANUP_CONF, before)


@contextmanager
def _open_writers(spark: SparkSession) -> Iterator[None]:
    """While a partitioned write runs, tasks hold a file per partition value open instead of
    sorting all their rows by it (the rows are at their widest there, and the sort spills). With
    more values than ``OPEN_WRITERS`` the rest is sorted as before. A setting of the caller's stays."""
    key = id(spark)
    with _open_lock:
        writes, before = _open_writes.get(key, (0, None))
        if not writes:
            before = spark.conf.get(_WRITERS_CONF, None)
            if before in (None, "0"):
                spark.conf.set(_WRITERS_CONF, str(OPEN_WRITERS))
        _open_writes[key] = (writes + 1, before)
    try:
        yield
    finally:
        with _open_lock:
            writes, before = _open_writes.pop(key)
            if writes > 1:
                _open_writes[key] = (writes - 1, before)
            elif before is None:
                spark.conf.unset(_WRITERS_CONF)
            else:
                spark.conf.set(_WRITERS_CONF, before)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    single_file: bool = False,
    compression: str | None = None,
) -> None:
    """Write ``df`` to ``path`` (CSV gets a header row).

    Every task writes its own files; ``single_file=True`` funnels the last stage through one
    task (``coalesce(1)``) and is meant for small outputs only. ``partition_by`` lays the
    output out by column values (e.g. the source system) for partition pruning on read.
    ``compression`` defaults to zstd for parquet, which halves masked columns (snappy cannot
    shorten hexadecimal digits), and to none for CSV.
    """
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if compression or fmt == "parquet":
        writer = writer.option("compression", compression or "zstd")
    with shuffles_freed(df.sparkSession):
        if not partition_by:
            writer.save(path)
            return
        with _open_writers(df.sparkSession):
            writer.partitionBy(*partition_by).save(path)


def read_written(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A table written by ``write_table`` with the types and column order of ``schema``.

    The schema is given and not inferred, so a partition column keeps its type (a system id
    ``001`` stays text) and its place.
    """
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.load(path).select(*schema.fieldNames())


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        msg = f"cannot move {source} to {target}"
        raise OSError(msg)


def swap_folders(spark: SparkSession, staged: dict[str, str]) -> None:
    """Put each staged folder (key) in the place of its target (value), all or none.

    Old folders are set aside by a rename and deleted only after every new one is in place;
    when a step fails, what was done is undone, and the staged folders stay where they were.
    Between the two renames of a target it is absent for a moment, and a killed process leaves
    the old folder beside it (``.replaced-*``): publish by versions where readers must not see that.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    undo: list = []
    olds: list = []
    try:
        for source, target in staged.items():
            src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
            fs = dst.getFileSystem(conf)
            fs.mkdirs(dst.getParent())
            if fs.exists(dst):
                old = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.replaced-{uuid.uuid4().hex}")
                _rename(fs, dst, old)
                undo.append((fs, old, dst))
                olds.append((fs, old))
            _rename(fs, src, dst)
            undo.append((fs, dst, src))
    except Exception:
        for fs, now, before in reversed(undo):
            _rename(fs, now, before)
        raise
    for fs, old in olds:
        fs.delete(old, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

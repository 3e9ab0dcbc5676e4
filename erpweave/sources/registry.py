"""Where each system's extract of each table lives, and with which schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from erpweave.contracts import SOURCE_SCHEMAS
from erpweave.sources.audit import SourceAudit
from erpweave.sources.conform import conform
from erpweave.sources.damaged import DAMAGED, REJECTED, lanes, read_csv_raw
from erpweave.sources.readers import read_table


class Sources(Protocol):
    """Anything that can hand out one system's extract of one table."""

    systems: Sequence[str]

    def load(self, spark: SparkSession, system: str, table: str) -> DataFrame: ...


@dataclass(frozen=True)
class SystemLocation:
    """One source system: its directory and file prefix (e.g. ``data/system_1``, ``PRE``)."""

    root: str
    prefix: str
    fmt: str = "csv"


@dataclass
class SourceRegistry:
    """Files laid out as ``{root}/{prefix}_{table}.{fmt}`` per system.

    Extracts are read with declared schemas (by column name), so no inference pass runs
    and identifiers stay text. ``schemas`` may be extended, e.g. with another global
    material number column or additional plant fields.

    ``damaged`` says what becomes of CSV records whose cells do not match the header:
    ``"keep"`` (as Spark reads them: surplus cells cut, missing ones null), ``"drop"`` (left
    out of ``load``; ``rejected`` is the table of them) or ``"fail"`` (Spark's FAILFAST: the
    run stops at the first one). ``multi_line`` and ``escape`` go to the reader.
    """

    locations: dict[str, SystemLocation]
    schemas: dict[str, StructType] = field(default_factory=lambda: dict(SOURCE_SCHEMAS))
    template: str = "{root}/{prefix}_{table}.{fmt}"
    damaged: str = "keep"
    multi_line: bool | str = "detect"
    escape: str = "\\"

    def __post_init__(self) -> None:
        if self.damaged not in ("keep", "drop", "fail"):
            msg = f"damaged must be 'keep', 'drop' or 'fail', not {self.damaged!r}"
            raise ValueError(msg)

    @property
    def systems(self) -> list[str]:
        return list(self.locations)

    def path(self, system: str, table: str) -> str:
        loc = self.locations[system]
        return self.template.format(root=loc.root.rstrip("/"), prefix=loc.prefix, table=table, fmt=loc.fmt)

    def load(self, spark: SparkSession, system: str, table: str) -> DataFrame:
        loc, schema = self.locations[system], self.schemas.get(table)
        if loc.fmt == "csv" and schema is not None and self.damaged != "keep":
            raw = self._raw(spark, system, table)
            return conform(self._whole(raw), schema)
        return read_table(spark, self.path(system, table), loc.fmt, schema)

    def _raw(self, spark: SparkSession, system: str, table: str) -> DataFrame:
        return read_csv_raw(spark, self.path(system, table), self.multi_line, self.escape)

    def _whole(self, raw: DataFrame) -> DataFrame:
        """The undamaged records; in ``fail`` mode a damaged one stops the run."""
        if self.damaged == "fail":
            stop = F.raise_error(F.concat(F.lit("damaged record: "), F.col(DAMAGED)))
            return raw.filter(F.when(F.col(DAMAGED).isNull(), True).otherwise(stop.cast("boolean")))
        return raw.filter(F.col(DAMAGED).isNull()) if self.damaged == "drop" else raw

    def load_text(self, spark: SparkSession, system: str, table: str) -> DataFrame:
        """The extract as it lies, before any value is typed (undamaged CSV records as text)."""
        loc = self.locations[system]
        if loc.fmt != "csv":
            return spark.read.format(loc.fmt).load(self.path(system, table))
        return self._whole(self._raw(spark, system, table)).drop(DAMAGED)

    def load_audited(self, spark: SparkSession, system: str, table: str, audit: SourceAudit) -> DataFrame:
        """As ``load``, with damaged records and values that typing rejects counted on the way."""
        loc, schema = self.locations[system], self.schemas.get(table)
        if schema is None:
            return audit.watch(self.load(spark, system, table), system, table)
        if loc.fmt != "csv":
            df = spark.read.format(loc.fmt).load(self.path(system, table))
            return conform(audit.watch(df.select(*schema.fieldNames()), system, table, schema), schema)
        raw = self._raw(spark, system, table)
        watched = audit.watch(raw.select(*schema.fieldNames(), DAMAGED), system, table, schema)
        return conform(self._whole(watched), schema)

    def rejected(
        self, spark: SparkSession, tables: Sequence[str], bad_values: str = "null", date_formats: Sequence[str] = ()
    ) -> DataFrame:
        """system, table_name, file, record, reason and columns of the records that CSV extracts lose.

        With ``bad_values="reject"`` also the records of which a value does not fit its type.
        """
        frames = [
            lanes(self._raw(spark, system, table), self.schemas[table], bad_values, date_formats).rejected.select(
                F.lit(system).alias("system"), F.lit(table).alias("table_name"), "*"
            )
            for table in tables
            for system in self.systems
            if self.locations[system].fmt == "csv"
        ]
        if not frames:
            return spark.createDataFrame([], f"system string, table_name string, {REJECTED}")
        return reduce(DataFrame.unionByName, frames)


def load_all(spark: SparkSession, sources: Sources, tables: Sequence[str]) -> dict[str, dict[str, DataFrame]]:
    """``{table: {system: DataFrame}}`` for every system of ``sources`` (lazy, no jobs)."""
    return {table: {system: sources.load(spark, system, table) for system in sources.systems} for table in tables}

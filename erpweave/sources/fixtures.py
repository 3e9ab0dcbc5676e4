"""ERP-shaped extracts derived from the driver's TPC-H-like parquet tables.

Two source systems: a row belongs to ``SYS1`` (client ``100``) when its key is even and to
``SYS2`` (client ``200``) when odd. ``TpchErpSources.load(spark, system, table)`` returns
one system's extract, so pipelines read, prepare and union the systems exactly as they
would with real extracts; ``view(spark, table)`` returns all systems at once.

Every view is a projection (plus, for CDPOS, a filter) of a whole base table, so the work
of each pipeline grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the fixture: system name -> (client, parity of the deciding key).
SYSTEMS: dict[str, tuple[str, int]] = {"SYS1": ("100", 0), "SYS2": ("200", 1)}


def _system_of(key: str) -> str:
    return f"CASE WHEN {key} % 2 = 0 THEN 'SYS1' ELSE 'SYS2' END"


def _client_of(key: str) -> str:
    return f"CASE WHEN {key} % 2 = 0 THEN '100' ELSE '200' END"


def _prefixed(prefix: str, column: str) -> str:
    return f"concat('{prefix}', CAST({column} AS STRING))"


_DELETED_LINE = "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'X' END"

# Each view is one projection of a base table, written as Spark SQL expressions so the
# whole projection crosses to the JVM in one call.
_MARA = [
    f"{_system_of('p_partkey')} AS SOURCE_SYSTEM_ERP",
    f"{_client_of('p_partkey')} AS MANDT",
    "CAST(p_partkey AS STRING) AS MATNR",
    "CASE p_size % 3 WHEN 0 THEN 'EA' WHEN 1 THEN 'KG' ELSE 'PC' END AS MEINS",
    "CASE WHEN p_partkey % 5 <> 0 THEN concat('G', CAST(p_partkey % 500 AS STRING)) END AS ZZMDGM",
    "CASE p_size % 10 WHEN 0 THEN 'ARCHIVE' WHEN 1 THEN 'DUPLICATE' WHEN 2 THEN 'RENUMBERED' WHEN 3 THEN p_brand END"
    " AS BISMT",
    "CASE p_partkey % 11 WHEN 0 THEN 'X' WHEN 1 THEN '' WHEN 2 THEN ' ' END AS LVORM",
    "p_retailprice AS NTGEW",
    "p_type AS MTART",
]

_MARC = [
    f"{_system_of('l_partkey')} AS SOURCE_SYSTEM_ERP",
    "CAST(l_partkey AS STRING) AS MATNR",
    f"{_prefixed('W', 'l_suppkey')} AS WERKS",
    f"{_DELETED_LINE} AS LVORM",
]

_MBEW = [
    f"{_client_of('l_partkey')} AS MANDT",
    "CAST(l_partkey AS STRING) AS MATNR",
    f"{_prefixed('B', 'l_suppkey')} AS BWKEY",
    "CASE WHEN l_linestatus = 'F' THEN 'S' ELSE 'V' END AS VPRSV",
    "l_extendedprice AS VERPR",
    "l_quantity AS STPRS",
    "CAST(1.0 AS DOUBLE) AS PEINH",
    "l_returnflag AS BKLAS",
    f"{_DELETED_LINE} AS LVORM",
    "CASE WHEN l_linenumber = 7 THEN '001' END AS BWTAR",
    "CAST(l_shipdate AS DATE) AS LAEPR",
]


def _t001w(client: str) -> list[str]:
    return [
        f"'{client}' AS MANDT",
        f"{_prefixed('W', 's_suppkey')} AS WERKS",
        f"{_prefixed('B', 's_suppkey')} AS BWKEY",
        "s_name AS NAME1",
    ]


def _t001k(client: str) -> list[str]:
    return [f"'{client}' AS MANDT", f"{_prefixed('B', 's_suppkey')} AS BWKEY", f"{_prefixed('C', 's_nationkey')} AS BUKRS"]


def _t001(client: str) -> list[str]:
    return [
        f"'{client}' AS MANDT",
        f"{_prefixed('C', 'n_nationkey')} AS BUKRS",
        "CASE n_regionkey WHEN 1 THEN 'USD' WHEN 3 THEN 'EUR' ELSE 'CNY' END AS WAERS",
    ]


_DAY = "CAST(o_orderdate AS DATE)"

_AFKO = [
    f"{_system_of('o_orderkey')} AS SOURCE_SYSTEM_ERP",
    f"{_client_of('o_orderkey')} AS MANDT",
    "CAST(o_orderkey AS STRING) AS AUFNR",
    f"CASE WHEN o_orderkey % 17 <> 0 THEN date_add({_DAY}, 30) END AS GLTRP",
    f"CASE WHEN o_orderkey % 13 <> 0 THEN {_DAY} END AS GSTRP",
    f"date_add({_DAY}, 1) AS FTRMS",
    f"CASE WHEN o_orderstatus = 'F' THEN date_add({_DAY}, 28) END AS GLTRS",
    f"CASE WHEN o_orderstatus = 'F' THEN date_add({_DAY}, 3) END AS GSTRS",
    f"CASE WHEN o_orderkey % 7 <> 0 THEN date_add({_DAY}, 2) END AS GSTRI",
    f"CASE WHEN o_orderstatus <> 'O' THEN date_add({_DAY}, 25) END AS GETRI",
    f"CASE WHEN o_orderstatus = 'F' THEN date_add({_DAY}, 31) END AS GLTRI",
    f"date_add({_DAY}, 4) AS FTRMI",
    f"date_add({_DAY}, 29) AS FTRMP",
    "concat('D', CAST(o_custkey % 10 AS STRING)) AS DISPO",
    "concat('F', CAST(o_orderkey % 4 AS STRING)) AS FEVOR",
    "substring(o_orderpriority, 1, 1) AS PLGRP",
    "'000' AS FHORI",
    "CAST(o_orderkey * 10 AS STRING) AS AUFPL",
]

_AFPO = [
    "CAST(l_orderkey AS STRING) AS AUFNR",
    "CAST(l_linenumber AS STRING) AS POSNR",
    f"{_prefixed('W', 'l_suppkey')} AS DWERK",
    "CAST(l_partkey AS STRING) AS MATNR",
    "'EA' AS MEINS",
    f"CASE WHEN l_returnflag = 'N' THEN {_prefixed('S', 'l_orderkey')} END AS KDAUF",
    "CASE WHEN l_returnflag = 'N' THEN CAST(l_linenumber AS STRING) END AS KDPOS",
    "CASE WHEN NOT (l_linestatus = 'O' AND l_linenumber = 1) THEN CAST(l_shipdate AS DATE) END AS LTRMI",
]

_AUFK = [
    "CAST(o_orderkey AS STRING) AS AUFNR",
    f"{_prefixed('OBJ', 'o_orderkey')} AS OBJNR",
    f"{_DAY} AS ERDAT",
    f"{_prefixed('USER', 'o_custkey')} AS ERNAM",
    "o_orderpriority AS AUART",
    f"CASE WHEN o_orderkey % 3 <> 0 THEN date_add({_DAY}, 20) END AS ZZGLTRP_ORIG",
    "o_orderstatus AS ZZPRO_TEXT",
]

# Change items: one per order that left the open status.
_CDPOS = [
    f"{_prefixed('OBJ', 'o_orderkey')} AS OBJNR",
    "CASE WHEN o_orderstatus = 'F' THEN 'U' ELSE 'I' END AS CHNGIND",
    "o_orderpriority AS VALUE_NEW",
]


def _projection(columns: list[str], where: str | None = None) -> Callable[[DataFrame], DataFrame]:
    def build(base: DataFrame) -> DataFrame:
        return (base.filter(where) if where else base).selectExpr(*columns)

    return build


def _per_client(columns: Callable[[str], list[str]]) -> Callable[[DataFrame, str], DataFrame]:
    def build(base: DataFrame, client: str) -> DataFrame:
        return base.selectExpr(*columns(client))

    return build


@dataclass(frozen=True)
class _View:
    base: str
    build: Callable[..., DataFrame]
    # Column of the base table whose parity decides the system; None = one copy per client.
    system_key: str | None


VIEWS: dict[str, _View] = {
    "MARA": _View("part", _projection(_MARA), "p_partkey"),
    "MARC": _View("lineitem", _projection(_MARC), "l_partkey"),
    "MBEW": _View("lineitem", _projection(_MBEW), "l_partkey"),
    "T001W": _View("supplier", _per_client(_t001w), None),
    "T001K": _View("supplier", _per_client(_t001k), None),
    "T001": _View("nation", _per_client(_t001), None),
    "AFKO": _View("orders", _projection(_AFKO), "o_orderkey"),
    "AFPO": _View("lineitem", _projection(_AFPO), "l_orderkey"),
    "AUFK": _View("orders", _projection(_AUFK), "o_orderkey"),
    "CDPOS": _View("orders", _projection(_CDPOS, "o_orderstatus <> 'O'"), "o_orderkey"),
}


@dataclass
class TpchErpSources:
    """ERP extracts of two systems over the parquet tables in ``sf_dir``."""

    sf_dir: str
    systems: list[str] = field(default_factory=lambda: list(SYSTEMS))
    _tables: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def base(self, spark: SparkSession, name: str) -> DataFrame:
        """The base table, read once per sources object (each read lists the file and
        reads its footer; the systems' extracts then share the one relation)."""
        if name not in self._tables:
            self._tables[name] = spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        return self._tables[name]

    def load(self, spark: SparkSession, system: str, table: str) -> DataFrame:
        view = VIEWS[table]
        client, parity = SYSTEMS[system]
        base = self.base(spark, view.base)
        if view.system_key is None:
            return view.build(base, client)
        return view.build(base.filter(f"{view.system_key} % 2 = {parity}"))

    def view(self, spark: SparkSession, table: str) -> DataFrame:
        """All systems of one table (no split)."""
        view = VIEWS[table]
        base = self.base(spark, view.base)
        if view.system_key is None:
            frames = [view.build(base, client) for client, _ in SYSTEMS.values()]
            out = frames[0]
            for frame in frames[1:]:
                out = out.unionByName(frame)
            return out
        return view.build(base)


# Per table of the overlapping fixture: the expression of the numeric key, and the modulus of
# the keys that both systems deliver.
OVERLAP: dict[str, tuple[str, int]] = {
    "MARA": ("CAST(MATNR AS BIGINT)", 3),
    "MARC": ("CAST(MATNR AS BIGINT)", 3),
    "MBEW": ("CAST(MATNR AS BIGINT)", 3),
    "T001W": ("CAST(substring(WERKS, 2) AS BIGINT)", 3),
    "T001K": ("CAST(substring(BWKEY, 2) AS BIGINT)", 3),
    "T001": ("CAST(substring(BUKRS, 2) AS BIGINT)", 3),
    "AFKO": ("CAST(AUFNR AS BIGINT)", 7),
    "AFPO": ("CAST(AUFNR AS BIGINT)", 7),
    "AUFK": ("CAST(AUFNR AS BIGINT)", 7),
    "CDPOS": ("CAST(substring(OBJNR, 4) AS BIGINT)", 7),
}


@dataclass
class OverlappingErpSources:
    """Two systems that share one client and many numbers, as the shipped extracts do.

    Besides the keys of its parity a system delivers every key divisible by the table's
    modulus. A row of the other parity is marked as that system's own version (unit ``BOX``,
    global number prefix ``X``, plant name suffix, price plus one). MARA holds a second copy of
    every material divisible by 15, T001K every row twice where its number is even, CDPOS a
    second change for every order divisible by 5; the second system delivers LAEPR as text.
    """

    sf_dir: str
    systems: list[str] = field(default_factory=lambda: list(SYSTEMS))

    def __post_init__(self) -> None:
        self.inner = TpchErpSources(self.sf_dir)

    def load(self, spark: SparkSession, system: str, table: str) -> DataFrame:
        _, parity = SYSTEMS[system]
        key, both = OVERLAP[table]
        rows = self.inner.view(spark, table)
        if VIEWS[table].system_key is None:
            rows = rows.filter("MANDT = '100'")
        rows = rows.filter(f"{key} % 2 = {parity} OR {key} % {both} = 0")
        other = f"{key} % 2 <> {parity}"
        changes = {"MANDT": "'100'", "SOURCE_SYSTEM_ERP": f"'{system}'"}
        if table == "MARA":
            changes |= {"MEINS": f"CASE WHEN {other} THEN 'BOX' ELSE MEINS END", "ZZMDGM": f"CASE WHEN {other} THEN concat('X', ZZMDGM) ELSE ZZMDGM END"}
        elif table == "MBEW":
            changes["VERPR"] = f"CASE WHEN {other} THEN VERPR + 1 ELSE VERPR END"
            if parity:
                changes["LAEPR"] = "date_format(LAEPR, 'dd.MM.yyyy')"
        elif table == "T001W":
            changes["NAME1"] = f"CASE WHEN {other} THEN concat(NAME1, ' II') ELSE NAME1 END"
        rows = rows.selectExpr(*[f"{changes[c]} AS {c}" if c in changes else c for c in rows.columns])
        if table == "MARA":
            rows = rows.unionByName(rows.filter(f"{key} % 15 = 0").selectExpr(*["'PAL' AS MEINS" if c == "MEINS" else c for c in rows.columns]))
        elif table == "T001K":
            rows = rows.unionByName(rows.filter(f"{key} % 2 = 0"))
        elif table == "CDPOS":
            rows = rows.unionByName(rows.filter(f"{key} % 5 = 0").selectExpr("OBJNR", "'D' AS CHNGIND", "CAST(NULL AS STRING) AS VALUE_NEW"))
        return rows

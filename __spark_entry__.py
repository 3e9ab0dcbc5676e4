"""


The Spark side is ``erpweave.plans.catalog``: the library's operators over ERP-shaped
extracts that ``erpweave.sources.fixtures`` derives from the driver's tables (two source
systems split by key parity). The oracle below restates the same fixture views and
operators as plain SQL over the raw tables, written independently of the Spark code.
"""

from __future__ import annotations

import importlib.util
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from erpweave.plans.catalog import QUERIES

# The training-data subpackage and its pipeline are optional: without them the rest still works.
_HAS_LLM = importlib.util.find_spec("erpweave.llm") is not None
_HAS_PIPELINE = _HAS_LLM and importlib.util.find_spec("corpus_pipeline") is not None

FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return QUERIES["process_order_final"](spark, FLAGSHIP_SF_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(QUERIES)
    if _HAS_LLM:
        from erpweave.llm.queries import QUERIES as LLM_QUERIES

        found.update(LLM_QUERIES)
    if _HAS_PIPELINE:
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
    return found


# ---------------------------------------------------------------------------------------
# Oracle: fixture views and pipeline steps as named SQL blocks. A block may use any other
# block by name; ``_sql`` prepends the blocks a statement needs as a WITH list.
# ---------------------------------------------------------------------------------------

_SYS = "CASE WHEN {k} % 2 = 0 THEN 'SYS1' ELSE 'SYS2' END"
_CLIENT = "CASE WHEN {k} % 2 = 0 THEN '100' ELSE '200' END"
_RETIRED = "('ARCHIVE', 'DUPLICATE', 'RENUMBERED')"
_AS_OF = "DATE '2024-06-15'"


def _per_client(select: str) -> str:
    return " UNION ALL ".join(select.format(client=c) for c in ("100", "200"))


_BLOCKS: dict[str, str] = {
    # --- fixture views over the raw tables ---
    "mara": f"""
        SELECT {_SYS.format(k="p_partkey")} AS SOURCE_SYSTEM_ERP,
               {_CLIENT.format(k="p_partkey")} AS MANDT,
               CAST(p_partkey AS VARCHAR) AS MATNR,
               CASE WHEN p_size % 3 = 0 THEN 'EA' WHEN p_size % 3 = 1 THEN 'KG' ELSE 'PC' END AS MEINS,
               CASE WHEN p_partkey % 5 <> 0 THEN 'G' || CAST(p_partkey % 500 AS VARCHAR) END AS ZZMDGM,
               CASE WHEN p_size % 10 = 0 THEN 'ARCHIVE' WHEN p_size % 10 = 1 THEN 'DUPLICATE'
                    WHEN p_size % 10 = 2 THEN 'RENUMBERED' WHEN p_size % 10 = 3 THEN p_brand END AS BISMT,
               CASE WHEN p_partkey % 11 = 0 THEN 'X' WHEN p_partkey % 11 = 1 THEN ''
                    WHEN p_partkey % 11 = 2 THEN ' ' END AS LVORM,
               p_retailprice AS NTGEW,
               p_type AS MTART
        FROM part""",
    "marc": f"""
        SELECT {_SYS.format(k="l_partkey")} AS SOURCE_SYSTEM_ERP,
               CAST(l_partkey AS VARCHAR) AS MATNR,
               'W' || CAST(l_suppkey AS VARCHAR) AS WERKS,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'X' END AS LVORM
        FROM lineitem""",
    "mbew": f"""
        SELECT {_CLIENT.format(k="l_partkey")} AS MANDT,
               CAST(l_partkey AS VARCHAR) AS MATNR,
               'B' || CAST(l_suppkey AS VARCHAR) AS BWKEY,
               CASE WHEN l_linestatus = 'F' THEN 'S' ELSE 'V' END AS VPRSV,
               l_extendedprice AS VERPR,
               l_quantity AS STPRS,
               CAST(1.0 AS DOUBLE) AS PEINH,
               l_returnflag AS BKLAS,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'X' END AS LVORM,
               CASE WHEN l_linenumber = 7 THEN '001' END AS BWTAR,
               CAST(l_shipdate AS DATE) AS LAEPR
        FROM lineitem""",
    "t001w": _per_client(
        "SELECT '{client}' AS MANDT, 'W' || CAST(s_suppkey AS VARCHAR) AS WERKS, "
        "'B' || CAST(s_suppkey AS VARCHAR) AS BWKEY, s_name AS NAME1 FROM supplier"
    ),
    "t001k": _per_client(
        "SELECT '{client}' AS MANDT, 'B' || CAST(s_suppkey AS VARCHAR) AS BWKEY, "
        "'C' || CAST(s_nationkey AS VARCHAR) AS BUKRS FROM supplier"
    ),
    "t001": _per_client(
        "SELECT '{client}' AS MANDT, 'C' || CAST(n_nationkey AS VARCHAR) AS BUKRS, "
        "CASE WHEN n_regionkey = 1 THEN 'USD' WHEN n_regionkey = 3 THEN 'EUR' ELSE 'CNY' END AS WAERS FROM nation"
    ),
    "afko": f"""
        SELECT {_SYS.format(k="o_orderkey")} AS SOURCE_SYSTEM_ERP,
               {_CLIENT.format(k="o_orderkey")} AS MANDT,
               CAST(o_orderkey AS VARCHAR) AS AUFNR,
               CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) + 30 END AS GLTRP,
               CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS GSTRP,
               CAST(o_orderdate AS DATE) + 1 AS FTRMS,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 28 END AS GLTRS,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 3 END AS GSTRS,
               CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) + 2 END AS GSTRI,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 25 END AS GETRI,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 31 END AS GLTRI,
               CAST(o_orderdate AS DATE) + 4 AS FTRMI,
               CAST(o_orderdate AS DATE) + 29 AS FTRMP,
               'D' || CAST(o_custkey % 10 AS VARCHAR) AS DISPO,
               'F' || CAST(o_orderkey % 4 AS VARCHAR) AS FEVOR,
               substr(o_orderpriority, 1, 1) AS PLGRP,
               '000' AS FHORI,
               CAST(o_orderkey * 10 AS VARCHAR) AS AUFPL
        FROM orders""",
    "afpo": """
        SELECT CAST(l_orderkey AS VARCHAR) AS AUFNR,
               CAST(l_linenumber AS VARCHAR) AS POSNR,
               'W' || CAST(l_suppkey AS VARCHAR) AS DWERK,
               CAST(l_partkey AS VARCHAR) AS MATNR,
               'EA' AS MEINS,
               CASE WHEN l_returnflag = 'N' THEN 'S' || CAST(l_orderkey AS VARCHAR) END AS KDAUF,
               CASE WHEN l_returnflag = 'N' THEN CAST(l_linenumber AS VARCHAR) END AS KDPOS,
               CASE WHEN NOT (l_linestatus = 'O' AND l_linenumber = 1) THEN CAST(l_shipdate AS DATE) END AS LTRMI
        FROM lineitem""",
    "aufk": """
        SELECT CAST(o_orderkey AS VARCHAR) AS AUFNR,
               'OBJ' || CAST(o_orderkey AS VARCHAR) AS OBJNR,
               CAST(o_orderdate AS DATE) AS ERDAT,
               'USER' || CAST(o_custkey AS VARCHAR) AS ERNAM,
               o_orderpriority AS AUART,
               CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 20 END AS ZZGLTRP_ORIG,
               o_orderstatus AS ZZPRO_TEXT
        FROM orders""",
    "cdpos": """
        SELECT 'OBJ' || CAST(o_orderkey AS VARCHAR) AS OBJNR,
               CASE WHEN o_orderstatus = 'F' THEN 'U' ELSE 'I' END AS CHNGIND,
               o_orderpriority AS VALUE_NEW
        FROM orders WHERE o_orderstatus <> 'O'""",
    # --- prepared tables ---
    "mara_p": f"""
        SELECT MANDT, MATNR, MEINS, ZZMDGM AS GLOBAL_MATERIAL_NUMBER FROM mara
        WHERE (BISMT IS NULL OR BISMT NOT IN {_RETIRED}) AND (LVORM IS NULL OR trim(LVORM) = '')""",
    "mbew_p": """
        SELECT DISTINCT MANDT, MATNR, BWKEY, VPRSV, VERPR, STPRS, PEINH, BKLAS FROM (
            SELECT *, row_number() OVER (
                PARTITION BY MATNR, BWKEY
                ORDER BY LAEPR DESC NULLS LAST, VERPR DESC NULLS LAST, STPRS DESC NULLS LAST,
                         VPRSV ASC NULLS LAST, BKLAS ASC NULLS LAST, PEINH DESC NULLS LAST, MANDT ASC NULLS LAST
            ) AS rn
            FROM mbew WHERE LVORM IS NULL AND BWTAR IS NULL
        ) WHERE rn = 1""",
    "marc_p": "SELECT DISTINCT SOURCE_SYSTEM_ERP, MATNR, WERKS FROM marc WHERE LVORM IS NULL",
    "t001w_p": "SELECT MANDT, WERKS, BWKEY, NAME1 FROM t001w",
    "t001k_p": "SELECT DISTINCT MANDT, BWKEY, BUKRS FROM t001k",
    "t001_p": "SELECT MANDT, BUKRS, WAERS FROM t001",
    "afko_p": f"""
        SELECT SOURCE_SYSTEM_ERP, MANDT, AUFNR, GLTRP, GSTRP, FTRMS, GLTRS, GSTRS, GSTRI, GETRI, GLTRI,
               FTRMI, FTRMP, DISPO, FEVOR, PLGRP, FHORI, AUFPL,
               CAST(date_trunc('month', coalesce(GSTRP, {_AS_OF})) AS DATE) AS start_date,
               CAST(date_trunc('month', coalesce(GLTRP, {_AS_OF})) AS DATE) AS finish_date
        FROM afko""",
    "afpo_p": "SELECT AUFNR, POSNR, DWERK, MATNR, MEINS, KDAUF, KDPOS, LTRMI FROM afpo",
    "aufk_p": "SELECT AUFNR, OBJNR, ERDAT, ERNAM, AUART, ZZGLTRP_ORIG, ZZPRO_TEXT FROM aufk",
    "mara_o": f"""
        SELECT MATNR, ZZMDGM AS GLOBAL_MATERIAL_NUMBER, NTGEW, MTART FROM mara
        WHERE (BISMT IS NULL OR BISMT NOT IN {_RETIRED}) AND (LVORM IS NULL OR trim(LVORM) = '')""",
    # --- local material ---
    "j1": """
        SELECT c.MATNR, c.SOURCE_SYSTEM_ERP, c.WERKS, a.MANDT, a.MEINS, a.GLOBAL_MATERIAL_NUMBER
        FROM marc_p c LEFT JOIN mara_p a ON c.MATNR = a.MATNR""",
    "j2": """
        SELECT j.MANDT, j.WERKS, j.MATNR, j.SOURCE_SYSTEM_ERP, j.MEINS, j.GLOBAL_MATERIAL_NUMBER, w.BWKEY, w.NAME1
        FROM j1 j LEFT JOIN t001w_p w ON j.MANDT = w.MANDT AND j.WERKS = w.WERKS""",
    "j3": """
        SELECT j.*, v.VPRSV, v.VERPR, v.STPRS, v.PEINH, v.BKLAS
        FROM j2 j LEFT JOIN mbew_p v ON j.MANDT = v.MANDT AND j.MATNR = v.MATNR AND j.BWKEY = v.BWKEY""",
    "j4": """
        SELECT j.*, k.BUKRS
        FROM j3 j LEFT JOIN t001k_p k ON j.MANDT = k.MANDT AND j.BWKEY = k.BWKEY""",
    "lm_joined": """
        SELECT j.MANDT, j.SOURCE_SYSTEM_ERP, j.MATNR, j.WERKS, j.MEINS, j.GLOBAL_MATERIAL_NUMBER, j.BWKEY,
               j.NAME1, j.VPRSV, j.VERPR, j.STPRS, j.PEINH, j.BKLAS, j.BUKRS, t.WAERS
        FROM j4 j LEFT JOIN t001_p t ON j.MANDT = t.MANDT AND j.BUKRS = t.BUKRS""",
    "lm_derived": """
        SELECT *,
               concat_ws('-', coalesce(MATNR, ''), coalesce(WERKS, '')) AS primary_key_intra,
               concat_ws('-', coalesce(SOURCE_SYSTEM_ERP, ''), coalesce(MATNR, ''), coalesce(WERKS, ''))
                   AS primary_key_inter,
               concat_ws('-', WERKS, NAME1) AS mtl_plant_emd,
               coalesce(GLOBAL_MATERIAL_NUMBER, MATNR) AS global_mtl_id,
               count(*) OVER (PARTITION BY SOURCE_SYSTEM_ERP, MATNR, WERKS) AS no_of_duplicates,
               row_number() OVER (
                   PARTITION BY SOURCE_SYSTEM_ERP, MATNR, WERKS
                   ORDER BY MANDT ASC NULLS LAST, BWKEY ASC NULLS LAST, BUKRS ASC NULLS LAST,
                            MEINS ASC NULLS LAST, GLOBAL_MATERIAL_NUMBER ASC NULLS LAST, NAME1 ASC NULLS LAST,
                            VPRSV ASC NULLS LAST, VERPR ASC NULLS LAST, STPRS ASC NULLS LAST,
                            PEINH ASC NULLS LAST, BKLAS ASC NULLS LAST, WAERS ASC NULLS LAST
               ) AS rn
        FROM lm_joined""",
    "lm_post": """
        SELECT MANDT, SOURCE_SYSTEM_ERP, MATNR, WERKS, MEINS, GLOBAL_MATERIAL_NUMBER, BWKEY, NAME1, VPRSV,
               VERPR, STPRS, PEINH, BKLAS, BUKRS, WAERS, primary_key_intra, primary_key_inter,
               mtl_plant_emd, global_mtl_id
        FROM lm_derived WHERE rn = 1""",
    "lm": """
        SELECT * REPLACE (sha256(GLOBAL_MATERIAL_NUMBER) AS GLOBAL_MATERIAL_NUMBER, sha256(NAME1) AS NAME1,
                          sha256(BUKRS) AS BUKRS, sha256(mtl_plant_emd) AS mtl_plant_emd, sha256(MATNR) AS MATNR)
        FROM lm_post""",
    # --- process order ---
    "po_j1": """
        SELECT h.AUFNR, h.SOURCE_SYSTEM_ERP, h.MANDT, h.GLTRP, h.GSTRP, h.FTRMS, h.GLTRS, h.GSTRS, h.GSTRI,
               h.GETRI, h.GLTRI, h.FTRMI, h.FTRMP, h.DISPO, h.FEVOR, h.PLGRP, h.FHORI, h.AUFPL, h.start_date,
               h.finish_date, i.POSNR, i.DWERK, i.MATNR, i.MEINS, i.KDAUF, i.KDPOS, i.LTRMI
        FROM afko_p h LEFT JOIN afpo_p i ON h.AUFNR = i.AUFNR""",
    "po_j2": """
        SELECT j.*, m.OBJNR, m.ERDAT, m.ERNAM, m.AUART, m.ZZGLTRP_ORIG, m.ZZPRO_TEXT
        FROM po_j1 j LEFT JOIN aufk_p m ON j.AUFNR = m.AUFNR""",
    "po_joined": """
        SELECT j.* REPLACE (coalesce(j.ZZGLTRP_ORIG, j.GLTRP) AS ZZGLTRP_ORIG),
               g.GLOBAL_MATERIAL_NUMBER, g.NTGEW, g.MTART
        FROM po_j2 j LEFT JOIN mara_o g ON j.MATNR = g.MATNR""",
    "po_post": """
        SELECT *,
               concat_ws('_', AUFNR, POSNR, DWERK) AS primary_key_intra,
               concat_ws('_', SOURCE_SYSTEM_ERP, AUFNR, POSNR, DWERK) AS primary_key_inter,
               CASE WHEN ZZGLTRP_ORIG IS NOT NULL AND LTRMI IS NOT NULL
                    THEN CASE WHEN ZZGLTRP_ORIG >= LTRMI THEN 1 ELSE 0 END END AS on_time_flag,
               CAST(date_diff('day', LTRMI, ZZGLTRP_ORIG) AS DOUBLE) AS actual_on_time_deviation,
               CASE WHEN date_diff('day', LTRMI, ZZGLTRP_ORIG) <= 0 THEN 'On Time'
                    WHEN date_diff('day', LTRMI, ZZGLTRP_ORIG) BETWEEN 1 AND 7 THEN '1-7 Days Late'
                    WHEN date_diff('day', LTRMI, ZZGLTRP_ORIG) BETWEEN 8 AND 14 THEN '8-14 Days Late'
                    WHEN date_diff('day', LTRMI, ZZGLTRP_ORIG) > 14 THEN '>14 Days Late'
                    ELSE 'Unknown' END AS late_delivery_bucket,
               CASE WHEN KDAUF IS NOT NULL THEN 'MTO' ELSE 'MTS' END AS mto_vs_mts_flag,
               CAST(LTRMI AS TIMESTAMP) AS order_finish_timestamp,
               CAST(GSTRI AS TIMESTAMP) AS order_start_timestamp
        FROM po_joined""",
    "po": """
        SELECT * REPLACE (sha256(AUFNR) AS AUFNR, sha256(MATNR) AS MATNR, sha256(KDPOS) AS KDPOS,
                          sha256(KDAUF) AS KDAUF, sha256(ERNAM) AS ERNAM, sha256(OBJNR) AS OBJNR)
        FROM po_post""",
}



def _overlap(view: str, columns: str, key: str, both: int, extra: str = "", client: str = "") -> str:
    """One view of the overlapping fixture: every system's own parity plus the shared keys."""
    where = f" WHERE {client}" if client else ""
    base = f"SELECT {columns} FROM (SELECT *, {key} AS k FROM {view}{where}) r JOIN osys y ON k % 2 = y.p OR k % {both} = 0"
    return base + (f" UNION ALL SELECT {extra}" if extra else "")


_K_MATNR, _K_AUFNR = "CAST(MATNR AS BIGINT)", "CAST(AUFNR AS BIGINT)"
_O_MARA = (
    "y.s AS sys, '100' AS MANDT, MATNR, {unit} AS MEINS, CASE WHEN k % 2 <> y.p THEN 'X' || ZZMDGM ELSE ZZMDGM END AS ZZMDGM, "
    "BISMT, LVORM, NTGEW, MTART"
)
_BLOCKS["osys"] = "SELECT 'SYS1' AS s, 0 AS p UNION ALL SELECT 'SYS2' AS s, 1 AS p"
_BLOCKS["o_mara"] = (
    _overlap("mara", _O_MARA.format(unit="CASE WHEN k % 2 <> y.p THEN 'BOX' ELSE MEINS END"), _K_MATNR, 3)
    + f" UNION ALL SELECT * FROM ({_overlap('mara', _O_MARA.format(unit=chr(39) + 'PAL' + chr(39)), _K_MATNR, 3)} ) WHERE CAST(MATNR AS BIGINT) % 15 = 0"
)
_O_VALID = f"(BISMT IS NULL OR BISMT NOT IN {_RETIRED}) AND (LVORM IS NULL OR trim(LVORM) = '')"
_BLOCKS["o_mara_p"] = f"SELECT sys, MANDT, MATNR, MEINS, ZZMDGM AS GLOBAL_MATERIAL_NUMBER, NTGEW, MTART FROM o_mara WHERE {_O_VALID}"
_BLOCKS["o_marc_p"] = (
    f"SELECT DISTINCT y.s AS SOURCE_SYSTEM_ERP, MATNR, WERKS FROM (SELECT *, {_K_MATNR} AS k FROM marc) r "
    "JOIN osys y ON k % 2 = y.p OR k % 3 = 0 WHERE LVORM IS NULL"
)
_BLOCKS["o_mbew"] = _overlap(
    "mbew",
    "y.s AS sys, '100' AS MANDT, MATNR, BWKEY, VPRSV, CASE WHEN k % 2 <> y.p THEN VERPR + 1 ELSE VERPR END AS VERPR, STPRS, PEINH, "
    "BKLAS, LVORM, BWTAR, LAEPR",
    _K_MATNR, 3,
)
_BLOCKS["o_mbew_p"] = """
    SELECT sys, MANDT, MATNR, BWKEY, VPRSV, VERPR, STPRS, PEINH, BKLAS FROM (
        SELECT *, row_number() OVER (
            PARTITION BY sys, MATNR, BWKEY
            ORDER BY LAEPR DESC NULLS LAST, VERPR DESC NULLS LAST, STPRS DESC NULLS LAST, VPRSV ASC NULLS LAST,
                     BKLAS ASC NULLS LAST, PEINH DESC NULLS LAST, MANDT ASC NULLS LAST) AS rn
        FROM o_mbew WHERE LVORM IS NULL AND BWTAR IS NULL) WHERE rn = 1"""
_BLOCKS["o_t001w_p"] = _overlap(
    "t001w", "y.s AS sys, MANDT, WERKS, BWKEY, CASE WHEN k % 2 <> y.p THEN NAME1 || ' II' ELSE NAME1 END AS NAME1",
    "CAST(substr(WERKS, 2) AS BIGINT)", 3, client="MANDT = '100'",
)
_BLOCKS["o_t001k_p"] = _overlap(
    "t001k", "DISTINCT y.s AS sys, MANDT, BWKEY, BUKRS", "CAST(substr(BWKEY, 2) AS BIGINT)", 3, client="MANDT = '100'"
)
_BLOCKS["o_t001_p"] = _overlap(
    "t001", "y.s AS sys, MANDT, BUKRS, WAERS", "CAST(substr(BUKRS, 2) AS BIGINT)", 3, client="MANDT = '100'"
)


def _overlap_joined(isolated: bool) -> str:
    own = lambda alias: f" AND {alias}.sys = c.SOURCE_SYSTEM_ERP" if isolated else ""
    foreign = " + ".join(f"coalesce(({a}.sys <> c.SOURCE_SYSTEM_ERP)::INT, 0)" for a in ("a", "w", "v", "k", "t"))
    return f"""
        SELECT a.MANDT, c.SOURCE_SYSTEM_ERP, c.MATNR, c.WERKS, a.MEINS, a.GLOBAL_MATERIAL_NUMBER, w.BWKEY, w.NAME1,
               v.VPRSV, v.VERPR, v.STPRS, v.PEINH, v.BKLAS, k.BUKRS, t.WAERS, {foreign} AS far
        FROM o_marc_p c
        LEFT JOIN o_mara_p a ON a.MATNR = c.MATNR{own('a')}
        LEFT JOIN o_t001w_p w ON w.MANDT = a.MANDT AND w.WERKS = c.WERKS{own('w')}
        LEFT JOIN o_mbew_p v ON v.MANDT = a.MANDT AND v.MATNR = c.MATNR AND v.BWKEY = w.BWKEY{own('v')}
        LEFT JOIN o_t001k_p k ON k.MANDT = a.MANDT AND k.BWKEY = w.BWKEY{own('k')}
        LEFT JOIN o_t001_p t ON t.MANDT = a.MANDT AND t.BUKRS = k.BUKRS{own('t')}"""


def _overlap_final(joined: str) -> str:
    derived = _BLOCKS["lm_derived"].replace("FROM lm_joined", f"FROM {joined}").replace("ORDER BY MANDT", "ORDER BY far, MANDT")
    return derived


_BLOCKS["o_joined"] = _overlap_joined(False)
_BLOCKS["o_joined_own"] = _overlap_joined(True)
_BLOCKS["o_derived"] = _overlap_final("o_joined")
_BLOCKS["o_derived_own"] = _overlap_final("o_joined_own")
_MASKED = """* EXCLUDE (far, rn{more}) REPLACE (sha256(GLOBAL_MATERIAL_NUMBER) AS GLOBAL_MATERIAL_NUMBER, sha256(NAME1) AS NAME1,
    sha256(BUKRS) AS BUKRS, sha256(mtl_plant_emd) AS mtl_plant_emd, sha256(MATNR) AS MATNR)"""
# Orders: headers, items, masters and changes of both systems.
_BLOCKS["o_afko_p"] = f"""
    SELECT r.* EXCLUDE (k) REPLACE (y.s AS SOURCE_SYSTEM_ERP, '100' AS MANDT)
    FROM (SELECT *, {_K_AUFNR} AS k FROM afko_p) r JOIN osys y ON k % 2 = y.p OR k % 7 = 0"""
_BLOCKS["o_afpo_p"] = f"""
    SELECT y.s AS sys, r.* EXCLUDE (k) FROM (SELECT *, {_K_AUFNR} AS k FROM afpo_p) r JOIN osys y ON k % 2 = y.p OR k % 7 = 0"""
_BLOCKS["o_aufk_p"] = f"""
    SELECT y.s AS sys, r.* EXCLUDE (k) FROM (SELECT *, {_K_AUFNR} AS k FROM aufk_p) r JOIN osys y ON k % 2 = y.p OR k % 7 = 0"""
_BLOCKS["o_cdpos"] = """
    WITH one AS (SELECT r.OBJNR, r.CHNGIND, r.VALUE_NEW, k FROM (SELECT *, CAST(substr(OBJNR, 4) AS BIGINT) AS k FROM cdpos) r
                 JOIN osys y ON k % 2 = y.p OR k % 7 = 0)
    SELECT OBJNR, CHNGIND, VALUE_NEW FROM one UNION ALL SELECT OBJNR, 'D' AS CHNGIND, NULL AS VALUE_NEW FROM one WHERE k % 5 = 0"""


def _overlap_orders(isolated: bool) -> str:
    own = lambda alias: f" AND {alias}.sys = h.SOURCE_SYSTEM_ERP" if isolated else ""
    return f"""
        SELECT h.*, i.POSNR, i.DWERK, i.MATNR, i.MEINS, i.KDAUF, i.KDPOS, i.LTRMI, m.OBJNR, m.ERDAT, m.ERNAM, m.AUART,
               coalesce(m.ZZGLTRP_ORIG, h.GLTRP) AS ZZGLTRP_ORIG, m.ZZPRO_TEXT, g.GLOBAL_MATERIAL_NUMBER, g.NTGEW, g.MTART
        FROM o_afko_p h
        LEFT JOIN o_aufk_p m ON m.AUFNR = h.AUFNR{own('m')}
        LEFT JOIN o_afpo_p i ON i.AUFNR = h.AUFNR{own('i')}
        LEFT JOIN o_mara_p g ON g.MATNR = i.MATNR{own('g')}"""


_BLOCKS["o_orders"] = _overlap_orders(False)
_BLOCKS["o_orders_own"] = _overlap_orders(True)
_BLOCKS["o_orders_post"] = _BLOCKS["po_post"].replace("FROM po_joined", "FROM o_orders_own")

_LM_RENAME = """
    MANDT AS client, SOURCE_SYSTEM_ERP AS source_system_erp, MATNR AS material_number, WERKS AS plant,
    MEINS AS base_unit_of_measure, GLOBAL_MATERIAL_NUMBER AS global_material_number, BWKEY AS valuation_area,
    NAME1 AS branch_name, VPRSV AS price_control_indicator, VERPR AS moving_average_price,
    STPRS AS standard_price, PEINH AS price_unit, BKLAS AS valuation_class, BUKRS AS company_code,
    WAERS AS currency_key, primary_key_intra, primary_key_inter, mtl_plant_emd, global_mtl_id"""

_PO_RENAME = """
    MATNR AS material_number, AUFNR AS order_number, SOURCE_SYSTEM_ERP AS source_system_erp, MANDT AS client,
    GLTRP AS planned_start_date, GSTRP AS planned_finish_date, FTRMS AS scheduled_start_date,
    GLTRS AS actual_start_date, GSTRS AS actual_finish_date, GSTRI AS planned_start_date_internal,
    GETRI AS planned_finish_date_internal, GLTRI AS actual_start_date_internal,
    FTRMI AS scheduled_start_date_internal, FTRMP AS scheduled_finish_date_internal, DISPO AS mrp_controller,
    FEVOR AS production_supervisor, PLGRP AS planner_group, FHORI AS scheduling_direction,
    AUFPL AS routing_number, start_date, finish_date, POSNR AS item_number, DWERK AS plant,
    MEINS AS base_unit_of_measure, KDAUF AS sales_order, KDPOS AS sales_order_item,
    LTRMI AS requested_delivery_date, OBJNR AS object_number, ERDAT AS creation_date, ERNAM AS created_by,
    AUART AS order_type, ZZGLTRP_ORIG AS original_planned_start_date, ZZPRO_TEXT AS production_order_text,
    GLOBAL_MATERIAL_NUMBER AS global_material_number, NTGEW AS net_weight, MTART AS material_type,
    primary_key_intra, primary_key_inter, on_time_flag, actual_on_time_deviation, late_delivery_bucket,
    mto_vs_mts_flag, order_finish_timestamp, order_start_timestamp"""


def _profile_sql(view: str, columns: list[tuple[str, bool]]) -> str:
    parts = []
    for name, numeric in columns:
        if numeric:
            stats = (
                f"round(avg({name}), 4) AS mean, round(stddev_samp({name}), 4) AS stddev, "
                f"CAST(CAST(min({name}) AS DECIMAL(38,6)) AS VARCHAR) AS min_value, "
                f"CAST(CAST(max({name}) AS DECIMAL(38,6)) AS VARCHAR) AS max_value"
            )
        else:
            stats = (
                "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, "
                f"CAST(min({name}) AS VARCHAR) AS min_value, CAST(max({name}) AS VARCHAR) AS max_value"
            )
        parts.append(
            f"SELECT '{name}' AS column_name, count({name}) AS non_null, "
            f"count(*) - count({name}) AS nulls, {stats} FROM {view}"
        )
    return " UNION ALL ".join(parts)


def _key_violations_sql(view: str) -> str:
    return f"""
        WITH kv AS (
            SELECT 'primary_key_intra' AS column_name, primary_key_intra AS value FROM {view}
            UNION ALL SELECT 'primary_key_inter', primary_key_inter FROM {view}
        ), pv AS (SELECT column_name, value, count(*) AS n FROM kv GROUP BY column_name, value)
        SELECT column_name,
               CAST(count(*) AS BIGINT) AS distinct_values,
               CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicated_values,
               CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicated_rows,
               CAST(sum(CASE WHEN value IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_rows
        FROM pv GROUP BY column_name"""


_PO_KEYS = "AUFNR, POSNR, DWERK"

_QUERIES_SQL: dict[str, str] = {
    # S
    "scan_csv_inferred": "SELECT CAST(MANDT AS INTEGER) AS MANDT, WERKS, BWKEY, NAME1 FROM t001w",
    "scan_csv_typed": "SELECT * FROM marc",
    "scan_csv_damaged": """
        SELECT CASE WHEN m IN (3, 7) THEN 'cells' ELSE 'rows' END AS lane,
               CASE WHEN m NOT IN (3, 7) THEN SOURCE_SYSTEM_ERP END AS SOURCE_SYSTEM_ERP,
               CASE WHEN m NOT IN (3, 7) THEN MATNR END AS MATNR,
               CASE WHEN m NOT IN (3, 7) THEN WERKS END AS WERKS,
               CASE WHEN m NOT IN (3, 7) THEN LVORM END AS LVORM,
               CASE WHEN m IN (3, 7) THEN SOURCE_SYSTEM_ERP || ',' || MATNR || ',' || WERKS || ',' || coalesce(LVORM, '')
                    || CASE WHEN m = 3 THEN ',note,surplus' ELSE '' END END AS record
        FROM (SELECT *, CAST(MATNR AS INTEGER) % 10 AS m FROM marc)""",
    "scan_registry": "SELECT * FROM lm",
    "sink_csv_roundtrip": f"SELECT {_LM_RENAME} FROM lm",
    "sink_parquet_roundtrip": f"SELECT {_PO_RENAME} FROM po",
    "profile_columns": _profile_sql(
        "mbew",
        [
            ("MANDT", False), ("MATNR", False), ("BWKEY", False), ("VPRSV", False), ("VERPR", True),
            ("STPRS", True), ("PEINH", True), ("BKLAS", False), ("LVORM", False), ("BWTAR", False),
            ("LAEPR", False),
        ],
    ),
    "run_summary": (
        "SELECT 'local_material' AS dataset, count(*) AS row_count FROM lm "
        "UNION ALL SELECT 'process_order' AS dataset, count(*) AS row_count FROM po"
    ),
    # F
    "filter_valid_old_number": f"SELECT * FROM mara WHERE BISMT IS NULL OR BISMT NOT IN {_RETIRED}",
    "filter_not_deleted_blank": "SELECT * FROM mara WHERE LVORM IS NULL OR trim(LVORM) = ''",
    "prep_material_order": "SELECT * FROM mara_o",
    "filter_not_deleted_null": "SELECT * FROM marc WHERE LVORM IS NULL",
    "latest_per_key": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY MATNR, BWKEY
                ORDER BY LAEPR DESC NULLS LAST, VERPR DESC NULLS LAST, STPRS DESC NULLS LAST,
                         VPRSV ASC NULLS LAST, BKLAS ASC NULLS LAST, PEINH DESC NULLS LAST,
                         MANDT ASC NULLS LAST, LVORM ASC NULLS LAST, BWTAR ASC NULLS LAST
            ) AS rn FROM mbew
        ) WHERE rn = 1""",
    "duplicate_keys": "SELECT AUFNR, POSNR, count(*) AS count FROM afpo GROUP BY AUFNR, POSNR HAVING count(*) > 1",
    "prep_material_nochecks": "SELECT MANDT, MATNR, MEINS, ZZMDGM AS GLOBAL_MATERIAL_NUMBER FROM mara",
    # P, T
    "prep_material": "SELECT * FROM mara_p",
    "prep_valuation_latest": "SELECT * FROM mbew_p",
    "prep_plant_material": "SELECT * FROM marc_p",
    "prep_plant_material_extra": "SELECT DISTINCT SOURCE_SYSTEM_ERP, MATNR, WERKS, LVORM FROM marc",
    "prep_plant": "SELECT * FROM t001w_p",
    "prep_valuation_area": "SELECT * FROM t001k_p",
    "prep_company": "SELECT * FROM t001_p",
    "prep_order_header": "SELECT * FROM afko_p",
    "prep_order_item": "SELECT * FROM afpo_p",
    "prep_order_master": "SELECT * FROM aufk_p",
    "cast_dates": "SELECT * FROM afko_p",
    "derive_order_missing_date": f"""
        SELECT {_PO_KEYS}, CAST(NULL AS DATE) AS ZZGLTRP_ORIG, CAST(NULL AS INTEGER) AS on_time_flag,
               CAST(NULL AS DOUBLE) AS actual_on_time_deviation, 'Unknown' AS late_delivery_bucket
        FROM po_joined""",
    "rename_material": f"SELECT {_LM_RENAME} FROM lm_post",
    "rename_order": f"SELECT {_PO_RENAME} FROM po_post",
    # J
    "join_plant_material": "SELECT * FROM j1",
    "join_branch": "SELECT * FROM j2",
    "join_valuation": "SELECT * FROM j3",
    "join_company_area": "SELECT * FROM j4",
    "integrate_material": "SELECT * FROM lm_joined",
    "join_header_item": "SELECT * FROM po_j1",
    "join_order_master": "SELECT * FROM po_j2",
    "integrate_order": "SELECT * FROM po_joined",
    "integrate_order_changes": """
        SELECT j.*, d.CHNGIND, d.VALUE_NEW FROM po_joined j LEFT JOIN cdpos d ON j.OBJNR = d.OBJNR""",
    # A, W, L, U
    "key_violations": _key_violations_sql("po"),
    "key_violations_material": _key_violations_sql("lm"),
    "distinct_rows": "SELECT DISTINCT * FROM marc",
    "dedup_material": "SELECT * EXCLUDE (primary_key_intra, primary_key_inter, mtl_plant_emd, global_mtl_id) FROM lm_post",
    "dedup_material_counts": """
        SELECT * EXCLUDE (rn) FROM lm_derived WHERE rn = 1""",
    "preview_rows": "SELECT * FROM lm ORDER BY primary_key_inter LIMIT 5",
    "union_material": "SELECT * FROM mara_p",
    "union_order": "SELECT * FROM afko_p",
    "union_conformed": "SELECT MANDT, MATNR, MEINS, ZZMDGM, BISMT, LVORM, NTGEW, MTART FROM mara",
    # D, M
    "derive_material_keys": """
        SELECT *, concat_ws('-', coalesce(MATNR, ''), coalesce(WERKS, '')) AS primary_key_intra,
               concat_ws('-', coalesce(SOURCE_SYSTEM_ERP, ''), coalesce(MATNR, ''), coalesce(WERKS, ''))
                   AS primary_key_inter
        FROM marc_p""",
    "derive_material": """
        SELECT SOURCE_SYSTEM_ERP, MATNR, WERKS, NAME1, GLOBAL_MATERIAL_NUMBER, mtl_plant_emd, global_mtl_id
        FROM lm_post""",
    "post_material": "SELECT * FROM lm_post",
    "derive_order_keys": f"""
        SELECT SOURCE_SYSTEM_ERP, {_PO_KEYS}, primary_key_intra, primary_key_inter FROM po_post""",
    "on_time_flag": f"SELECT {_PO_KEYS}, ZZGLTRP_ORIG, LTRMI, on_time_flag FROM po_post",
    "on_time_deviation": f"SELECT {_PO_KEYS}, ZZGLTRP_ORIG, LTRMI, actual_on_time_deviation FROM po_post",
    "late_bucket": f"SELECT {_PO_KEYS}, actual_on_time_deviation, late_delivery_bucket FROM po_post",
    "mto_mts": f"SELECT {_PO_KEYS}, KDAUF, mto_vs_mts_flag FROM po_post",
    "order_timestamps": f"""
        SELECT {_PO_KEYS}, LTRMI, GSTRI, order_finish_timestamp, order_start_timestamp FROM po_post""",
    "post_order": "SELECT * FROM po_post",
    "derive_order": "SELECT * FROM po_post",
    "month_start_dates": "SELECT AUFNR, GSTRP, GLTRP, start_date, finish_date FROM afko_p",
    "mask_columns": "SELECT * REPLACE (sha256(OBJNR) AS OBJNR, sha256(ERNAM) AS ERNAM) FROM aufk",
    "material_masked": """
        SELECT * REPLACE (sha256(primary_key_intra) AS primary_key_intra,
                          sha256(primary_key_inter) AS primary_key_inter, sha256(global_mtl_id) AS global_mtl_id)
        FROM lm""",
    "order_masked": """
        SELECT * REPLACE (sha256(primary_key_intra) AS primary_key_intra,
                          sha256(primary_key_inter) AS primary_key_inter,
                          sha256(GLOBAL_MATERIAL_NUMBER) AS GLOBAL_MATERIAL_NUMBER)
        FROM po""",
    # C
    "material_contract": "SELECT * FROM lm",
    "order_contract": "SELECT * FROM po",
    # Z
    "local_material": "SELECT * FROM lm",
    "process_order": "SELECT * FROM po",
    "local_material_final": f"SELECT {_LM_RENAME} FROM lm",
    "process_order_final": f"SELECT {_PO_RENAME} FROM po",
    # Shared client and numbers
    "overlap_valuation": "SELECT * EXCLUDE (sys) FROM o_mbew_p",
    "overlap_valuation_area": "SELECT * EXCLUDE (sys) FROM o_t001k_p",
    "overlap_joined": "SELECT * EXCLUDE (far) FROM o_joined",
    "overlap_local_material": f"SELECT {_MASKED.format(more=', no_of_duplicates')} FROM o_derived WHERE rn = 1",
    "overlap_counts": f"SELECT {_MASKED.format(more='')} FROM o_derived WHERE rn = 1",
    "local_material_isolated": f"SELECT {_MASKED.format(more=', no_of_duplicates')} FROM o_derived_own WHERE rn = 1",
    "overlap_order_changes": "SELECT j.*, d.CHNGIND, d.VALUE_NEW FROM o_orders j LEFT JOIN o_cdpos d ON j.OBJNR = d.OBJNR",
    "overlap_order_hot": """
        SELECT h.*, i.POSNR, i.DWERK, i.MATNR, i.MEINS, i.KDAUF, i.KDPOS, i.LTRMI
        FROM o_afko_p h LEFT JOIN o_afpo_p i ON i.AUFNR = h.AUFNR""",
    "process_order_isolated": """
        SELECT * REPLACE (sha256(AUFNR) AS AUFNR, sha256(MATNR) AS MATNR, sha256(KDPOS) AS KDPOS,
                          sha256(KDAUF) AS KDAUF, sha256(ERNAM) AS ERNAM, sha256(OBJNR) AS OBJNR)
        FROM o_orders_post""",
    "order_deviation_late_positive": f"""
        SELECT {_PO_KEYS}, 0 - actual_on_time_deviation AS actual_on_time_deviation,
               CASE WHEN actual_on_time_deviation >= 0 THEN 'On Time'
                    WHEN actual_on_time_deviation BETWEEN -7 AND -1 THEN '1-7 Days Late'
                    WHEN actual_on_time_deviation BETWEEN -14 AND -8 THEN '8-14 Days Late'
                    WHEN actual_on_time_deviation < -14 THEN '>14 Days Late' ELSE 'Unknown' END AS late_delivery_bucket
        FROM po_post""",
    # Published output and lost values
    "harmonize_published": f"""
        SELECT {_LM_RENAME.replace("SOURCE_SYSTEM_ERP AS source_system_erp", "CASE SOURCE_SYSTEM_ERP WHEN 'SYS1' THEN '001' ELSE '010' END AS source_system_erp").replace("primary_key_inter", "CASE SOURCE_SYSTEM_ERP WHEN 'SYS1' THEN '001' ELSE '010' END || substr(primary_key_inter, 5) AS primary_key_inter")}
        FROM lm""",
    "process_order_stored": "SELECT * FROM po",
    "key_violations_stored": _key_violations_sql("po"),
    "harmonize_published_order": f"SELECT {_PO_RENAME} FROM po",
    "harmonize_raise": f"SELECT {_LM_RENAME} FROM lm",
    "rejects_registry": f"""
        SELECT system, 'MBEW' AS table_name, c.column_name,
               CASE c.column_name WHEN '(rows)' THEN n WHEN 'STPRS' THEN bad ELSE 0 END AS rejected
        FROM (SELECT {_SYS.format(k="l_partkey")} AS system, count(*) AS n,
                     count(*) FILTER (WHERE l_quantity % 5 = 0) AS bad
              FROM lineitem GROUP BY 1),
             (VALUES ('(rows)'), ('(damaged records)'), ('VERPR'), ('STPRS'), ('PEINH')) c(column_name)""",
    "conform_rejects": f"""
        SELECT system, 'MBEW' AS table_name, 'STPRS' AS column_name,
               count(*) FILTER (WHERE l_quantity % 5 = 0) AS rejected
        FROM (SELECT *, {_SYS.format(k="l_partkey")} AS system FROM lineitem) GROUP BY system
        UNION ALL
        SELECT system, 'AFPO', 'LTRMI', count(*) FILTER (WHERE l_linenumber = 3)
        FROM (SELECT *, {_SYS.format(k="l_orderkey")} AS system FROM lineitem) GROUP BY system""",
}


def _needed(sql: str, seen: list[str]) -> list[str]:
    """Blocks referenced by ``sql`` (and, recursively, by them), dependencies first."""
    for name in _BLOCKS:
        if name in seen:
            continue
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            _needed(_BLOCKS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def _sql(statement: str) -> str:
    blocks = _needed(statement, [])
    if not blocks:
        return statement.strip()
    with_list = ",\n".join(f"{name} AS ({_BLOCKS[name].strip()})" for name in blocks)
    body = statement.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {with_list},\n{body[5:]}"
    return f"WITH {with_list}\n{body}"


def oracle_sql() -> dict[str, str]:
    """For each key in ``queries()``, the same result as DuckDB SQL over the raw tables."""
    found = {name: _sql(statement) for name, statement in _QUERIES_SQL.items()}
    if _HAS_LLM:
        from erpweave.llm.queries import ORACLE_SQL as LLM_SQL

        found.update(LLM_SQL)
    if _HAS_PIPELINE:
        import corpus_pipeline

        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found

"""Damaged-record lanes, audits on the main plan, and both through the source registry."""

import random
import re

import pytest
from conftest import SF_SMALL, rows

from erpweave import contracts as C
from erpweave.plans import process_process_order, rejected_values
from erpweave.plans.catalog import AS_OF
from erpweave.sources import (
    AuditedSources,
    SourceAudit,
    SourceRegistry,
    SystemLocation,
    read_csv_lanes,
    write_table,
)
from erpweave.sources.audit import RECORDS, ROWS
from erpweave.sources.fixtures import TpchErpSources

SCHEMA = C.struct(("code", C.S), ("amount", C.F64), ("day", C.D))


def _file(tmp_path, text, name="data.csv"):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def test_every_record_is_in_one_lane(spark, tmp_path):
    path = _file(
        tmp_path,
        "﻿code,note,amount,day\n"
        "0001,plain,1.5,2024-01-02\n"
        '0002,"two\nlines",2,2024-01-03\n'
        "0003,short,3\n"
        "0004,long,4,2024-01-04,extra\n"
        '0005,x,"1.234,56",2024-01-05\n'
        "\n"
        "0006,x,6,someday\n"
        ",,,\n",
    )
    kept = read_csv_lanes(spark, path, SCHEMA)
    assert [r[0] for r in rows(kept.rows, "code")] == ["0001", "0002", "0005", "0006", None]
    assert sorted((r.reason, r.record) for r in kept.rejected.collect()) == [
        ("cells", "0003,short,3"),
        ("cells", "0004,long,4,2024-01-04,extra"),
    ]
    strict = read_csv_lanes(spark, path, SCHEMA, bad_values="reject")
    assert [r[0] for r in rows(strict.rows, "code")] == ["0001", "0002", None]
    assert {(r.reason, tuple(r.columns)) for r in strict.rejected.collect()} == {
        ("cells", ()),
        ("value", ("amount",)),
        ("value", ("day",)),
    }
    assert {r.file.rsplit("/", 1)[1] for r in strict.rejected.collect()} == {"data.csv"}
    assert strict.rows.count() + strict.rejected.count() == strict.raw.count() == 7


def test_random_files_lose_nothing(spark, tmp_path):
    """Records written by a plain writer, some damaged: both lanes together hold each once."""
    rng = random.Random(11)
    good, bad, lines = [], 0, {k: ["code,note,amount,day"] for k in range(4)}
    for i in range(600):
        note = rng.choice(["a", "", "b c", "comma, inside", "line\nbreak" if i % 4 == 3 else "no break"])
        cells = [f"{i:04d}", f'"{note}"' if re.search(r"[,\n]", note) else note, str(i / 2), "2024-02-29"]
        if rng.random() < 0.1:
            bad += 1
            cells = cells[:3] if rng.random() < 0.5 else [*cells, "more"]
        else:
            good.append((f"{i:04d}", i / 2))
        lines[i % 4].append(",".join(cells))
    for k, text in lines.items():
        _file(tmp_path, "\n".join(text) + "\n", f"part {k}.csv")
    found = read_csv_lanes(spark, str(tmp_path), SCHEMA)
    assert rows(found.rows, "code", "amount") == sorted(good)
    assert found.rejected.count() == bad
    # Only the file with quoted line breaks is read whole.
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan


def test_files_must_share_a_header(spark, tmp_path):
    _file(tmp_path, "code,amount,day\n1,1,2024-01-01\n", "a.csv")
    _file(tmp_path, "code,day,amount\n2,2024-01-01,2\n", "b.csv")
    with pytest.raises(Exception, match="header does not conform"):
        read_csv_lanes(spark, str(tmp_path), SCHEMA).rows.collect()


def test_lanes_of_empty_file_missing_column_and_wrong_mode(spark, tmp_path):
    path = _file(tmp_path, "code,amount,day\n")
    found = read_csv_lanes(spark, path, SCHEMA)
    assert found.rows.count() == 0 and found.rejected.count() == 0
    with pytest.raises(ValueError, match="not found"):
        read_csv_lanes(spark, path, C.struct(("other", C.S)))
    with pytest.raises(ValueError, match="bad_values"):
        read_csv_lanes(spark, path, SCHEMA, bad_values="ignore")


def _registry(tmp_path, damaged):
    (tmp_path / "s1").mkdir(exist_ok=True)
    _file(
        tmp_path / "s1",
        "MANDT,MATNR,BWKEY,VPRSV,VERPR,STPRS,PEINH,BKLAS,LVORM,BWTAR,LAEPR,NOTE\n"
        '100,M1,B1,V,"1.234,56",2.0,1,K,,,2024-01-01,x\n'
        "100,M2,B1,V,3.5,2.0,1,K,,,2024-01-01,x\n"
        "100,M3,B1,V,3.5,two,one,K,,,2024-01-01,x\n"
        "100,M4,B1,V,3.5\n",
        "P_MBEW.csv",
    )
    return SourceRegistry({"S1": SystemLocation(str(tmp_path / "s1"), "P")}, damaged=damaged)


def test_registry_lanes(spark, tmp_path):
    kept = _registry(tmp_path, "keep").load(spark, "S1", "MBEW")
    assert rows(kept, "MATNR") == [("M1",), ("M2",), ("M3",), ("M4",)]
    registry = _registry(tmp_path, "drop")
    assert rows(registry.load(spark, "S1", "MBEW"), "MATNR", "VERPR") == [("M1", None), ("M2", 3.5), ("M3", 3.5)]
    assert [(r.table_name, r.reason, r.record) for r in registry.rejected(spark, ["MBEW"]).collect()] == [
        ("MBEW", "cells", "100,M4,B1,V,3.5")
    ]
    strict = registry.rejected(spark, ["MBEW"], bad_values="reject")
    assert {tuple(r.columns) for r in strict.collect()} == {(), ("VERPR",), ("STPRS", "PEINH")}
    with pytest.raises(Exception, match="damaged record: 100,M4"):
        _registry(tmp_path, "fail").load(spark, "S1", "MBEW").collect()
    with pytest.raises(ValueError, match="damaged must be"):
        _registry(tmp_path, "other")


def test_rejects_are_counted_on_the_reading_plan(spark, tmp_path):
    """VERPR 1.234,56 is null after loading, and counted without a scan of its own."""
    for mode, rows_kept in (("drop", 3), ("keep", 4)):
        audit = SourceAudit()
        df = AuditedSources(_registry(tmp_path, mode), audit).load(spark, "S1", "MBEW")
        assert audit.counts(timeout=0) == {}  # nothing has run
        assert df.filter("MATNR IS NOT NULL").count() == rows_kept
        counts = audit.counts()
        assert counts[("S1", "MBEW", ROWS)] == 4 and counts[("S1", "MBEW", RECORDS)] == 1
        assert {k[2]: v for k, v in counts.items() if k[2] in ("VERPR", "STPRS", "PEINH")} == {"VERPR": 1, "STPRS": 1, "PEINH": 1}
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    report = {(r.column_name): r.rejected for r in audit.report(spark).collect()}
    assert report["VERPR"] == 1
    exact = rejected_values(spark, _registry(tmp_path, "drop"), ["MBEW"]).collect()
    assert {r.column_name: r.rejected for r in exact} == {"VERPR": 1, "STPRS": 1, "PEINH": 1}


class _Late(TpchErpSources):
    """Delivery dates as text, every third in no known form."""

    def load(self, spark, system, table):
        df = super().load(spark, system, table)
        if table == "AFPO":
            return df.selectExpr("* EXCEPT (LTRMI)", "IF(POSNR = '3', 'soon', CAST(LTRMI AS STRING)) AS LTRMI")
        return df


def test_audit_of_a_whole_pipeline_equals_the_exact_count(spark):
    audit = SourceAudit()
    sources = AuditedSources(_Late(SF_SMALL), audit)
    plan = process_process_order(spark, sources, as_of=AS_OF)
    assert plan.filter("LTRMI IS NULL").count() > 0
    counts = {k: v for k, v in audit.counts().items() if k[2] == "LTRMI"}
    exact = rejected_values(spark, _Late(SF_SMALL), ["AFPO"]).collect()
    assert counts == {(r.system, r.table_name, r.column_name): r.rejected for r in exact if r.column_name == "LTRMI"}
    assert sum(counts.values()) > 0


def test_tables_that_fit_keep_their_pushed_filters(spark, tmp_path):
    """No node over a table without typed text: filters still reach its scan."""
    src = TpchErpSources(SF_SMALL)
    write_table(src.load(spark, "SYS1", "MARA"), f"{tmp_path}/P_MARA.parquet")
    audited = AuditedSources(SourceRegistry({"SYS1": SystemLocation(str(tmp_path), "P", "parquet")}), SourceAudit())
    plan = audited.load(spark, "SYS1", "MARA").filter("BISMT IS NULL")._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" not in plan and "IsNull(BISMT)" in plan

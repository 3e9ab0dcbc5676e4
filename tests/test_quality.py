"""Masking, uniqueness checks, contracts, conformance and profiling."""

import hashlib
import hmac
import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from erpweave import contracts as C
from erpweave.operators import (
    SchemaContractError,
    check_columns_unique,
    check_schema,
    key_violations,
    mask_sensitive_columns,
    profile_data,
    quality,
)
from erpweave.sources import conform
from erpweave.sources.conform import conform_rejects


@pytest.fixture
def parcels(spark):
    """Distinct labels and weights; one city twice, one recipient unknown."""
    return spark.createDataFrame(
        [("L-1", "Oslo", "K. Berg", 2.5), ("L-2", "Turin", None, 4.0), ("L-3", "Oslo", "R. Neri", 0.5)],
        "label STRING, city STRING, recipient STRING, weight DOUBLE",
    )


def test_mask_hashes_values_and_keeps_nulls(parcels):
    masked = {r["label"]: r for r in mask_sensitive_columns(parcels, ["recipient", "weight"]).collect()}
    assert masked["L-1"]["recipient"] == hashlib.sha256(b"K. Berg").hexdigest()
    assert masked["L-3"]["weight"] == hashlib.sha256(b"0.5").hexdigest()
    assert masked["L-2"]["recipient"] is None and masked["L-2"]["city"] == "Turin"


def test_mask_salt_and_missing_column(parcels):
    salted = mask_sensitive_columns(parcels, ["city"], salt="pepper-").filter("label = 'L-2'").first()
    assert salted["city"] == hashlib.sha256(b"pepper-Turin").hexdigest()
    with pytest.raises(ValueError, match="Column 'street' not found in DataFrame."):
        mask_sensitive_columns(parcels, ["city", "street"])


def test_unique_columns_pass(parcels):
    assert check_columns_unique(parcels, ["label", "recipient", "weight"]) == {"label": 0, "recipient": 0, "weight": 0}
    assert check_columns_unique(parcels, []) == {}


def test_not_unique_and_missing(parcels):
    with pytest.raises(ValueError, match="Column 'city' is not unique. Found 1 duplicate values."):
        check_columns_unique(parcels, ["label", "city"])
    with pytest.raises(ValueError, match="Column 'street' is not present in the DataFrame."):
        check_columns_unique(parcels, ["street"])


def test_two_nulls_are_a_duplicate(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k STRING")
    with pytest.raises(ValueError, match="Column 'k' is not unique"):
        check_columns_unique(df, ["k"])
    report = key_violations(df, ["k"]).first()
    assert (report["distinct_values"], report["duplicated_values"], report["duplicated_rows"], report["null_rows"]) == (2, 1, 2, 2)


def test_key_violations_report(parcels):
    got = rows(key_violations(parcels, ["city", "label"]), "column_name", "duplicated_values", "duplicated_rows")
    assert got == [("city", 1, 2), ("label", 0, 0)]


def test_schema_contract(spark):
    df = spark.createDataFrame([], C.LOCAL_MATERIAL_CONTRACT)
    check_schema(df, C.LOCAL_MATERIAL_CONTRACT)
    check_schema(df.selectExpr(*[f"`{c}`" for c in df.columns]), C.LOCAL_MATERIAL_CONTRACT)
    with pytest.raises(SchemaContractError, match="PEINH"):
        check_schema(df.withColumn("PEINH", df.PEINH.cast("int")), C.LOCAL_MATERIAL_CONTRACT)
    with pytest.raises(SchemaContractError, match="columns"):
        check_schema(df.drop("WAERS"), C.LOCAL_MATERIAL_CONTRACT)


def test_conform_casts_by_name_and_keeps_leading_zeros(spark):
    df = spark.createDataFrame([(1, "0001", "2024-01-31", "x")], "MANDT INT, MATNR STRING, ERDAT STRING, EXTRA STRING")
    schema = C.struct(("MATNR", C.S), ("MANDT", C.S), ("ERDAT", C.D))
    out = conform(df, schema)
    assert out.columns == ["MATNR", "MANDT", "ERDAT"]
    assert [tuple(r) for r in out.collect()][0][:2] == ("0001", "1")
    with pytest.raises(ValueError, match="not found"):
        conform(df, C.struct(("NOPE", C.S)))
    assert conform(df, C.struct(("NOPE", C.S)), allow_missing=True).first()["NOPE"] is None
    assert conform(df, schema, keep_extra=True).columns[-1] == "EXTRA"


def test_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, None), (None, "c")], "x DOUBLE, s STRING")
    prof = {r["column_name"]: r for r in profile_data(df).collect()}
    assert (prof["x"]["non_null"], prof["x"]["nulls"], prof["x"]["mean"]) == (2, 1, 2.0)
    assert prof["x"]["min_value"] == "1.0" and prof["x"]["max_value"] == "3.0"
    assert (prof["s"]["min_value"], prof["s"]["max_value"], prof["s"]["mean"]) == ("a", "c", None)


def test_profile_keeps_large_and_small_numbers(spark):
    df = spark.createDataFrame([(1e33, 1e-7, float("nan")), (-2.0, 3e-7, 1.0)], "big DOUBLE, small DOUBLE, odd DOUBLE")
    prof = {r["column_name"]: r for r in profile_data(df).collect()}
    assert (float(prof["big"]["min_value"]), float(prof["big"]["max_value"])) == (-2.0, 1e33)
    assert (float(prof["small"]["min_value"]), float(prof["small"]["max_value"])) == (1e-7, 3e-7)
    assert prof["small"]["mean"] == pytest.approx(2e-7) and prof["big"]["mean"] == pytest.approx(5e32)
    assert (prof["odd"]["min_value"], prof["odd"]["max_value"]) == ("1.0", "NaN")


def test_conform_rejects_counts_lost_values(spark):
    df = spark.createDataFrame(
        [("1.5", "2024-04-16", "a"), ("1.234,56", "20240416", "b"), (None, "soon", "c"), ("10,5-", None, "d")], "p STRING, d STRING, s STRING"
    )
    schema = C.struct(("p", C.F64), ("d", C.D), ("s", C.S))
    assert rows(conform_rejects(df, schema)) == [("d", 2), ("p", 2)]
    assert rows(conform_rejects(df, schema, date_formats=["yyyyMMdd"])) == [("d", 1), ("p", 2)]
    assert conform_rejects(df.select("s"), C.struct(("s", C.S))).count() == 0


def _report(values):
    counts = Counter(values)
    dup = {v: n for v, n in counts.items() if n > 1}
    return (len(counts), len(dup), sum(dup.values()), counts[None])


@pytest.mark.parametrize("digest", ["xxhash64", "length", "constant"])
def test_key_check_is_exact_whatever_the_digests(spark, monkeypatch, digest):
    """Texts that share a digest, by chance or on purpose, are still counted apart."""
    digests = {"xxhash64": F.xxhash64, "length": F.length, "constant": lambda value: F.lit(1)}
    monkeypatch.setattr(quality, "_digest", digests[digest])
    rng = random.Random(3)
    key = lambda: rng.choice([None, "", "hot", "hot", *(f"k{rng.randrange(400)}" for _ in range(6))])
    data = [(key(), f"only-{i}", None) for i in range(500)]
    df = spark.createDataFrame(data, "a string, `b.c` string, d string")
    got = {r.column_name: tuple(r)[1:] for r in key_violations(df, ["a", "b.c", "d"], reread=True).collect()}
    assert got == {name: _report([row[i] for row in data]) for i, name in enumerate(["a", "b.c", "d"])}
    assert key_violations(df.limit(0), ["a"], reread=True).count() == 0


def test_no_text_of_a_unique_key_is_shuffled(spark):
    """The only exchange of the first phase moves numbers; without suspects there is no second one."""
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS a", "concat('x', id) AS b")
    report = key_violations(df, ["a", "b"], reread=True)
    assert "LeftSemi" not in report._jdf.queryExecution().toString()
    assert {tuple(r) for r in report.collect()} == {("a", 1000, 0, 0, 0), ("b", 1000, 0, 0, 0)}


@pytest.mark.parametrize("key", ["k", "a key of some length", "x" * 64, "é" * 50])
def test_keyed_masks_are_standard_hmacs(spark, key):
    values = ["4711", "", "ünïcode", None, "x" * 200]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.v for r in mask_sensitive_columns(df, ["v"], key=key).orderBy("i").collect()]
    assert got == [None if v is None else hmac.new(key.encode(), v.encode(), "sha256").hexdigest() for v in values]
    with pytest.raises(ValueError, match="not both"):
        mask_sensitive_columns(df, ["v"], salt="s", key=key)

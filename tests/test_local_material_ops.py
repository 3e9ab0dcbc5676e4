"""Material joins (J1-J10), keys and final de-duplication (D1-D4), join helpers."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from erpweave import contracts as C
from erpweave.operators import (
    derive_intra_and_inter_primary_key,
    integration_local_material,
    left_join,
    post_prep_local_material,
)

S = "STRING"


def _inputs(spark, mara, mbew, marc, t001k, t001w, t001):
    return (
        spark.createDataFrame(mara, f"MANDT {S}, MATNR {S}, MEINS {S}, GLOBAL_MATERIAL_NUMBER {S}"),
        spark.createDataFrame(
            mbew, f"MANDT {S}, MATNR {S}, BWKEY {S}, VPRSV {S}, VERPR DOUBLE, STPRS DOUBLE, PEINH LONG, BKLAS {S}"
        ),
        spark.createDataFrame(marc, f"SOURCE_SYSTEM_ERP {S}, MATNR {S}, WERKS {S}"),
        spark.createDataFrame(t001k, f"MANDT {S}, BWKEY {S}, BUKRS {S}"),
        spark.createDataFrame(t001w, f"MANDT {S}, WERKS {S}, BWKEY {S}, NAME1 {S}"),
        spark.createDataFrame(t001, f"MANDT {S}, BUKRS {S}, WAERS {S}"),
    )


def test_integration_joins_every_table_on_its_keys(spark):
    """Two plants of one material take their own area, price, company and currency; decoys match one key too few."""
    out = integration_local_material(
        *_inputs(
            spark,
            [("300", "PUMP", "ST", "G-77"), ("300", "VALVE", "ST", None)],
            [
                ("300", "PUMP", "A-N", "V", 12.5, 11.0, 1, "7920"),
                ("300", "PUMP", "A-S", "S", 14.0, 13.0, 100, "7920"),
                ("301", "PUMP", "A-N", "V", 99.0, 99.0, 1, "decoy"),
                ("300", "VALVE", "A-N", "V", 98.0, 98.0, 1, "decoy"),
            ],
            [("ERP-A", "PUMP", "NORTH"), ("ERP-A", "PUMP", "SOUTH")],
            [("300", "A-N", "NO"), ("300", "A-S", "IT"), ("301", "A-N", "XX")],
            [("300", "NORTH", "A-N", "Oslo"), ("300", "SOUTH", "A-S", "Bari"), ("301", "NORTH", "A-N", "decoy")],
            [("300", "NO", "NOK"), ("300", "IT", "EUR"), ("301", "NO", "XXX")],
        )
    )
    assert out.columns == C.names(C.LOCAL_MATERIAL_CONTRACT)[:15]
    got = {r["WERKS"]: r.asDict() for r in out.collect()}
    assert out.count() == 2
    common = {"MANDT": "300", "SOURCE_SYSTEM_ERP": "ERP-A", "MATNR": "PUMP", "MEINS": "ST", "GLOBAL_MATERIAL_NUMBER": "G-77", "BKLAS": "7920"}
    north = {"WERKS": "NORTH", "BWKEY": "A-N", "NAME1": "Oslo", "VPRSV": "V", "VERPR": 12.5, "STPRS": 11.0, "PEINH": 1, "BUKRS": "NO", "WAERS": "NOK"}
    south = {"WERKS": "SOUTH", "BWKEY": "A-S", "NAME1": "Bari", "VPRSV": "S", "VERPR": 14.0, "STPRS": 13.0, "PEINH": 100, "BUKRS": "IT", "WAERS": "EUR"}
    assert got == {"NORTH": common | north, "SOUTH": common | south}


def test_integration_empty_and_nulls(spark):
    assert integration_local_material(*_inputs(spark, [], [], [], [], [], [])).count() == 0
    # A material known by number only, in a plant whose area has no company.
    bare = _inputs(
        spark,
        [("300", "HOSE", None, None)],
        [("300", "HOSE", "A-W", None, None, None, None, None)],
        [("ERP-A", "HOSE", "WEST")],
        [("300", "A-W", None)],
        [("300", "WEST", "A-W", None)],
        [("300", None, None)],
    )
    got = integration_local_material(*bare).first().asDict()
    assert {k for k, v in got.items() if v is not None} == {"MANDT", "SOURCE_SYSTEM_ERP", "MATNR", "WERKS", "BWKEY"}


def test_filtered_material_leaves_everything_right_of_it_null(spark):
    plants = ["NORTH", "SOUTH", "WEST"]
    inputs = _inputs(
        spark,
        [],
        [("300", "HOSE", f"A-{p}", "V", 2.0, 3.0, 5, "7900") for p in plants],
        [("ERP-A", "HOSE", p) for p in plants],
        [("300", f"A-{p}", "NO") for p in plants],
        [("300", p, f"A-{p}", p.title()) for p in plants],
        [("300", "NO", "NOK")],
    )
    out = integration_local_material(*inputs)
    assert rows(out, "MANDT", "WERKS", "BWKEY", "VERPR", "WAERS") == [(None, p, None, None, None) for p in plants]


def test_cross_system_fan_out_and_isolation(spark):
    mara, mbew, marc, t001k, t001w, t001 = _inputs(
        spark,
        [("100", "M1", "KG", "G-A"), ("200", "M1", "KG", "G-B")],
        [],
        [("SYS1", "M1", "P1")],
        [],
        [],
        [],
    )
    assert integration_local_material(mara, mbew, marc, t001k, t001w, t001).count() == 2  # reference behaviour
    tag = "SYS"
    tagged = [
        mara.withColumn(tag, F.when(F.col("MANDT") == "100", "SYS1").otherwise("SYS2")),
        mbew.withColumn(tag, F.lit("SYS1")),
        marc.withColumn(tag, F.col("SOURCE_SYSTEM_ERP")),
        t001k.withColumn(tag, F.lit("SYS1")),
        t001w.withColumn(tag, F.lit("SYS1")),
        t001.withColumn(tag, F.lit("SYS1")),
    ]
    isolated = integration_local_material(*tagged, extra_keys=[tag])
    assert rows(isolated, "MANDT", "GLOBAL_MATERIAL_NUMBER") == [("100", "G-A")]


def test_primary_keys_with_nulls(spark):
    df = spark.createDataFrame(
        [("SYS1", "MAT1", "PLANT1"), ("SYS1", None, "PLANT1"), ("SYS2", "MAT2", None), (None, "MAT3", "PLANT3")],
        f"SOURCE_SYSTEM_ERP {S}, MATNR {S}, WERKS {S}",
    )
    got = rows(derive_intra_and_inter_primary_key(df), "primary_key_intra", "primary_key_inter")
    assert got == sorted(
        [("MAT1-PLANT1", "SYS1-MAT1-PLANT1"), ("-PLANT1", "SYS1--PLANT1"), ("MAT2-", "SYS2-MAT2-"), ("MAT3-PLANT3", "-MAT3-PLANT3")],
        key=repr,
    )
    with pytest.raises(Exception):  # noqa: B017 - missing WERKS is an analysis error
        derive_intra_and_inter_primary_key(df.drop("WERKS"))


POSTS = f"SOURCE_SYSTEM_ERP {S}, MATNR {S}, WERKS {S}, NAME1 {S}, GLOBAL_MATERIAL_NUMBER {S}, MANDT {S}"


def test_post_prep_derives_and_keeps_one_row_per_plant(spark):
    copies = [("ERP-A", f"MAT-{m}", f"W{w}", None if w == 3 else f"Site {w}", None if m % 2 else f"G{m}", "300") for m in range(4) for w in (1, 2, 3)]
    out = {(r["MATNR"], r["WERKS"]): r for r in post_prep_local_material(spark.createDataFrame(copies * 3, POSTS)).collect()}
    assert len(out) == len(copies)
    for _, material, plant, name, number, _ in copies:
        row = out[material, plant]
        assert row["mtl_plant_emd"] == (plant if name is None else f"{plant}-{name}")
        assert row["global_mtl_id"] == (material if number is None else number)
        assert (row["primary_key_intra"], row["primary_key_inter"]) == (f"{material}-{plant}", f"ERP-A-{material}-{plant}")
    assert post_prep_local_material(spark.createDataFrame([], POSTS)).count() == 0


def test_counted_duplicates_take_the_same_rows(spark):
    rnd = random.Random(5)
    pick = lambda *x: rnd.choice([None, *x])
    data = [(pick("S1", "S2"), pick("M1", "M2"), pick("W1"), pick("A", "B", "C"), pick("G"), pick("100", "200")) for _ in range(200)]
    df = spark.createDataFrame(data, POSTS)
    counted = post_prep_local_material(df, count_duplicates=True)
    assert rows(counted.drop("no_of_duplicates")) == rows(post_prep_local_material(df))
    assert sum(r["no_of_duplicates"] for r in counted.collect()) == 200
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan
    with pytest.raises(ValueError, match="default order"):
        post_prep_local_material(df, order_by=[F.col("MANDT")], count_duplicates=True)


def test_rows_of_the_own_system_win(spark):
    from erpweave.plans import process_local_material

    class Shared:
        """One client, material and plant code in two systems; the other system's values sort first."""

        systems = ["SYS1", "SYS2"]

        def load(self, spark_, system, table):
            own = {"SYS1": "z-own", "SYS2": "a-other"}[system]
            schema = C.SOURCE_SCHEMAS[table]
            values = {"MANDT": "300", "SOURCE_SYSTEM_ERP": system, "MATNR": "M", "WERKS": "W", "BWKEY": "B", "BUKRS": "K"}
            values |= {"MEINS": own, "ZZMDGM": own, "NAME1": own, "WAERS": own, "VPRSV": own, "VERPR": 1.0}
            return spark_.createDataFrame([tuple(values.get(f) for f in schema.fieldNames())], schema)

    got = {r["SOURCE_SYSTEM_ERP"]: r for r in process_local_material(spark, Shared(), mask=False).collect()}
    assert {s: (r["MEINS"], r["NAME1"], r["WAERS"], r["VPRSV"]) for s, r in got.items()} == {
        "SYS1": ("z-own",) * 4, "SYS2": ("a-other",) * 4
    }


def test_post_prep_keeps_first_row_in_a_fixed_order(spark):
    df = spark.createDataFrame(
        [
            ("SYS1", "MAT1", "PLANT1", "B", "G", "200"),
            ("SYS1", "MAT1", "PLANT1", "A", "G", "100"),
            ("SYS1", "MAT1", "PLANT1", "C", "G", None),
        ],
        POSTS,
    )
    for parts in ("1", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert rows(post_prep_local_material(df), "MANDT", "NAME1") == [("100", "A")]
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    counted = post_prep_local_material(df, count_duplicates=True).first()
    assert counted["no_of_duplicates"] == 3


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize(("split", "hot_rows"), [(False, None), (True, 1_000_000), (True, 5)])
def test_left_join_variants_equal_plain_left_join(spark, spread, split, hot_rows):
    rnd = random.Random(7)
    left = [(rnd.choice([None, "a", "b", "c"]), rnd.choice([None, "x", "y"]), i) for i in range(300)]
    right = [(rnd.choice([None, "a", "b", "d"]), rnd.choice([None, "x", "y"]), f"r{i}") for i in range(60)]
    right += [("a", "x", f"hot{i}") for i in range(40)]  # one hot right key
    lf = spark.createDataFrame(left, "k1 STRING, k2 STRING, v INT")
    rf = spark.createDataFrame(right, "k1 STRING, k2 STRING, w STRING")
    plain = lf.join(rf, ["k1", "k2"], "left")
    kwargs = {"hot_key_rows": hot_rows} if hot_rows else {}
    variant = left_join(lf, rf, ["k1", "k2"], spread_null_keys=spread, split_right_skew=split, **kwargs)
    assert variant.columns == plain.columns
    assert rows(variant) == rows(plain)


def test_spread_keys_reach_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lf = spark.createDataFrame([(None, 1)], "k STRING, v INT")
        rf = spark.createDataFrame([("a", 2)], "k STRING, w INT")
        plan = left_join(lf, rf, "k", spread_null_keys=True)._jdf.queryExecution().executedPlan().toString()
        assert "__erpweave_spread" in plan and "hashpartitioning" in plan.lower()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")

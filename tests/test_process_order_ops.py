"""Order header/item/master/material preparation (T7-T10) and order derivations (D5-D13)."""

import datetime as dt

import pytest
from conftest import rows

from erpweave.operators import (
    integration_process_order,
    post_prep_process_order,
    prep_sap_general_material_data,
    prep_sap_order_header_data,
    prep_sap_order_item,
    prep_sap_order_master_data,
)

D = dt.date
HEADER = """SOURCE_SYSTEM_ERP STRING, MANDT STRING, AUFNR STRING, GLTRP DATE, GSTRP DATE, FTRMS DATE, GLTRS DATE,
            GSTRS DATE, GSTRI DATE, GETRI DATE, GLTRI DATE, FTRMI DATE, FTRMP DATE, DISPO STRING, FEVOR STRING,
            PLGRP STRING, FHORI STRING, AUFPL STRING"""


def _header(spark, gltrp, gstrp):
    return spark.createDataFrame(
        [("ERP1", "100", "ORDER1", gltrp, gstrp, None, None, None, None, None, None, None, None, "D1", "S1", "P1", "H1", "A1")],
        HEADER,
    )


def test_header_month_start_dates(spark):
    out = prep_sap_order_header_data(_header(spark, D(2023, 12, 31), D(2023, 1, 17)), as_of="2024-06-15")
    row = out.first()
    assert len(out.columns) == 20
    assert (row["start_date"], row["finish_date"]) == (D(2023, 1, 1), D(2023, 12, 1))


def test_header_missing_dates_fall_back_to_as_of(spark):
    row = prep_sap_order_header_data(_header(spark, None, None), as_of=D(2024, 6, 15)).first()
    assert (row["start_date"], row["finish_date"]) == (D(2024, 6, 1), D(2024, 6, 1))
    today = prep_sap_order_header_data(_header(spark, None, None)).first()
    assert today["start_date"] is not None and today["start_date"].day == 1


def test_header_text_dates_iso_compact_and_bad(spark):
    df = spark.createDataFrame(
        [("ERP1", "100", "O1", "2023-05-20", "20230302", "garbage", None, None, None, None, None, None, None, "D", "F", "P", "H", "A")],
        HEADER.replace("GLTRP DATE", "GLTRP STRING").replace("GSTRP DATE", "GSTRP STRING").replace("FTRMS DATE", "FTRMS STRING"),
    )
    row = prep_sap_order_header_data(df, as_of="2024-06-15", date_formats=["yyyyMMdd"]).first()
    assert (row["GLTRP"], row["GSTRP"], row["FTRMS"]) == (D(2023, 5, 20), D(2023, 3, 2), None)
    assert (row["start_date"], row["finish_date"]) == (D(2023, 3, 1), D(2023, 5, 1))


def test_header_empty_and_type_errors(spark):
    assert prep_sap_order_header_data(spark.createDataFrame([], HEADER)).count() == 0
    for bad in (None, "not a dataframe"):
        with pytest.raises(TypeError, match="Invalid input DataFrame"):
            prep_sap_order_header_data(bad)


ITEM = "AUFNR STRING, POSNR LONG, DWERK STRING, MATNR STRING, MEINS STRING, KDAUF STRING, KDPOS STRING, LTRMI STRING, EXTRA STRING"


def test_item_columns_and_dates(spark):
    df = spark.createDataFrame(
        [("O1", 10, "P1", "M1", "PC", "S1", "I1", "2023-10-01", "x"), ("O2", 20, None, "M2", None, None, None, "bad", "y")],
        ITEM,
    )
    out = prep_sap_order_item(df)
    assert out.columns == ["AUFNR", "POSNR", "DWERK", "MATNR", "MEINS", "KDAUF", "KDPOS", "LTRMI"]
    assert rows(out, "AUFNR", "LTRMI", "DWERK") == [("O1", D(2023, 10, 1), "P1"), ("O2", None, None)]
    for bad in (None, "x"):
        with pytest.raises(TypeError, match="Invalid input DataFrame"):
            prep_sap_order_item(bad)


MASTER = "AUFNR STRING, OBJNR STRING, ERDAT DATE, ERNAM STRING, AUART STRING, ZZGLTRP_ORIG STRING, ZZPRO_TEXT STRING, EXTRA STRING"


def test_master_columns_bad_text_and_nulls(spark):
    df = spark.createDataFrame(
        [("O1", "OBJ1", D(2023, 1, 1), "U1", "T1", "ORIG1", "P1", "x"), (None, None, None, None, None, None, None, None)],
        MASTER,
    )
    out = prep_sap_order_master_data(df)
    assert out.columns == ["AUFNR", "OBJNR", "ERDAT", "ERNAM", "AUART", "ZZGLTRP_ORIG", "ZZPRO_TEXT"]
    assert rows(out, "AUFNR", "ZZGLTRP_ORIG") == [("O1", None), (None, None)]
    with pytest.raises(TypeError, match="Invalid input DataFrame"):
        prep_sap_order_master_data(None)


MAT = "MATNR STRING, CUSTOM_GLOBAL STRING, NTGEW DOUBLE, MTART STRING, BISMT STRING, LVORM STRING"


def test_order_material_filter_and_alias(spark):
    df = spark.createDataFrame(
        [
            ("M1", "G1", 1.5, "T", None, None),
            ("M2", "G2", 1.5, "T", "ARCHIVE", None),
            ("M3", "G3", 1.5, "T", None, "X"),
            ("M4", "G4", 1.5, "T", "B7", " "),
        ],
        MAT,
    )
    out = prep_sap_general_material_data(df, "CUSTOM_GLOBAL")
    assert out.columns == ["MATNR", "GLOBAL_MATERIAL_NUMBER", "NTGEW", "MTART"]
    assert rows(out, "MATNR", "GLOBAL_MATERIAL_NUMBER") == [("M1", "G1"), ("M4", "G4")]
    with pytest.raises(TypeError, match="Invalid input DataFrame"):
        prep_sap_general_material_data("x", "CUSTOM_GLOBAL")
    with pytest.raises(TypeError, match="Invalid input column name"):
        prep_sap_general_material_data(df, None)


POST = """SOURCE_SYSTEM_ERP STRING, AUFNR STRING, POSNR STRING, DWERK STRING, ZZGLTRP_ORIG DATE, LTRMI DATE,
          GSTRI DATE, KDAUF STRING"""


@pytest.fixture
def post(spark):
    day = D(2022, 9, 12)
    data = [
        ("P-ERP", "late", "1", "HAM", day, day + dt.timedelta(days=9), day - dt.timedelta(days=30), None),
        ("P-ERP", "early", "2", "HAM", day, day - dt.timedelta(days=11), day - dt.timedelta(days=29), "CUST-9"),
        ("P-ERP", "far", "3", "LYO", day, day - dt.timedelta(days=400), None, "CUST-8"),
        ("P-ERP", "same", "4", "LYO", day, day, day, None),
        ("P-ERP", "no-plan", "5", None, None, day, day, None),
        (None, "no-date", None, None, day, None, None, None),
    ]
    return {r["AUFNR"]: r for r in post_prep_process_order(spark.createDataFrame(data, POST)).collect()}


def test_order_keys_skip_nulls(post):
    keys = {k: (r["primary_key_intra"], r["primary_key_inter"]) for k, r in post.items() if k in ("late", "no-plan", "no-date")}
    assert keys == {
        "late": ("late_1_HAM", "P-ERP_late_1_HAM"),
        "no-plan": ("no-plan_5", "P-ERP_no-plan_5"),
        "no-date": ("no-date", "no-date"),
    }


def test_on_time_flag_and_deviation(post):
    assert {k: (r["on_time_flag"], r["actual_on_time_deviation"]) for k, r in post.items()} == {
        "late": (0, -9.0), "early": (1, 11.0), "far": (1, 400.0), "same": (1, 0.0), "no-plan": (None, None), "no-date": (None, None),
    }


def test_buckets_mto_and_timestamps(post):
    assert {k: (r["late_delivery_bucket"], r["mto_vs_mts_flag"]) for k, r in post.items()} == {
        "late": ("On Time", "MTS"), "early": ("8-14 Days Late", "MTO"), "far": (">14 Days Late", "MTO"),
        "same": ("On Time", "MTS"), "no-plan": ("Unknown", "MTS"), "no-date": ("Unknown", "MTS"),
    }
    assert (post["late"]["order_finish_timestamp"], post["late"]["order_start_timestamp"]) == (dt.datetime(2022, 9, 21), dt.datetime(2022, 8, 13))
    assert post["no-date"]["order_finish_timestamp"] is None and post["far"]["order_start_timestamp"] is None


def test_sign_of_the_deviation(spark):
    day = D(2022, 9, 12)
    df = spark.createDataFrame([("E", "O", "1", "P", day, day + dt.timedelta(days=9), None, None)], POST)
    row = post_prep_process_order(df, sign="actual_minus_planned").first()
    assert (row["actual_on_time_deviation"], row["late_delivery_bucket"], row["on_time_flag"]) == (9.0, "8-14 Days Late", 0)
    with pytest.raises(ValueError, match="sign must be"):
        post_prep_process_order(df, sign="other")


@pytest.mark.parametrize(
    ("days", "bucket"),
    [(-1, "On Time"), (0, "On Time"), (1, "1-7 Days Late"), (7, "1-7 Days Late"), (8, "8-14 Days Late"),
     (14, "8-14 Days Late"), (15, ">14 Days Late")],
)
def test_bucket_boundaries(spark, days, bucket):
    actual = D(2023, 6, 1)
    df = spark.createDataFrame([("E", "O", "1", "P", actual + dt.timedelta(days=days), actual, None, None)], POST)
    assert post_prep_process_order(df).first()["late_delivery_bucket"] == bucket


def test_missing_original_date_column_is_added(spark):
    df = spark.createDataFrame([("E", "O", "1", "P", D(2023, 1, 1), D(2023, 1, 1), None, None)], POST).drop("ZZGLTRP_ORIG")
    row = post_prep_process_order(df).first()
    assert row["ZZGLTRP_ORIG"] is None and row["on_time_flag"] is None and row["late_delivery_bucket"] == "Unknown"


def _brewery(spark):
    """Three batches: two with items, one without; the second has no planned date of its own."""

    def frame(columns, *data):
        return spark.createDataFrame(list(data), ", ".join(f"{c} STRING" for c in columns.split()))

    afko = frame("AUFNR OBJNR GLTRP", ("B-7", "OR7", "2023-03-03"), ("B-8", "OR8", "2023-04-04"), ("B-9", "OR9", "2023-05-05"))
    afpo = frame("AUFNR MATNR", ("B-7", "ALE"), ("B-8", "STOUT"), ("B-8", "MALT"), ("B-8", "ALE"))
    aufk = frame("AUFNR ZZGLTRP_ORIG", ("B-7", "2023-02-20"), ("B-8", None), ("B-9", "2023-05-01"))
    mara = frame("MATNR DESCRIPTION", ("ALE", "pale ale"), ("STOUT", "dry stout"), ("CIDER", "not brewed here"))
    cdpos = frame("OBJNR CHANGE", ("OR8", "quantity"), ("OR8", "date"), ("OR9", "cancelled"))
    return afko, afpo, aufk, mara, cdpos


def test_integration_required_and_fallback_date(spark):
    out = integration_process_order(*_brewery(spark)[:4])
    assert rows(out, "AUFNR", "MATNR", "ZZGLTRP_ORIG", "DESCRIPTION") == [
        ("B-7", "ALE", "2023-02-20", "pale ale"),
        ("B-8", "ALE", "2023-04-04", "pale ale"),
        ("B-8", "MALT", "2023-04-04", None),
        ("B-8", "STOUT", "2023-04-04", "dry stout"),
        ("B-9", None, "2023-05-01", None),
    ]
    assert out.columns[0] == "MATNR"


def test_integration_with_changes(spark):
    out = integration_process_order(*_brewery(spark))
    assert "CHANGE" in out.columns and out.columns[0] == "OBJNR"
    counts = {r.AUFNR: r["count"] for r in out.groupBy("AUFNR").count().collect()}
    assert counts == {"B-7": 1, "B-8": 6, "B-9": 1}  # three items times two changes; no item, one change


def test_integration_type_errors(spark):
    with pytest.raises(TypeError, match="Expected DataFrame for sap_afko"):
        integration_process_order("not_a_dataframe", None, None, None)
    one = spark.createDataFrame([("1000",)], "AUFNR STRING")
    with pytest.raises(TypeError, match="Expected DataFrame or None for sap_cdpos"):
        integration_process_order(one, one, one, one, "not_a_dataframe")


def test_same_order_number_in_both_systems(spark):
    from erpweave.plans.pipelines import process_order_integrated

    class TwoSystems:
        systems = ["SYS1", "SYS2"]

        def load(self, spark_, system, table):
            client = "100" if system == "SYS1" else "200"
            if table == "AFKO":
                return spark_.createDataFrame(
                    [(system, client, "4711", "2024-03-10", "2024-03-01", *[None] * 8, "D", "F", "P", "H", "A")],
                    HEADER.replace(" DATE", " STRING"),
                )
            if table == "AFPO":
                return spark_.createDataFrame(
                    [("4711", "10", "W1", f"M-{system}", "EA", None, None, "2024-03-09")],
                    "AUFNR STRING, POSNR STRING, DWERK STRING, MATNR STRING, MEINS STRING, KDAUF STRING, KDPOS STRING, LTRMI STRING",
                )
            if table == "AUFK":
                return spark_.createDataFrame(
                    [("4711", f"OBJ-{system}", "2024-01-01", "U", "T", None, "P")],
                    "AUFNR STRING, OBJNR STRING, ERDAT STRING, ERNAM STRING, AUART STRING, ZZGLTRP_ORIG STRING, ZZPRO_TEXT STRING",
                )
            return spark_.createDataFrame([], MAT.replace("CUSTOM_GLOBAL", "ZZMDGM"))

    shared = process_order_integrated(spark, TwoSystems(), as_of="2024-06-15")
    isolated = process_order_integrated(spark, TwoSystems(), as_of="2024-06-15", isolate_systems=True)
    assert shared.count() == 8  # each header meets both systems' items, then both masters
    assert rows(isolated, "SOURCE_SYSTEM_ERP", "MATNR", "OBJNR") == [
        ("SYS1", "M-SYS1", "OBJ-SYS1"),
        ("SYS2", "M-SYS2", "OBJ-SYS2"),
    ]

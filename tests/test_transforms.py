"""Channel map, one-hot, repeat flag, split, cleaning, elapsed days."""

import pytest
from pyspark.sql import functions as F

from conftest import SNAP, by_id, txn_df
from tidemark import config as C
from tidemark.functions import DUMMY_COLUMNS, channel_group, floor_days, ts_literal
from tidemark.operators import cleaning as CL


@pytest.mark.parametrize("code,group", [
    ("WEB", "WEB"), ("GDS", "OTA/GDS"), ("RL", "Direct"), ("SYDC", "Corporate"),
    ("CHOPRA", "Specialty"), ("UNKNOWN_CHANNEL", "Unknown"), (None, "Unknown"),
    ("web", "Unknown"), ("Direct", "Unknown"), ("OTA", "Unknown"),
])
def test_channel_map(spark, code, group):
    df = spark.createDataFrame([(code,)], "channel string")
    assert df.select(channel_group("channel")).collect()[0][0] == group


def test_every_mapped_code(spark):
    df = spark.createDataFrame([(k,) for k in C.CHANNEL_GROUPS], "channel string")
    got = {r[0]: r[1] for r in df.select("channel", channel_group("channel")).collect()}
    assert got == C.CHANNEL_GROUPS


def test_onehot_fixed_columns(small):
    enc = CL.add_channel_groups(small)
    for d in DUMMY_COLUMNS:
        assert d in enc.columns
    rows = enc.select("channel_group", *DUMMY_COLUMNS).collect()
    for r in rows:
        assert sum(bool(r[d]) for d in DUMMY_COLUMNS) == 1


def test_repeat_flag_and_split(small):
    flagged = CL.add_repeat_flag(small)
    flags = {r["customer_id"]: r["repeat"] for r in flagged.collect()}
    assert flags == {"K1": "Y", "K2": "N", "K3": "Y"}
    one, rep = CL.split_customers(small)
    assert one.count() == 1 and rep.count() == 5
    assert {r[0] for r in one.select("customer_id").collect()} == {"K2"}


def test_clean_strict_and_lenient(spark):
    df = txn_df(spark, [("A", "2025-06-03", 10, "WEB"), ("A", SNAP, 10, "WEB"),
                        ("B", "2025-01-01", 0, "WEB"), ("C", "2025-01-01", -5, None),
                        (None, "2025-01-01", 5, "WEB")])
    assert CL.clean_strict(df, SNAP).count() == 1
    assert CL.clean_strict(df, SNAP, inclusive=True).count() == 2
    assert CL.clean_lenient(df, SNAP).count() == 2


def test_floor_days_with_time_of_day(spark):
    df = spark.createDataFrame([("2025-06-03 15:00:00",), ("2025-06-04 15:00:00",), ("2025-06-01 00:00:00",)],
                               "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = [r[0] for r in df.select(floor_days("t", ts_literal(SNAP))).collect()]
    assert got == [0, -1, 3]


def test_lenient_frame_fallbacks(spark):
    from tidemark.sources import lenient_frame
    raw = spark.createDataFrame([(" 1 ", "2024-01-05", "12.5", "WEB"), ("2", "not a date", "x", None)],
                                "CustomerID string, `Arrival Date` string, `Room Amount` string, Channel string")
    out = lenient_frame(raw).collect()
    assert out[0]["revenue"] == 12.5 and out[1]["revenue"] == 0.0
    assert out[1]["arrival_ts"] is None
    none = lenient_frame(raw.drop("Room Amount")).collect()
    assert {r["revenue"] for r in none} == {C.DEFAULT_REVENUE}


@pytest.mark.parametrize("segment,level,want", [
    ("Champions", "Low", C.MISMATCH_OVERRATED), ("Loyal Customers", "Low", C.MISMATCH_OVERRATED),
    ("At Risk", "High", C.MISMATCH_UNDERRATED), ("Lost", "Top", C.MISMATCH_UNDERRATED),
    ("Champions", "Top", C.MISMATCH_ALIGNED), ("Potential Loyalists", "Low", C.MISMATCH_ALIGNED),
    ("Unknown", "High", C.MISMATCH_ALIGNED), ("Lost", "Mid", C.MISMATCH_ALIGNED),
])
def test_mismatch(spark, segment, level, want):
    from tidemark.functions import mismatch
    df = spark.createDataFrame([(segment, level)], "s string, l string")
    assert df.select(mismatch("s", "l")).collect()[0][0] == want


@pytest.mark.parametrize("clv,one,want", [
    (49.99, True, "Low"), (50.0, True, "Mid"), (149.0, True, "Mid"), (150.0, True, "High"),
    (299.99, True, "High"), (300.0, True, "Top"), (199.0, False, "Low"), (200.0, False, "Mid"),
    (500.0, False, "High"), (999.99, False, "High"), (1000.0, False, "Top"),
])
def test_clv_level_thresholds(spark, clv, one, want):
    from tidemark.functions import clv_level_abs
    df = spark.createDataFrame([(float(clv), one)], "v double, o boolean")
    assert df.select(clv_level_abs("v", "o")).collect()[0][0] == want


def test_quartile_level(spark):
    from tidemark.operators.rfm import quantile_level
    df = spark.createDataFrame([(float(v),) for v in range(1, 9)], "clv double")
    got = {r["clv"]: r["clv_level"] for r in quantile_level(df, "clv").collect()}
    assert [got[v] for v in (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0)] == \
        ["Low", "Low", "Mid", "Mid", "High", "High", "Top", "Top"]

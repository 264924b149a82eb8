"""Customer aggregate, purchase summary, latest channel, visit numbers."""

from conftest import SNAP, by_id, txn_df
from tidemark.operators import cleaning as CL
from tidemark.operators import customers as CU


def test_customer_table(small):
    got = by_id(CU.customer_table(CL.add_channel_groups(small), SNAP))
    c1 = got["K1"]
    assert c1["visit_count"] == 2 and c1["avg_spend"] == 515.0 and c1["duration"] == 480 and c1["event"] == 1
    assert got["K2"]["event"] == 0 and got["K2"]["duration"] == 408
    assert got["K3"]["channel_group"] == "Specialty" and got["K3"]["channel_specialty"] is True
    assert c1["channel_web"] is True and c1["channel_specialty"] is False


def test_purchase_summary(five):
    got = by_id(CU.purchase_summary(five, SNAP))
    want = {"P1": (1, 142, 480, 610.0), "P2": (0, 0, 408, 0.0), "P3": (2, 247, 512, 1000.0),
            "P4": (0, 0, 386, 0.0), "P5": (3, 545, 653, 530.0)}
    for c, (f, tx, T, m) in want.items():
        r = got[c]
        assert (r["frequency"], r["t_x"], r["T"], r["monetary_value"]) == (f, tx, T, m), c


def test_same_day_visits_are_one_period(spark):
    df = txn_df(spark, [("A", "2024-01-01 09:00:00", 100, "WEB"), ("A", "2024-01-01 18:00:00", 50, "WEB")])
    r = CU.purchase_summary(df, SNAP).collect()[0]
    assert r["frequency"] == 0 and r["monetary_value"] == 0.0 and r["n_visits"] == 2


def test_features_agree_with_separate_operators(five):
    f = by_id(CU.customer_features(five, SNAP))
    s = by_id(CU.purchase_summary(five, SNAP))
    r = by_id(CU.rfm_features(five, SNAP))
    for c in f:
        assert f[c]["days_frequency"] == s[c]["frequency"] and f[c]["T"] == s[c]["T"]
        assert f[c]["recency"] == r[c]["recency"] and f[c]["monetary"] == r[c]["monetary"]


def test_latest_channel_and_tie_break(spark):
    df = txn_df(spark, [("A", "2024-01-01", 10, "WEB"), ("A", "2024-03-01", 10, "GDS"),
                        ("A", "2024-03-01", 10, "RL")])
    r = CU.latest_channel(df).collect()[0]
    assert (r["channel"], r["channel_group"]) == ("RL", "Direct")   # same day: higher txn id wins


def test_visit_numbers(five):
    got = {(r["customer_id"], r["txn_id"]): r["visit_number"] for r in CU.visit_numbers(five).collect()}
    assert [got[("P5", i)] for i in (8, 9, 10, 11)] == [1, 2, 3, 4]

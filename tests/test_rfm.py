"""RFM features, quintile scores (golden values), segment thresholds and
exactness of the scalable (cell) paths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SNAP, by_id, txn_df
from tidemark.functions import segment_name
from tidemark.operators import customers as CU
from tidemark.operators import quantiles as Q
from tidemark.operators import rfm as RF
from tidemark.operators.selection import select_positions


def test_rfm_features_small(small):
    got = by_id(CU.rfm_features(small, SNAP))
    assert (got["K1"]["recency"], got["K1"]["frequency"], got["K1"]["monetary"]) == (338, 2, 1030.0)
    assert (got["K2"]["recency"], got["K2"]["frequency"], got["K2"]["monetary"]) == (408, 1, 260.0)
    assert (got["K3"]["recency"], got["K3"]["frequency"], got["K3"]["monetary"]) == (265, 3, 2900.0)


def test_rfm_scores_small(small):
    got = by_id(RF.rfm_scores(CU.rfm_features(small, SNAP)))
    assert [got[c]["rfm_segment"] for c in ("K1", "K2", "K3")] == ["333", "111", "555"]
    assert [got[c]["rfm_score"] for c in ("K1", "K2", "K3")] == [9, 3, 15]
    assert got["K3"]["segment"] == "Champions" and got["K2"]["segment"] == "Lost"


def test_rfm_scores_five(five):
    got = by_id(RF.rfm_scores(CU.rfm_features(five, SNAP)))
    want = {"P1": (3, 3, 2), "P2": (1, 1, 1), "P3": (4, 4, 5), "P4": (2, 2, 4),
            "P5": (5, 5, 3)}
    for c, (r, f, m) in want.items():
        assert (got[c]["r_score"], got[c]["f_score"], got[c]["m_score"]) == (r, f, m), c
    assert got["P3"]["rfm_score"] == 13 and got["P5"]["rfm_score"] == 13


@pytest.mark.parametrize("score,name", [(15, "Champions"), (13, "Champions"), (12, "Loyal Customers"),
                                        (10, "Loyal Customers"), (9, "Potential Loyalists"),
                                        (7, "Potential Loyalists"), (6, "At Risk"), (4, "At Risk"),
                                        (3, "Lost")])
def test_segment_thresholds(spark, score, name):
    df = spark.createDataFrame([(score,)], "s int")
    assert df.select(segment_name("s")).collect()[0][0] == name


def test_single_customer_gets_valid_scores(spark):
    one = txn_df(spark, [("X", "2024-01-01", 100, "WEB")])
    r = RF.rfm_scores(CU.rfm_features(one, SNAP)).collect()[0]
    assert 1 <= r["r_score"] <= 5 and r["f_score"] == 1 and 3 <= r["rfm_score"] <= 15


def test_strict_mode_raises_on_tied_edges(spark):
    one = txn_df(spark, [("X", "2024-01-01", 100, "WEB")])
    with pytest.raises(RF.TiedEdgesError):
        RF.rfm_scores(CU.rfm_features(one, SNAP), strict=True)


def _pandas_like_edges(vals, q):
    v = np.sort(np.asarray(vals, dtype=float))
    return [float(np.percentile(v, 100.0 * i / q)) for i in range(1, q)]


def test_quantile_edges_match_linear_interpolation(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.gamma(2.0, 500.0, 997), 2)
    df = spark.createDataFrame([(float(x),) for x in vals], "v double")
    got = Q.quantile_edges(df, "v", 5)
    assert np.allclose(got, _pandas_like_edges(vals, 5), rtol=0, atol=1e-9)


@pytest.mark.parametrize("tied", [0.0, 0.9])
def test_order_statistics_and_ranks_are_exact(spark, tied):
    """Edges, boundaries and positions against NumPy, with a hot value."""
    rng = np.random.default_rng(11)
    n = 3000
    freq = np.where(rng.random(n) < 0.6, 1, rng.integers(2, 9, n))  # a dominant frequency
    money = np.where(rng.random(n) < tied, 50.0, np.round(rng.gamma(2.0, 300.0, n), 2))
    df = spark.createDataFrame([(int(i), int(f), float(m), int(i % 97)) for i, (f, m) in enumerate(zip(freq, money))],
                               "customer_id long, frequency long, monetary double, recency long").repartition(6)
    assert np.allclose(Q.quantile_edges(df, "monetary", 5), _pandas_like_edges(money, 5), atol=1e-9)
    order = sorted(range(n), key=lambda i: (freq[i], i))
    rank = {c: k + 1 for k, c in enumerate(order)}
    got = {r[0]: r[1] for r in Q.global_row_number(df, ["frequency", "customer_id"]).select("customer_id", "rn").collect()}
    assert got == rank
    for r in RF.rfm_scores(df).collect():
        k = rank[r["customer_id"]] - 1
        assert r["f_score"] == 1 + sum(5 * k > i * (n - 1) for i in range(1, 5))


def test_tied_values_are_one_row(spark):
    """90% of the rows tied: the counted table has one row for them."""
    df = spark.range(100_000).select(F.when(F.col("id") % 10 != 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("v"))
    n, got = select_positions(df, {"v": ("v",)}, {"v": lambda n: [0, 1, 2, 60_000, 90_000, n - 1]})
    assert n == {"v": 100_000}
    vals = sorted(7.0 if i % 10 else float(i) for i in range(100_000))
    assert got["v"] == {p: vals[p] for p in (0, 1, 2, 60_000, 90_000, 99_999)}


def test_no_single_partition_over_customers(spark):
    """The plan of the scores has no exchange to one partition."""
    df = spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") % 7).alias("frequency"),
                                  (F.col("id") % 31).alias("recency"), F.col("id").cast("double").alias("monetary"))
    plan = RF.rfm_scores(df, persist=False)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_partition_invariance(spark, five):
    base = by_id(RF.rfm_scores(CU.rfm_features(five, SNAP)))
    for p in (1, 4, 16):
        got = by_id(RF.rfm_scores(CU.rfm_features(five.repartition(p), SNAP)))
        assert {k: v["rfm_segment"] for k, v in got.items()} == {k: v["rfm_segment"] for k, v in base.items()}


def test_analysis_properties(spark):
    """E8 on the smallest test tables: one row per customer, one-timers +
    repeaters = customers, quartile levels balanced, labels consistent."""
    from tidemark.plans import catalog as K
    sf = "/root/testdata/sf0.001"
    rows = K.analysis(spark, sf).collect()
    n = K.features(spark, sf).count()
    assert len(rows) == n == len({r["customer_id"] for r in rows})
    groups = {r["group"] for r in rows}
    assert groups <= {"onetimer", "repeater"}
    levels = [r["clv_level"] for r in rows]
    for lab in ("Low", "Mid", "High", "Top"):
        assert abs(levels.count(lab) - n / 4) <= 2
    for r in rows:
        assert 3 <= r["rfm_score"] <= 15 and r["clv"] >= 0
        if r["mismatch"].startswith("Overrated"):
            assert r["segment"] in ("Champions", "Loyal Customers") and r["clv_level"] == "Low"
        if r["mismatch"].startswith("Underrated"):
            assert r["segment"] in ("At Risk", "Lost") and r["clv_level"] in ("High", "Top")


def test_analysis_partition_invariance(spark):
    from tidemark.plans import catalog as K
    sf = "/root/testdata/sf0.001"
    base = {r["customer_id"]: (r["clv_level"], r["mismatch"], round(r["clv"], 6)) for r in K.analysis(spark, sf).collect()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for p in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", p)
            spark.catalog.clearCache()
            got = {r["customer_id"]: (r["clv_level"], r["mismatch"], round(r["clv"], 6))
                   for r in K.analysis(spark, sf).collect()}
            assert got == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)

"""A house account holding a third of all visits: the skew-safe operators
must give exactly the brute-force (pandas) answers with cells forced small."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import customers as CU
from tidemark.operators import rfm as RF

SNAP = "2024-12-31"


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(21)
    n_other, n_hot = 1400, 700
    cust = np.concatenate([rng.integers(1, 400, n_other), np.zeros(n_hot, dtype=int)])
    days = rng.integers(0, 360, n_other + n_hot)
    secs = rng.integers(0, 86400, n_other + n_hot)
    ts = pd.to_datetime("2024-01-01") + pd.to_timedelta(days, "D") + pd.to_timedelta(secs, "s")
    rev = np.round(rng.gamma(2.0, 100.0, n_other + n_hot) + 0.01, 2)
    pdf = pd.DataFrame({"txn_id": np.arange(len(cust)), "customer_id": cust, "arrival_ts": ts, "revenue": rev,
                        "channel": rng.choice(["WEB", "GDS", "RL", "ZZZ"], len(cust))})
    df = spark.createDataFrame([(int(a), int(b), str(c), float(d), e) for a, b, c, d, e in pdf.itertuples(index=False)],
                               "txn_id long, customer_id long, t string, revenue double, channel string")
    df = df.select("txn_id", "customer_id", F.col("t").cast("timestamp_ntz").alias("arrival_ts"), "revenue", "channel")
    return pdf, df


def test_visit_numbers_hot_customer(skewed):
    pdf, df = skewed
    got = {r["txn_id"]: r["visit_number"] for r in CU.visit_numbers(df).collect()}
    exp = pdf.sort_values(["customer_id", "arrival_ts", "txn_id"]).groupby("customer_id").cumcount() + 1
    assert all(got[t] == v for t, v in exp.items())


def test_features_hot_customer(skewed):
    pdf, df = skewed
    f = {r["customer_id"]: r for r in CU.customer_features(df, SNAP).collect()}
    hot = pdf[pdf.customer_id == 0]
    r = f[0]
    assert r["visit_count"] == len(hot)
    assert abs(r["monetary"] - hot.revenue.sum()) < 1e-6
    last = hot.sort_values(["arrival_ts", "txn_id"]).iloc[-1]
    assert r["latest_channel"] == last.channel
    d = hot.assign(day=hot.arrival_ts.dt.normalize()).groupby("day").revenue.sum()
    assert r["days_frequency"] == len(d) - 1
    assert abs(r["monetary_value"] - d.iloc[1:].mean()) < 1e-6


def test_rfm_hot_frequency(skewed, spark):
    pdf, df = skewed
    rows = RF.rfm_scores(CU.rfm_features(df, SNAP)).collect()
    order = sorted(rows, key=lambda r: (r["frequency"], r["customer_id"]))
    n = len(order)
    for k, r in enumerate(order):
        assert r["f_score"] == 1 + sum(5 * k > i * (n - 1) for i in range(1, 5))

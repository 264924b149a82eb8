"""The BG/NBD series of long horizons, summed over batches."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.models import bgnbd as BG
from tidemark.models.bgnbd import BgNbdParams

P = BgNbdParams(r=2.71, alpha=0.5, a=1.355, b=2.351)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_long_series_have_no_lambda_per_term(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1.0)], "x double, tx double, T double")
    assert "lambda" not in _plan(df.select(BG.expected_purchases(P, 3650, "x", "tx", "T")))
    assert "lambda" in _plan(df.select(BG.expected_purchases(replace(P, alpha=255.4), 365, "x", "tx", "T")))


def test_batches_equal_the_native_series(spark):
    rng = np.random.default_rng(3)
    rows = [(float(rng.integers(0, 60)), float(t)) for t in rng.integers(1, 900, 200)] + [(None, 3.0), (2.0, None), (0.0, 0.0), (400.0, 2.0)]
    df = spark.createDataFrame(rows, "x double, T double")
    A, B = P.a + P.b - 1.0 - P.r, P.a - 1.0
    C = F.lit(P.a + P.b - 1.0) + F.col("x")
    z = F.lit(365.0) / (F.lit(P.alpha) + F.col("T") + 365.0)
    got = df.select(BG.hyp2f1_series(A, B, C, z).alias("native"), BG.hyp2f1_batches(A, B, C, z).alias("batches")).collect()
    assert sum(r.native is None for r in got) == sum(r.batches is None for r in got) == 2
    for r in got:
        assert r.native is None or r.batches == pytest.approx(r.native, rel=1e-13)
    assert df.limit(0).select(BG.expected_purchases(P, 3650, "x", F.lit(0.0), "T")).count() == 0


def test_sum_series_over_chunks_and_blocks():
    rng = np.random.default_rng(4)
    z = 1.0 - 10.0 ** -rng.uniform(0.2, 3.5, 150)
    C = rng.uniform(1.1, 50.0, 150)
    n = np.ceil(np.log(BG.SERIES_TOL) / np.log(z)) + 24
    got = BG.sum_series(-0.004, 0.355, C, z, n)
    for i in range(0, 150, 7):
        k = np.arange(int(n[i]), dtype=float)
        want = 1.0 + np.cumprod((-0.004 + k) * (0.355 + k) / ((C[i] + k) * (k + 1.0)) * z[i]).sum()
        assert got[i] == pytest.approx(want, rel=1e-13)
    # lengths of zero add nothing; z of 0 is the first term alone
    assert BG.sum_series(0.3, 0.4, np.array([1.5]), np.array([0.0]), np.array([2.0])).tolist() == [1.0]

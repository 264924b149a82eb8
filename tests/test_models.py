"""Model scoring formulas and the Spark-driven fitters."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.models import BgNbdParams, CoxParams, GammaGammaParams
from tidemark.models import bgnbd as BG
from tidemark.models import cox as CX
from tidemark.models import gamma_gamma as GG
from tidemark.models.optim import digamma


def test_bgnbd_paper_point(spark):
    """Published worked example: E[X(39)] about 1.23 for x=2, t_x=30.43,
    T=38.86 with the two-digit parameters (0.24, 4.41, 0.79, 2.43)."""
    p = BgNbdParams(r=0.24, alpha=4.41, a=0.79, b=2.43)
    df = spark.createDataFrame([(2.0, 30.43, 38.86)], "x double, tx double, T double")
    v = df.select(BG.expected_purchases(p, 39, "x", "tx", "T")).collect()[0][0]
    assert abs(v - 1.2274) < 5e-4


def _direct(p, t, x, tx, T, terms=20000):
    a_, b_, c_ = p.r + x, p.b + x, p.a + p.b + x - 1
    z = t / (p.alpha + T + t)
    s, term = 1.0, 1.0
    for k in range(terms):
        term *= (a_ + k) * (b_ + k) / ((c_ + k) * (k + 1)) * z
        s += term
    first = (p.a + p.b + x - 1) / (p.a - 1)
    num = 1 - ((p.alpha + T) / (p.alpha + T + t)) ** (p.r + x) * s
    den = 1 + (x > 0) * p.a / (p.b + x - 1) * ((p.alpha + T) / (p.alpha + tx)) ** (p.r + x)
    return first * num / den


def test_euler_series_matches_direct_form(spark):
    p = BgNbdParams(r=2.71, alpha=255.4, a=1.355, b=2.351)
    pts = [(0.0, 0.0, 30.0), (1.0, 100.0, 300.0), (4.0, 250.0, 364.0), (12.0, 700.0, 720.0)]
    df = spark.createDataFrame(pts, "x double, tx double, T double")
    got = [r[0] for r in df.select(BG.expected_purchases(p, 365, "x", "tx", "T")).collect()]
    for g, (x, tx, T) in zip(got, pts):
        assert abs(g - _direct(p, 365, x, tx, T)) < 1e-9 * max(1, abs(g))


def test_small_alpha_covers_every_repeater(spark):
    """Own frequency, t_x and T of each customer; z from far below to close to 1."""
    from dataclasses import replace

    from tidemark.plans import catalog as CAT
    params = [replace(CAT.FIXED_BGNBD, alpha=a) for a in CAT.SMALL_ALPHAS]
    pts = [(1.0, 0.0, 1.0), (2.0, 1.0, 2.0), (5.0, 3.0, 4.0), (3.0, 40.0, 90.0)]
    df = spark.createDataFrame(pts, "x double, tx double, T double")
    for p in params:
        for (x, tx, T), r in zip(pts, df.select(BG.expected_purchases(p, 3650, "x", "tx", "T")).collect()):
            want = _direct(p, 3650, x, tx, T, 200_000)
            assert abs(r[0] - want) < 1e-8 * max(1, abs(want))
    sf = "/root/testdata/sf0.001"
    got = {r.customer_id: r for r in CAT.REGISTRY["bgnbd_expected_small_alpha_customers"](spark, sf).collect()}
    own = {r.customer_id: (r.frequency, r.t_x, r["T"]) for r in CAT.repeater_summary(spark, sf).collect()}
    assert own and {c: (r.frequency, r.t_x, r["T"]) for c, r in got.items()} == own
    for c in sorted(own)[::max(1, len(own) // 20)]:
        for p, v in zip(params, (got[c].expected_0, got[c].expected_1)):
            want = _direct(p, 3650, *(float(v) for v in own[c]))
            assert abs(v - want) < 2e-6 * max(1, abs(want))


def test_p_alive(spark):
    p = BgNbdParams(r=2.71, alpha=255.4, a=1.355, b=2.351)
    df = spark.createDataFrame([(0.0, 0.0, 100.0), (2.0, 90.0, 100.0)], "x double, tx double, T double")
    v = [r[0] for r in df.select(BG.p_alive(p, "x", "tx", "T")).collect()]
    assert v[0] == 1.0 and 0 < v[1] < 1
    want = 1 / (1 + p.a / (p.b + 1) * ((p.alpha + 100) / (p.alpha + 90)) ** (p.r + 2))
    assert abs(v[1] - want) < 1e-12


def test_gamma_gamma_expected_value(spark):
    g = GammaGammaParams(p=2.0, q=4.0, v=375000.0)
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 100000.0)], "x double, m double")
    v = [r[0] for r in df.select(GG.expected_value(g, "x", "m")).collect()]
    assert v[0] == pytest.approx(250000.0)
    w = 6.0 / 9.0
    assert v[1] == pytest.approx((1 - w) * 250000.0 + w * 100000.0)


def test_cox_hazard_interpolation():
    c = CoxParams(("z",), (0.0,), (0.0,), ((10.0, 1.0), (20.0, 3.0)))
    assert c.cumulative_hazard(15.0) == 2.0 and c.cumulative_hazard(25.0) == 3.0
    assert c.cumulative_hazard(5.0) == 0.5
    assert CoxParams(("z",), (0.0,), (0.0,), ((10.0, 1.0), (20.0, 3.0)), "step").cumulative_hazard(15.0) == 1.0


def test_digamma():
    for x, want in [(1.0, -0.5772156649015329), (0.5, -1.9635100260214235), (10.0, 2.251752589066721)]:
        assert abs(digamma(x) - want) < 1e-10


def test_cox_fit_recovers_coefficient(spark):
    from tidemark.models import fit_cox
    rng = np.random.default_rng(7)
    n, beta = 3000, 0.8
    z = rng.normal(0, 1, n)
    t = rng.exponential(1.0 / (0.01 * np.exp(beta * z)))
    c = rng.exponential(150.0, n)
    dur = np.ceil(np.minimum(t, c)).astype(int) + 1
    ev = (t <= c).astype(int)
    df = spark.createDataFrame([(int(d), int(e), float(x)) for d, e, x in zip(dur, ev, z)],
                               "duration long, event long, z double")
    models, mets = fit_cox.fit(df, ("z",))
    m = models[fit_cox.POOLED]
    assert abs(m.coef[0] - beta) < 0.1 and mets[fit_cox.POOLED]["converged"]
    H = [h for _, h in m.baseline]
    assert all(b >= a for a, b in zip(H, H[1:]))


def test_cox_loglik_matches_fit(spark):
    from tidemark.models import fit_cox
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(1, 30)), int(rng.random() < 0.6), float(rng.normal())) for _ in range(400)]
    df = spark.createDataFrame(rows, "duration long, event long, z double")
    models, mets = fit_cox.fit(df, ("z",))
    m = models[fit_cox.POOLED]
    ll = CX.efron_loglik(df, m, cols=["z"]).collect()[0]["log_likelihood"]
    assert ll == pytest.approx(mets[fit_cox.POOLED]["log_likelihood"], rel=1e-9)


def _simulate_bgnbd(rng, n, r, alpha, a, b, T_days):
    lam = rng.gamma(r, 1.0 / alpha, n)
    p = rng.beta(a, b, n)
    out = []
    for i in range(n):
        t, x, last, alive = 0.0, 0, 0.0, True
        while alive:
            t += rng.exponential(1.0 / lam[i])
            if t > T_days:
                break
            x += 1
            last = t
            alive = rng.random() > p[i]
        out.append((float(x), float(last), float(T_days)))
    return out


def test_bgnbd_fit_recovers_parameters(spark):
    from tidemark.models import fit_bgnbd
    rng = np.random.default_rng(42)
    rows = _simulate_bgnbd(rng, 4000, 0.5, 20.0, 0.8, 2.5, 200.0)
    rows = [(x, float(math.floor(tx)), T) for x, tx, T in rows]
    df = spark.createDataFrame(rows, "frequency double, t_x double, T double")
    p, res, m = fit_bgnbd.fit(df, penalizer=0.0)
    assert m["converged"]
    assert abs(p.r - 0.5) / 0.5 < 0.3 and abs(p.alpha - 20.0) / 20.0 < 0.4
    assert abs(p.a - 0.8) / 0.8 < 0.5 and abs(p.b - 2.5) / 2.5 < 0.6
    ll_fit = fit_bgnbd.log_likelihood(df, p)
    ll_start = fit_bgnbd.log_likelihood(df, BgNbdParams(1.0, 1.0 / m["scale"], 1.0, 1.0))
    assert ll_fit > ll_start


def test_gamma_gamma_fit_recovers_parameters(spark):
    from tidemark.models import fit_gamma_gamma
    rng = np.random.default_rng(9)
    p_, q_, v_ = 6.0, 4.0, 15.0
    n = 3000
    nu = rng.gamma(q_, 1.0 / v_, n)
    x = rng.integers(1, 10, n)
    m = [float(np.mean(rng.gamma(p_, 1.0 / nu[i], x[i]))) for i in range(n)]
    df = spark.createDataFrame([(float(a), b) for a, b in zip(x, m)], "frequency double, monetary_value double")
    g, res, met = fit_gamma_gamma.fit(df, penalizer=0.0)
    assert abs(g.p - p_) / p_ < 0.25 and abs(g.q - q_) / q_ < 0.35
    assert abs(g.population_mean - v_ * p_ / (q_ - 1)) / (v_ * p_ / (q_ - 1)) < 0.1


def _brute_c(rows):
    conc = ties = pairs = 0
    for di, ei, vi in rows:
        if not ei:
            continue
        for dj, ej, vj in rows:
            if dj > di or (dj == di and ej == 0):
                pairs += 1
                conc += vi > vj
                ties += vi == vj
    return pairs, conc, ties


def test_concordance_cells_match_brute_force(spark):
    from tidemark.models.concordance import concordance
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(1, 40)), int(rng.random() < 0.5), float(rng.integers(0, 60))) for _ in range(500)]
    rows += [(int(rng.integers(1, 40)), int(rng.random() < 0.5), 7.0) for _ in range(150)]  # hot tied score
    df = spark.createDataFrame(rows, "d long, e long, v double")
    pairs, conc, ties = _brute_c(rows)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for cells in ("1", "2", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", cells)
            r = concordance(df, "d", "e", "v").collect()[0]
            assert (r["pairs"], r["concordant"], r["tied"]) == (pairs, conc, ties), cells
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    r = concordance(df.limit(0), "d", "e", "v").collect()[0]
    assert r["pairs"] == 0 and r["concordance_index"] is None


def test_concordance_counting_is_vectorised():
    """One cell of 200,000 rows within seconds."""
    import time
    from tidemark.models.concordance import concordant_inside
    rng = np.random.default_rng(2)
    n = 200_000
    one = np.ones(n)
    start = time.time()
    ev = (rng.random(n) < 0.5).astype(float)
    got = concordant_inside(rng.normal(size=n), rng.integers(1, 2000, n).astype(float), one, one - ev, ev)
    assert time.time() - start < 20 and 0 < got < n * n


def test_efron_sums_in_closed_form():
    import math
    import time
    from tidemark.models.fit_cox import tie_sums
    for m, R0, D0 in ((1, 5.0, 2.0), (16, 40.0, 12.0), (17, 20.0, 20.0), (500, 900.0, 600.0), (5000, 1e6, 40.0), (300, 300.0, 300.0), (40, 1e9, 3.0)):
        l = np.arange(m)
        c = m * R0 / D0
        want = (np.log(R0 - l * D0 / m).sum(), (1 / (c - l)).sum(), (1 / (c - l) ** 2).sum())
        assert np.allclose(tie_sums(float(m), R0, D0), want, rtol=1e-9, atol=1e-12), (m, R0, D0)
    start = time.time()
    assert all(map(math.isfinite, tie_sums(1e7, 3e7, 1.1e7))) and time.time() - start < 1


def test_efron_log_sum_column(spark):
    from tidemark.models.cox import efron_log_sum
    rows = [(float(m), R0, D0) for m, R0, D0 in ((1, 5.0, 2.0), (16, 40.0, 12.0), (17, 20.0, 20.0), (500, 900.0, 600.0), (1e7, 3e7, 1.1e7))]
    df = spark.createDataFrame(rows, "m double, r double, d double")
    for row in df.select("*", efron_log_sum(F.col("m"), F.col("r"), F.col("d")).alias("s")).collect():
        l = np.arange(int(row.m))
        assert abs(row.s - np.log(row.r - l * row.d / row.m).sum()) < 1e-9 * max(1.0, abs(row.s))


def test_failed_line_search_is_not_convergence():
    from tidemark.models.optim import bfgs, newton
    wrong = lambda pts: [(float(p @ p), -2 * p) for p in pts]
    r = bfgs(wrong, [1.0, 2.0])
    assert not r.converged and r.reason == "line search"
    right = lambda pts: [(float(p @ p), 2 * p, 2 * np.eye(2)) for p in pts]
    r = newton(right, [1.0, 2.0])
    assert r.converged and r.reason == "gradient" and r.evaluations <= 4
    drift = lambda pts: [(float(np.exp(-p[0])), np.array([-np.exp(-p[0])]), np.array([[np.exp(-p[0])]])) for p in pts]
    r = newton(drift, [0.0])
    assert not r.converged and r.reason == "drifting"


def test_fitted_report_has_every_customer(spark, monkeypatch):
    """Every customer; scores and segments; CLV of repeaters recomputed from the fitted parameters."""
    from tidemark.plans import catalog as CAT
    sf = "/root/testdata/sf0.001"
    models = CAT.fitted_models(spark, sf)
    monkeypatch.setattr(CAT, "fitted_models", lambda *_: models)
    got = {r.customer_id: r for r in CAT.REGISTRY["rfm_vs_clv_fitted_report"](spark, sf).collect()}
    feats = {r.customer_id: r for r in CAT.features(spark, sf).collect()}
    assert got and got.keys() == feats.keys()
    b, g = models.bgnbd, models.gamma_gamma
    seen = 0
    for c, f in sorted(feats.items()):
        if f.visit_count > 1 and f.days_frequency > 0 and f.monetary_value > 0 and seen < 20:
            seen += 1
            x, mv = float(f.days_frequency), float(f.monetary_value)
            w = g.p * x / (g.p * x + g.q - 1)
            want = _direct(b, CAT.XDAYS, x, float(f.t_x), float(f["T"]), 5000) * ((1 - w) * g.population_mean + w * mv)
            assert abs(float(got[c].clv) - want) <= 0.01 + 1e-6 * abs(want)
    assert seen
    rfm = {r.customer_id: r for r in CAT.REGISTRY["rfm_scores"](spark, sf).collect()}
    assert all((r.rfm_score, r.segment) == (rfm[c].rfm_score, rfm[c].segment) for c, r in got.items())

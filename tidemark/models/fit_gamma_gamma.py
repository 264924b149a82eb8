"""Gamma-Gamma fit as iterative Spark aggregates.

Per row (x = repeat count, m = mean repeat spend):
  ll = lgamma(px+q) - lgamma(px) - lgamma(q) + q ln v + (px-1) ln m
       + px ln x - (px+q) ln(xm+v)
Only sum(ln(xm+v)) and sum(1/(xm+v)) depend on both rows and parameters;
they are aggregated per distinct x (for every line-search candidate in one
job). Everything else depends on x alone and is evaluated on the driver
from the x histogram. Objective: -mean ll + penalizer * (p^2+q^2+v^2),
minimised over log-parameters.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gamma_gamma import GammaGammaParams
from .optim import FitResult, bfgs, digamma, newton, trigamma


def fit_rows(summary: DataFrame, x: str = "frequency", m: str = "monetary_value") -> DataFrame:
    """rows a spend model can use (positive frequency and spend)."""
    return summary.where((F.col(x) > 0) & (F.col(m) > 0)).select(
        F.col(x).cast("double").alias("x"), F.col(m).cast("double").alias("m"))


def fit(summary: DataFrame, penalizer: float = 0.0, x: str = "frequency", m: str = "monetary_value",
        init=None, max_iter: int = 200, reliable: bool = True, method: str | None = None
        ) -> tuple[GammaGammaParams, FitResult, dict]:
    """Fit p, q, v. Default: Newton (exact Hessian; every term is a per-x
    sum) from the moment-matched start; with a caller-supplied ``init`` the
    default is BFGS, which is more robust from arbitrary starting points."""
    from ..session import release, stable_base
    rows = stable_base(fit_rows(summary, x, m), reliable)
    hist = rows.groupBy("x").agg(F.count(F.lit(1)).alias("c"), F.sum(F.log("m")).alias("slm"),
                                 F.sum("m").alias("sm")).collect()
    xs = np.array([r["x"] for r in hist])
    cs = np.array([r["c"] for r in hist], dtype=float)
    slm = np.array([r["slm"] for r in hist])
    n = float(cs.sum())
    if n == 0:
        raise ValueError("no rows with positive frequency and spend")
    order = {v: i for i, v in enumerate(xs)}
    if method is None:
        method = "newton" if init is None else "bfgs"
    if init is None:
        # Start where the population mean v p / (q - 1) equals the observed
        # mean spend (same optimum, fewer steps than starting at ones).
        init = (1.0, 3.0, 2.0 * float(sum(r["sm"] for r in hist)) / n)

    def fg_batch(points):
        vs = [math.exp(pt[2]) if pt[2] < 700 else math.inf for pt in points]
        sums = []
        for k, v in enumerate(vs):
            d = F.col("x") * F.col("m") + F.lit(v)
            sums += [F.sum(F.log(d)).alias(f"l{k}"), F.sum(1.0 / d).alias(f"i{k}"), F.sum(1.0 / (d * d)).alias(f"j{k}")]
        per = rows.groupBy("x").agg(*sums).collect()
        Ls = {(r["x"], k): (r[f"l{k}"], r[f"i{k}"], r[f"j{k}"]) for r in per for k in range(len(vs))}
        out = []
        for k, pt in enumerate(points):
            if not np.all(np.abs(pt) < 300):
                out.append((math.inf, np.full(3, math.nan), np.full((3, 3), math.nan)))
                continue
            p, q, v = (math.exp(t) for t in pt)
            L = np.zeros(len(xs))
            I = np.zeros(len(xs))
            J = np.zeros(len(xs))
            for xv_, j in order.items():
                L[j], I[j], J[j] = Ls.get((xv_, k), (0.0, 0.0, 0.0))
            px = p * xs
            ll = (cs * (np.array([math.lgamma(a) for a in px + q]) - np.array([math.lgamma(a) for a in px])
                        - math.lgamma(q) + q * math.log(v) + px * np.log(xs))
                  + (px - 1.0) * slm - (px + q) * L).sum()
            psi_pxq = np.array([digamma(a) for a in px + q])
            psi_px = np.array([digamma(a) for a in px])
            dp = (cs * xs * (psi_pxq - psi_px + np.log(xs)) + xs * slm - xs * L).sum()
            dq = (cs * (psi_pxq - digamma(q) + math.log(v)) - L).sum()
            dv = (cs * q / v - (px + q) * I).sum()
            f = -ll / n + penalizer * (p * p + q * q + v * v)
            th = np.array([p, q, v])
            g_th = -np.array([dp, dq, dv]) / n + 2 * penalizer * th
            grad = th * g_th
            t1_pxq = np.array([trigamma(a) for a in px + q])
            t1_px = np.array([trigamma(a) for a in px])
            h_pp = (cs * xs * xs * (t1_pxq - t1_px)).sum()
            h_pq = (cs * xs * t1_pxq).sum()
            h_pv = -(xs * I).sum()
            h_qq = (cs * (t1_pxq - trigamma(q))).sum()
            h_qv = (cs / v - I).sum()
            h_vv = (-cs * q / (v * v) + (px + q) * J).sum()
            h_th = -np.array([[h_pp, h_pq, h_pv], [h_pq, h_qq, h_qv], [h_pv, h_qv, h_vv]]) / n \
                + 2 * penalizer * np.eye(3)
            hess = np.outer(th, th) * h_th + np.diag(grad)
            out.append((f if math.isfinite(f) else math.inf, grad, hess))
        return out

    x0 = np.log(np.asarray(init, dtype=float))
    if method == "newton":
        res = newton(fg_batch, x0, max_iter=max_iter)
    else:
        res = bfgs(lambda pts: [(f, g) for f, g, _ in fg_batch(pts)], x0, max_iter=max_iter)
    p, q, v = (float(math.exp(t)) for t in res.x)
    release(rows)
    # q <= 1 means the spend distribution has no finite mean: predictions
    # from such a fit are not usable (flagged, not hidden).
    metrics = {"n_customers": int(n), "log_likelihood_mean": -res.fun + penalizer * (p * p + q * q + v * v),
               "penalizer_coef": penalizer, "iterations": res.iterations, "converged": res.converged,
               "gradient": res.gradient, "reason": res.reason,
               "finite_mean": q > 1.0}
    return GammaGammaParams(p=p, q=q, v=v), res, metrics


def log_likelihood(summary: DataFrame, g: GammaGammaParams, x: str = "frequency",
                   m: str = "monetary_value") -> float:
    """Total log-likelihood at fixed parameters over the usable rows: the
    row-dependent sums per x from Spark, the x-only terms on the driver."""
    rows = fit_rows(summary, x, m)
    per = rows.groupBy("x").agg(F.count(F.lit(1)).alias("c"), F.sum(F.log("m")).alias("slm"),
                                F.sum(F.log(F.col("x") * F.col("m") + F.lit(g.v))).alias("l")).collect()
    tot = 0.0
    for r in per:
        xv, c = r["x"], r["c"]
        px = g.p * xv
        tot += (c * (math.lgamma(px + g.q) - math.lgamma(px) - math.lgamma(g.q) + g.q * math.log(g.v)
                     + px * math.log(xv)) + (px - 1.0) * r["slm"] - (px + g.q) * r["l"])
    return tot

"""M8: BG/NBD fit as iterative Spark aggregates.

Per-customer log-likelihood (x, t_x, T):
  A1 + A2 + ln(exp(A3) + [x>0] exp(A4)),
  A1 = lgamma(r+x) - lgamma(r) + r ln alpha,
  A2 = lgamma(a+b) + lgamma(b+x) - lgamma(b) - lgamma(a+b+x),
  A3 = -(r+x) ln(alpha+T),  A4 = ln a - ln(b+x-1) - (r+x) ln(alpha+t_x).
A1 and A2 depend on x alone (driver, from the x histogram); the last term,
its gradient and its Hessian are one pass per step (partial sums per
partition) over customers pre-grouped by equal (x, t_x, T) with weights.
Default optimiser: Newton with the exact Hessian (gradient steps where it
is not positive definite); ``method="bfgs"`` is available. Times are rescaled so the
largest T is 10 while fitting (alpha is rescaled back afterwards).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bgnbd import BgNbdParams
from .optim import FitResult, bfgs, digamma, newton, trigamma


def fit(summary: DataFrame, penalizer: float = 0.0, x: str = "frequency", t_x: str = "t_x",
        T: str = "T", init=(1.0, 1.0, 1.0, 1.0), max_iter: int = 300, reliable: bool = True,
        method: str = "newton") -> tuple[BgNbdParams, FitResult, dict]:
    from ..session import release, stable_base
    grouped = stable_base(
        summary.groupBy(F.col(x).cast("double").alias("x"), F.col(t_x).cast("double").alias("tx"),
                        F.col(T).cast("double").alias("T"))
        .agg(F.count(F.lit(1)).cast("double").alias("w")), reliable)
    stats = grouped.agg(F.max("T").alias("tmax"), F.sum("w").alias("n")).collect()[0]
    if not stats["n"]:
        raise ValueError("empty summary")
    scale = 10.0 / stats["tmax"] if stats["tmax"] else 1.0
    n = float(stats["n"])
    hist = grouped.groupBy("x").agg(F.sum("w").alias("c")).collect()
    xs = np.array([r["x"] for r in hist])
    cs = np.array([r["c"] for r in hist])

    # Hessian entries of the per-customer term, in (r, alpha, a, b) order.
    H_KEYS = ("rr", "ral", "alal", "aa", "bb")

    def fgh_batch(points):
        P = [tuple(math.exp(t) for t in pt) for pt in points]
        per = ("L", "r", "al", "a", "b") + tuple("h" + k for k in H_KEYS) + ("o_rr", "o_ral", "o_ra", "o_rb",
                                                                           "o_alal", "o_ala", "o_alb",
                                                                           "o_aa", "o_ab", "o_bb")
        names = [f"{c}{k}" for k in range(len(P)) for c in per]

        def partial_sums(batches):
            # One row of partial sums per partition for every candidate (added
            # up by Spark): the row-dependent term, its gradient and Hessian.
            acc = np.zeros(len(names))
            w_ = len(per)
            for pdf in batches:
                xv = pdf["x"].to_numpy()
                txv = pdf["tx"].to_numpy() * scale
                Tv = pdf["T"].to_numpy() * scale
                wv = pdf["w"].to_numpy()
                has = xv > 0
                bx = b_shift = None
                for k, (r, al, a, b) in enumerate(P):
                    A3 = -(r + xv) * np.log(al + Tv)
                    bx = b + np.maximum(xv, 1.0) - 1.0
                    with np.errstate(divide="ignore", invalid="ignore"):
                        A4 = np.where(has, math.log(a) - np.log(bx) - (r + xv) * np.log(al + txv), -np.inf)
                    M = np.maximum(A3, A4)
                    L = M + np.log(np.exp(A3 - M) + np.exp(A4 - M))
                    p3, p4 = np.exp(A3 - L), np.exp(A4 - L)
                    g3 = (-np.log(al + Tv), -(r + xv) / (al + Tv), 0.0 * xv, 0.0 * xv)
                    g4 = (-np.log(al + txv), -(r + xv) / (al + txv), np.full_like(xv, 1.0 / a), -1.0 / bx)
                    dlt = [np.where(has, g3[i] - g4[i], 0.0) for i in range(4)]
                    q34 = p3 * p4
                    vals = [
                        (wv * L).sum(),
                        (wv * (p3 * g3[0] + p4 * g4[0])).sum(),
                        (wv * (p3 * g3[1] + p4 * g4[1])).sum(),
                        (wv * p4 / a).sum(),
                        (wv * -p4 / bx).sum(),
                        # weighted second derivatives of A3 / A4
                        0.0,
                        (wv * (-p3 / (al + Tv) - p4 / (al + txv))).sum(),
                        (wv * (p3 * (r + xv) / (al + Tv) ** 2 + p4 * (r + xv) / (al + txv) ** 2)).sum(),
                        (wv * -p4 / (a * a)).sum(),
                        (wv * p4 / (bx * bx)).sum(),
                    ]
                    for i in range(4):
                        for j in range(i, 4):
                            vals.append((wv * q34 * dlt[i] * dlt[j]).sum())
                    acc[w_ * k:w_ * (k + 1)] += vals
            yield pd.DataFrame([acc], columns=names)

        schema = ", ".join(f"{nm} double" for nm in names)
        row = grouped.mapInPandas(partial_sums, schema).agg(*[F.sum(nm).alias(nm) for nm in names]).collect()[0].asDict()
        out = []
        lg = np.vectorize(math.lgamma)
        dg = np.vectorize(digamma)
        tg = np.vectorize(trigamma)
        for k, pt in enumerate(points):
            r, al, a, b = (math.exp(t) for t in pt)
            A1 = lg(r + xs) - math.lgamma(r) + r * math.log(al)
            A2 = math.lgamma(a + b) + lg(b + xs) - math.lgamma(b) - lg(a + b + xs)
            ll = (cs * (A1 + A2)).sum() + row[f"L{k}"]
            dr = (cs * (dg(r + xs) - digamma(r) + math.log(al))).sum() + row[f"r{k}"]
            dal = (cs * r / al).sum() + row[f"al{k}"]
            da = (cs * (digamma(a + b) - dg(a + b + xs))).sum() + row[f"a{k}"]
            db = (cs * (digamma(a + b) + dg(b + xs) - digamma(b) - dg(a + b + xs))).sum() + row[f"b{k}"]
            Hll = np.zeros((4, 4))
            Hll[0, 0] = (cs * (tg(r + xs) - trigamma(r))).sum()
            Hll[0, 1] = (cs / al).sum() + row[f"hral{k}"]
            Hll[1, 1] = (cs * -r / (al * al)).sum() + row[f"halal{k}"]
            t_ab = (cs * (trigamma(a + b) - tg(a + b + xs))).sum()
            Hll[2, 2] = t_ab + row[f"haa{k}"]
            Hll[2, 3] = t_ab
            Hll[3, 3] = (cs * (trigamma(a + b) + tg(b + xs) - trigamma(b) - tg(a + b + xs))).sum() + row[f"hbb{k}"]
            idx = {(0, 0): "rr", (0, 1): "ral", (0, 2): "ra", (0, 3): "rb", (1, 1): "alal", (1, 2): "ala",
                   (1, 3): "alb", (2, 2): "aa", (2, 3): "ab", (3, 3): "bb"}
            for (i, j), nm in idx.items():
                Hll[i, j] += row[f"o_{nm}{k}"]
            Hll = np.triu(Hll) + np.triu(Hll, 1).T
            params = np.array([r, al, a, b])
            f = -ll / n + penalizer * float((params ** 2).sum())
            g_th = -np.array([dr, dal, da, db]) / n + 2 * penalizer * params
            grad = params * g_th
            h_th = -Hll / n + 2 * penalizer * np.eye(4)
            hess = np.outer(params, params) * h_th + np.diag(grad)
            out.append((f if math.isfinite(f) else math.inf, grad, hess))
        return out

    def fg_batch(points):
        return [(f, g) for f, g, _ in fgh_batch(points)]

    x0 = np.log(np.asarray(init, dtype=float))
    res = newton(fgh_batch, x0, max_iter=max_iter) if method == "newton" else bfgs(fg_batch, x0, max_iter=max_iter)
    r, al, a, b = (float(math.exp(t)) for t in res.x)
    release(grouped)
    metrics = {"n_customers": int(n), "distinct_frequencies": len(xs), "scale": scale,
               "objective": res.fun, "penalizer_coef": penalizer, "iterations": res.iterations,
               "converged": res.converged, "gradient": res.gradient, "reason": res.reason}
    return BgNbdParams(r=r, alpha=al / scale, a=a, b=b), res, metrics


def log_likelihood(summary: DataFrame, p: BgNbdParams, x: str = "frequency", t_x: str = "t_x",
                   T: str = "T") -> float:
    """Total log-likelihood at fixed parameters (unscaled times)."""
    import math as _m
    xs = F.col(x).cast("double")
    A3 = -(F.lit(p.r) + xs) * F.log(F.lit(p.alpha) + F.col(T))
    A4 = (F.lit(_m.log(p.a)) - F.log(F.lit(p.b) + F.greatest(xs, F.lit(1.0)) - 1.0)
          - (F.lit(p.r) + xs) * F.log(F.lit(p.alpha) + F.col(t_x)))
    M = F.when(xs > 0, F.greatest(A3, A4)).otherwise(A3)
    L = M + F.log(F.exp(A3 - M) + F.when(xs > 0, F.exp(A4 - M)).otherwise(F.lit(0.0)))
    row = summary.agg(F.sum(L).alias("L")).collect()[0]
    hist = summary.groupBy(xs.alias("x")).count().collect()
    tot = row["L"] or 0.0
    for h in hist:
        xv, c = h["x"], h["count"]
        tot += c * (_m.lgamma(p.r + xv) - _m.lgamma(p.r) + p.r * _m.log(p.alpha) + _m.lgamma(p.a + p.b)
                    + _m.lgamma(p.b + xv) - _m.lgamma(p.b) - _m.lgamma(p.a + p.b + xv))
    return tot

"""M1/M2/M3/M7: Cox proportional hazards fit (Efron ties) as Spark aggregates.

Each Newton step is ONE Spark job: rows grouped by (model group, duration)
with the sums the partial likelihood needs (events, sum exp(b'z), its first
and second moments, the same over events). Per-channel models share the job
(the channel is part of the grouping key; each row uses its channel's b).
The driver turns the per-duration table (bounded by the number of distinct
durations) into risk-set suffix sums, the Efron log-likelihood, gradient
and Hessian. Covariates are standardised while fitting; coefficients are
reported in original units with the training means for centring. The
baseline cumulative hazard (Breslow) comes from the final table.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cox import EFRON_TAIL, CoxParams
from .optim import DRIFT

POOLED = "__all__"


def _per_duration(rows: DataFrame, feats, stats, betas, by):
    """One job: per (group, duration) sums at the current coefficients."""
    p = len(feats)
    gcol = F.col(by) if by else F.lit(POOLED)
    z = []
    for j, f in enumerate(feats):
        mu = None
        sd = None
        for g, (mean, std) in stats.items():
            cond = gcol == F.lit(g)
            mu = F.when(cond, F.lit(mean[j])) if mu is None else mu.when(cond, F.lit(mean[j]))
            sd = F.when(cond, F.lit(std[j])) if sd is None else sd.when(cond, F.lit(std[j]))
        z.append((F.col(f).cast("double") - mu) / sd)
    lp = None
    for g, b in betas.items():
        cond = gcol == F.lit(g)
        term = F.lit(0.0)
        for j in range(p):
            term = term + F.lit(float(b[j])) * z[j]
        lp = F.when(cond, term) if lp is None else lp.when(cond, term)
    e = F.exp(lp)
    ev = F.col("_event").cast("double")
    aggs = [F.sum(ev).alias("m"), F.sum(e).alias("S0"), F.sum(ev * e).alias("D0")]
    for j in range(p):
        aggs += [F.sum(e * z[j]).alias(f"S1_{j}"), F.sum(ev * e * z[j]).alias(f"D1_{j}"),
                 F.sum(ev * z[j]).alias(f"Dz_{j}")]
        for k in range(j, p):
            aggs += [F.sum(e * z[j] * z[k]).alias(f"S2_{j}_{k}"),
                     F.sum(ev * e * z[j] * z[k]).alias(f"D2_{j}_{k}")]
    out = rows.groupBy(gcol.alias("_g"), F.col("_dur").alias("duration")).agg(*aggs).collect()
    tables: dict = {}
    for r in out:
        tables.setdefault(r["_g"], []).append(r)
    return tables


def tie_sums(m: float, R0: float, D0: float) -> tuple[float, float, float]:
    """Over l = 0..m-1 with c = m R0 / D0: sum ln(R0 - l D0 / m), sum 1/(c - l)
    and sum 1/(c - l)^2. The last terms are added one by one, the others are
    differences of the asymptotic series of lgamma, digamma and trigamma,
    written without cancellation: work does not depend on m."""
    c = m * R0 / D0
    k = max(m - EFRON_TAIL, 0.0)
    tail = c - np.arange(k, m)
    log_sum, p, q = float(np.log(tail * (D0 / m)).sum()), float((1.0 / tail).sum()), float((1.0 / tail ** 2).sum())
    if k:
        d = c - k
        s = lambda z: 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5)
        u = lambda z: 1 / (2 * z) - 1 / (12 * z ** 2) + 1 / (120 * z ** 4)
        w = lambda z: 1 / (6 * z ** 3) - 1 / (30 * z ** 5)
        log1 = math.log1p(-k / c)
        log_sum += k * math.log(R0) - (d + 0.5) * log1 - k + s(c) - s(d)
        p += -log1 + u(c) - u(d)
        gap = k / (c * d)                                   # 1/d - 1/c
        q += gap - 0.5 * gap * (1 / c + 1 / d) + w(d) - w(c)
    return log_sum, p, q


def _efron(table, beta, p):
    """Log-likelihood, gradient, Hessian and Breslow increments for one group."""
    rows = sorted(table, key=lambda r: -r["duration"])
    R0, R1, R2 = 0.0, np.zeros(p), np.zeros((p, p))
    ll, grad, hess = 0.0, np.zeros(p), np.zeros((p, p))
    base = []
    for r in rows:
        R0 += r["S0"]
        S1 = np.array([r[f"S1_{j}"] for j in range(p)])
        S2 = np.zeros((p, p))
        D1 = np.array([r[f"D1_{j}"] for j in range(p)])
        D2 = np.zeros((p, p))
        for j in range(p):
            for k in range(j, p):
                S2[j, k] = S2[k, j] = r[f"S2_{j}_{k}"]
                D2[j, k] = D2[k, j] = r[f"D2_{j}_{k}"]
        R1 = R1 + S1
        R2 = R2 + S2
        m = int(round(r["m"]))
        base.append((float(r["duration"]), m / R0 if R0 > 0 else 0.0))
        if m == 0:
            continue
        Dz = np.array([r[f"Dz_{j}"] for j in range(p)])
        log_sum, P, Q = tie_sums(float(m), R0, r["D0"])
        g = m / r["D0"]
        c = g * R0
        # sums over l of w, w l/m with w = 1 / (R0 - l D0 / m), and of w^2, w^2 l/m, w^2 (l/m)^2
        w0, w1 = g * P, g * (c * P - m) / m
        v0, v1, v2 = g * g * Q, g * g * (c * Q - P) / m, g * g * (c * c * Q - 2 * c * P + m) / (m * m)
        ll += float(beta @ Dz) - log_sum
        grad += Dz - (R1 * w0 - D1 * w1)
        cross = np.outer(R1, D1)
        hess -= (R2 * w0 - D2 * w1) - (np.outer(R1, R1) * v0 - (cross + cross.T) * v1 + np.outer(D1, D1) * v2)
    base.sort()
    return ll, grad, hess, base


def _next_step(grad: np.ndarray, hess: np.ndarray) -> float:
    """Largest change of a coefficient that a further Newton step would make."""
    try:
        step = np.linalg.solve(hess, grad)
    except np.linalg.LinAlgError:
        return math.inf
    return float(np.max(np.abs(step))) if np.all(np.isfinite(step)) else math.inf


def fit(customers: DataFrame, features=("avg_spend",), duration: str = "duration", event: str = "event",
        penalizer: float = 0.0, by: str | None = None, min_rows: int = 0, max_iter: int = 50,
        tol: float = 1e-9, positive_duration: bool = False, reliable: bool = True):
    """Fit pooled (by=None) or per-group Cox models. As in the other fitters
    the penalizer acts on the mean log-likelihood per row: the objective is
    ll / n - penalizer / 2 * |b|^2 over standardised coefficients. Groups with fewer than
    ``min_rows`` usable rows get no model (F6). Where the features separate
    the events perfectly the likelihood has no maximum: the fit then stops as
    ``drifting``, not converged; a penalizer gives a finite answer. Returns ({group: CoxParams},
    {group: metrics})."""
    feats = list(features)
    cols = ([by] if by else []) + [duration, event] + feats
    rows = customers.dropna(subset=[duration, event, *feats])
    if positive_duration:
        rows = rows.where(F.col(duration) > 0)
    rows = rows.select(*([F.col(by)] if by else []), F.col(duration).alias("_dur"),
                       F.col(event).alias("_event"), *[F.col(f) for f in feats])
    from ..session import release, stable_base
    rows = base = stable_base(rows, reliable)
    gcol = F.col(by) if by else F.lit(POOLED)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col("_event").cast("long")).alias("events")]
    for j, f in enumerate(feats):
        aggs += [F.avg(f).alias(f"mu{j}"), F.stddev_samp(f).alias(f"sd{j}")]
    st = rows.groupBy(gcol.alias("_g")).agg(*aggs).collect()
    stats, info = {}, {}
    for r in st:
        if r["n"] < max(min_rows, 1):
            continue
        mean = [float(r[f"mu{j}"]) for j in range(len(feats))]
        std = [float(r[f"sd{j}"]) if r[f"sd{j}"] and r[f"sd{j}"] > 0 else 1.0 for j in range(len(feats))]
        stats[r["_g"]] = (mean, std)
        info[r["_g"]] = {"n_samples": int(r["n"]), "n_events": int(r["events"] or 0)}
    if by:
        rows = rows.where(F.col(by).isin(list(stats)))
    p = len(feats)
    pen = {g: penalizer * info[g]["n_samples"] for g in stats}     # the penalty weighs against the mean log-likelihood
    beta = {g: np.zeros(p) for g in stats}
    state = {}
    tables = _per_duration(rows, feats, stats, beta, by)
    for g in stats:
        state[g] = _efron(tables.get(g, []), beta[g], p)
    done = {g: False for g in stats}
    reason = {g: "iterations" for g in stats}
    iters = {g: 0 for g in stats}
    for _ in range(max_iter):
        live = [g for g in stats if not done[g]]
        if not live:
            break
        prop = dict(beta)
        for g in live:
            ll, grad, hess, _b = state[g]
            grad_p = grad - pen[g] * beta[g]
            hess_p = hess - pen[g] * np.eye(p)
            try:
                step = np.linalg.solve(hess_p, grad_p)
            except np.linalg.LinAlgError:
                step = grad_p * 1e-3
            prop[g] = beta[g] - step
        halvings = 0
        while True:
            tables = _per_duration(rows, feats, stats, prop, by)
            new = {g: _efron(tables.get(g, []), prop[g], p) for g in live}
            retry = []
            for g in live:
                pen_old = state[g][0] - 0.5 * pen[g] * float(beta[g] @ beta[g])
                pen_new = new[g][0] - 0.5 * pen[g] * float(prop[g] @ prop[g])
                if math.isfinite(pen_new) and pen_new >= pen_old - 1e-12 * max(1.0, abs(pen_old)):
                    delta = float(np.max(np.abs(prop[g] - beta[g])))
                    beta[g], state[g] = prop[g], new[g]
                    iters[g] += 1
                    if delta < tol:
                        done[g], reason[g] = True, "step"
                    elif abs(pen_new - pen_old) < 1e-10 * max(1.0, abs(pen_old)):
                        done[g], reason[g] = True, "objective"
                else:
                    retry.append(g)
            if not retry or halvings >= 20:
                for g in retry:
                    done[g], reason[g] = True, "line search"
                break
            halvings += 1
            for g in retry:
                prop[g] = (beta[g] + prop[g]) / 2.0
            live = retry
    models, metrics = {}, {}
    for g, (mean, std) in stats.items():
        ll, grad, hess, hazards = state[g]
        coef = tuple(float(b / s) for b, s in zip(beta[g], std))
        H, acc = [], 0.0
        for t, h in hazards:
            acc += h
            H.append((t, acc))
        # a likelihood that only flattens out (separable rows) still has a long Newton step
        if reason[g] in ("step", "objective") and p and not _next_step(grad - pen[g] * beta[g], hess - pen[g] * np.eye(p)) < DRIFT:
            reason[g] = "drifting"
        models[g] = CoxParams(features=tuple(feats), coef=coef, mean=tuple(mean), baseline=tuple(H))
        metrics[g] = {**info[g], "log_likelihood": ll, "iterations": iters[g],
                      "converged": reason[g] in ("step", "objective"), "reason": reason[g],
                      "gradient": float(np.max(np.abs(grad - pen[g] * beta[g]))) if p else 0.0, "penalizer": penalizer}
    release(base)
    return models, metrics

"""Driver-side optimiser for models whose objective is a Spark aggregate.

The driver holds only the parameter vector (3-4 numbers) and a quasi-Newton
matrix; every evaluation is one Spark job over the (stored, pre-grouped) data.
A step tries its full length first and evaluates the shorter ones, as one
batch in one job, only when that fails.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Callable, Sequence

import numpy as np

STEPS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 1e-3, 1e-4)


@dataclass
class FitResult:
    x: np.ndarray
    fun: float
    iterations: int
    evaluations: int
    converged: bool
    history: list = field(default_factory=list)
    reason: str = ""           # gradient, objective, drifting, line search, not finite or iterations
    gradient: float = math.nan  # largest component at the end


#: A fit whose next full step would still move a log parameter this far is
#: not at an optimum, however flat the objective.
DRIFT = 0.02


def _searched(batch, x, f, slope, d, scale):
    """The full step first; the rest of the ladder, in one job, only when it
    fails. Returns (point, result) or None, and the evaluations."""
    used = 0
    for steps in (STEPS[:1], STEPS[1:]):
        cands = [x + s * scale * d for s in steps]
        res = batch(cands)
        used += len(cands)
        for s, xc, r in zip(steps, cands, res):
            if math.isfinite(r[0]) and r[0] <= f + 1e-4 * s * scale * slope:
                return (xc, r), used
    return None, used


def _verdict(x, f, g, step, reason, it, n_eval, hist) -> FitResult:
    """``step``: the full step from the last point."""
    if reason in ("gradient", "objective") and not np.max(np.abs(step)) < DRIFT:
        reason = "drifting"
    return FitResult(x=x, fun=f, iterations=it, evaluations=n_eval, converged=reason in ("gradient", "objective"),
                     history=hist, reason=reason, gradient=float(np.max(np.abs(g))))


def bfgs(fg_batch: Callable[[Sequence[np.ndarray]], list], x0, max_iter: int = 200,
         gtol: float = 1e-6, ftol: float = 1e-12) -> FitResult:
    """Minimise f given ``fg_batch(points) -> [(f, grad), ...]``: Armijo
    acceptance, BFGS inverse-Hessian update when curvature is positive, reset
    to the identity when a direction fails."""
    x = np.asarray(x0, dtype=float)
    (f, g), = fg_batch([x])
    n_eval, H, hist, it, reason = 1, np.eye(len(x)), [f], 0, "iterations"
    for it in range(1, max_iter + 1):
        if not np.all(np.isfinite(g)):
            reason = "not finite"
            break
        if np.max(np.abs(g)) < gtol:
            reason = "gradient"
            break
        d = -H @ g
        if g @ d >= 0:
            H = np.eye(len(x))
            d = -g
        scale = min(1.0, 5.0 / max(1e-12, np.max(np.abs(d))))  # at most 5 log-units per step
        pick, used = _searched(fg_batch, x, f, g @ d, d, scale)
        n_eval += used
        if pick is None:
            if np.allclose(H, np.eye(len(x))):
                reason = "line search"
                break
            H = np.eye(len(x))
            continue
        xn, (fn, gn) = pick
        s_vec, y_vec = xn - x, gn - g
        sy = s_vec @ y_vec
        if sy > 1e-12:
            rho = 1.0 / sy
            I = np.eye(len(x))
            H = (I - rho * np.outer(s_vec, y_vec)) @ H @ (I - rho * np.outer(y_vec, s_vec)) \
                + rho * np.outer(s_vec, s_vec)
        rel = abs(f - fn) / max(1.0, abs(f))
        x, f, g = xn, fn, gn
        hist.append(f)
        if rel < ftol:
            reason = "objective"
            break
    return _verdict(x, f, g, H @ g, reason, it, n_eval, hist)


def digamma(x: float) -> float:
    """psi(x) for x > 0: recurrence up to 6, then the asymptotic series."""
    r = 0.0
    while x < 6.0:
        r -= 1.0 / x
        x += 1.0
    f = 1.0 / (x * x)
    return r + math.log(x) - 0.5 / x - f * (1.0 / 12 - f * (1.0 / 120 - f * (1.0 / 252 - f * (
        1.0 / 240 - f / 132))))


def trigamma(x: float) -> float:
    """psi'(x) for x > 0: recurrence up to 6, then the asymptotic series."""
    r = 0.0
    while x < 12.0:
        r += 1.0 / (x * x)
        x += 1.0
    f = 1.0 / (x * x)
    return r + 1.0 / x + f / 2.0 + (1.0 / x) * f * (1.0 / 6 - f * (1.0 / 30 - f * (1.0 / 42 - f / 30)))


def newton(fgh_batch: Callable[[Sequence[np.ndarray]], list], x0, max_iter: int = 100,
           gtol: float = 1e-6, ftol: float = 1e-12) -> FitResult:
    """Newton's method: ``fgh_batch(points) -> [(f, grad, hessian), ...]``.
    Uses the Newton direction when the Hessian is positive definite; when that
    direction finds no acceptable step, the gradient direction is tried before
    stopping."""
    x = np.asarray(x0, dtype=float)
    (f, g, H), = fgh_batch([x])
    n_eval, hist, it, reason = 1, [f], 0, "iterations"
    use_newton = True

    def direction():
        if np.all(np.isfinite(H)):
            try:
                np.linalg.cholesky(H)
                return -np.linalg.solve(H, g)
            except np.linalg.LinAlgError:
                pass
        return None
    for it in range(1, max_iter + 1):
        if not np.all(np.isfinite(g)):
            reason = "not finite"
            break
        if np.max(np.abs(g)) < gtol:
            reason = "gradient"
            break
        d = direction() if use_newton else None
        newton_step = d is not None and g @ d < 0
        if not newton_step:
            d = -g
        scale = min(1.0, 5.0 / max(1e-12, np.max(np.abs(d))))
        pick, used = _searched(fgh_batch, x, f, g @ d, d, scale)
        n_eval += used
        if pick is None:
            if newton_step:
                use_newton = False      # retry along the gradient
                continue
            reason = "line search"
            break
        use_newton = True
        xn, (fn, gn, Hn) = pick
        rel = abs(f - fn) / max(1.0, abs(f))
        x, f, g, H = xn, fn, gn, Hn
        hist.append(f)
        if rel < ftol:
            reason = "objective"
            break
    last = direction()
    return _verdict(x, f, g, np.full(len(x), math.inf) if last is None else last, reason, it, n_eval, hist)

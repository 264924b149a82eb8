"""BG/NBD (Fader, Hardie & Lee 2005): scoring as native column expressions.

E[purchases in (T, T+t]] uses the Gauss hypergeometric function. We use
Euler's transformation of the bracketed product,
  ((alpha+T)/(alpha+T+t))^(r+x) * 2F1(r+x, b+x; a+b+x-1; z)
    = (1-z)^(a-1) * 2F1(a+b-1-r, a-1; a+b+x-1; z),   z = t/(alpha+T+t),
whose series needs fewer terms and cannot overflow for large x. A short
series is summed natively with ``aggregate(sequence(...))``. That lambda is
interpreted term by term, so a horizon whose series may pass ``SERIES_CHUNK``
terms is summed in Arrow batches of rows instead, as many terms as before.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BgNbdParams:
    r: float
    alpha: float
    a: float
    b: float

    def as_dict(self) -> dict:
        return asdict(self)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


SERIES_TOL = 1e-17     # tail of the series, relative to its first term
SERIES_CHUNK = 1024    # terms per inner array
SERIES_ROWS = 64       # rows summed at a time, of about equal lengths


def series_terms(z: Column, a_: float, b_: float) -> Column:
    """Terms that a row's series needs: its geometric tail z^n falls below
    the tolerance, plus the terms the parameters make it grow by."""
    geometric = F.ceil(F.lit(math.log(SERIES_TOL)) / F.log(z))
    return F.when(z > 0, geometric + F.lit(int(2 * (abs(a_) + abs(b_))) + 20)).otherwise(F.lit(2)).cast("long")


def hyp2f1_series(A: float, B: float, Cc: Column, z: Column) -> Column:
    """sum_k (A)_k (B)_k / ((C)_k k!) z^k, natively; every row sums as many
    terms as its own z needs (in chunks, so the arrays stay short)."""
    n = series_terms(z, A, B)
    init = F.struct(F.lit(1.0).alias("s"), F.lit(1.0).alias("t"))

    def step(acc, k):
        kd = k.cast("double")
        ratio = (F.lit(A) + kd) * (F.lit(B) + kd) / ((Cc + kd) * (kd + 1.0)) * z
        nt = acc["t"] * ratio
        return F.struct((acc["s"] + nt).alias("s"), nt.alias("t"))

    def chunk(acc, c):
        inner = F.sequence(F.lit(0).cast("long"), F.least(n, F.lit(SERIES_CHUNK)) - 1)
        return F.aggregate(inner, acc, lambda a, k: step(a, c * SERIES_CHUNK + k))

    chunks = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / SERIES_CHUNK).cast("long"))
    return F.aggregate(chunks, init, chunk, lambda acc: acc["s"])


def sum_series(A: float, B: float, C: np.ndarray, z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The series of every row, ``n`` terms or more: rows are taken in the
    order of their lengths, so blocks of rows x terms fit the cache."""
    out = np.empty(len(z))
    order = np.argsort(n, kind="stable")
    for at in range(0, len(order), SERIES_ROWS):
        rows = order[at:at + SERIES_ROWS]
        c, zz = C[rows, None], z[rows, None]
        s, t = np.ones(len(rows)), np.ones(len(rows))
        for lo in range(0, int(n[rows[-1]]), SERIES_CHUNK):
            k = np.arange(lo, min(lo + SERIES_CHUNK, int(n[rows[-1]])), dtype=np.float64)
            terms = zz * ((A + k) * (B + k) / (k + 1.0)) / (c + k)
            terms[:, 0] *= t
            np.cumprod(terms, axis=1, out=terms)
            s += terms.sum(axis=1)
            t = terms[:, -1].copy()
        out[rows] = s
    return out


def hyp2f1_batches(A: float, B: float, Cc: Column, z: Column) -> Column:
    """``hyp2f1_series`` over Arrow batches, for long series (null: null)."""
    def run(c, z, n):
        c, z, n = (np.asarray(v.to_numpy(zero_copy_only=False), np.float64) for v in (c, z, n))
        known = ~(np.isnan(c) | np.isnan(z) | np.isnan(n))
        out = np.full(len(z), np.nan)
        out[known] = sum_series(A, B, c[known], z[known], n[known])
        return pa.array(out, pa.float64(), mask=~known)
    run.__annotations__ = {"c": pa.Array, "z": pa.Array, "n": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")(Cc, z, series_terms(z, A, B))


def longest_series(p: BgNbdParams, t: float) -> float:
    """Terms that the series of a customer of age 0 needs."""
    z = t / (p.alpha + t)
    return math.log(SERIES_TOL) / math.log(z) if 0 < z < 1 else 0.0 if z <= 0 else math.inf


def expected_purchases(p: BgNbdParams, t, x, t_x, T) -> Column:
    """M9: conditional expected number of purchases in the next t periods
    (``t`` a number or a column)."""
    if abs(p.a - 1.0) < 1e-12:
        raise ValueError("a == 1 makes the BG/NBD expectation singular")
    x, t_x, T, tt = _c(x).cast("double"), _c(t_x).cast("double"), _c(T).cast("double"), _c(t).cast("double")
    z = tt / (F.lit(p.alpha) + T + tt)
    Cc = F.lit(p.a + p.b - 1.0) + x
    A, B = p.a + p.b - 1.0 - p.r, p.a - 1.0
    series = hyp2f1_batches if isinstance(t, (int, float)) and longest_series(p, t) > SERIES_CHUNK else hyp2f1_series
    bracket = F.pow(F.lit(1.0) - z, F.lit(p.a - 1.0)) * series(A, B, Cc, z)
    first = (Cc) / F.lit(p.a - 1.0)
    denom = F.lit(1.0) + F.when(x > 0, F.lit(p.a) / (F.lit(p.b) + x - 1.0)
                                * F.pow((F.lit(p.alpha) + T) / (F.lit(p.alpha) + t_x), F.lit(p.r) + x)
                                ).otherwise(F.lit(0.0))
    return first * (F.lit(1.0) - bracket) / denom


def p_alive(p: BgNbdParams, x, t_x, T) -> Column:
    """Probability the customer is still active (1 without repeats)."""
    x, t_x, T = _c(x).cast("double"), _c(t_x).cast("double"), _c(T).cast("double")
    odds = (F.lit(p.a) / (F.lit(p.b) + x - 1.0)
            * F.pow((F.lit(p.alpha) + T) / (F.lit(p.alpha) + t_x), F.lit(p.r) + x))
    return F.when(x == 0, F.lit(1.0)).otherwise(F.lit(1.0) / (F.lit(1.0) + odds))

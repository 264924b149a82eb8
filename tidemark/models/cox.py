"""Cox proportional hazards: scoring expressions and the baseline lookup."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CoxParams:
    """coef per feature (original units), feature means used for centring,
    and the baseline cumulative hazard as sorted (time, H0) pairs."""

    features: tuple[str, ...]
    coef: tuple[float, ...]
    mean: tuple[float, ...]
    baseline: tuple[tuple[float, float], ...] = field(default_factory=tuple)
    interpolation: str = "linear"

    def cumulative_hazard(self, t: float) -> float:
        """H0(t) from the (time, H0) table: linear between observed times
        (from H0(0) = 0 before the first one) or a step function; constant
        after the last observed time."""
        pts = self.baseline
        if not pts:
            raise ValueError("no baseline")
        times = [p[0] for p in pts]
        if t >= times[-1]:
            return pts[-1][1]
        if t < times[0]:
            return 0.0 if self.interpolation == "step" else pts[0][1] * t / times[0]
        i = bisect_right(times, t) - 1
        (t0, h0), (t1, h1) = pts[i], pts[i + 1]
        if self.interpolation == "step" or t == t0:
            return h0
        return h0 + (h1 - h0) * (t - t0) / (t1 - t0)

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def linear_predictor(c: CoxParams, cols: "list[str] | None" = None) -> Column:
    cols = list(cols or c.features)
    out = F.lit(0.0)
    for name, b, mu in zip(cols, c.coef, c.mean):
        out = out + F.lit(b) * (_c(name).cast("double") - F.lit(mu))
    return out


def partial_hazard(c: CoxParams, cols=None) -> Column:
    return F.exp(linear_predictor(c, cols))


def survival_at(c: CoxParams, t: float, cols=None, h0: float | None = None) -> Column:
    """M4: S(t | z) = exp(-H0(t) * exp(b'(z - mean)))."""
    H = c.cumulative_hazard(t) if h0 is None else h0
    return F.exp(-F.lit(H) * partial_hazard(c, cols))


def return_probability(c: CoxParams, t: float, cols=None, h0: float | None = None) -> Column:
    """M5: 1 - S(t | z)."""
    return F.lit(1.0) - survival_at(c, t, cols, h0)


def _duration_table(df, c: CoxParams, duration: str, event: str, cols=None):
    """Per-duration sums at fixed coefficients: events m, sum of exp(lp)
    over everyone (S) and over events (D0), sum of lp over events (Dlp).
    One partial-aggregated shuffle; output size = distinct durations."""
    from pyspark.sql import Window
    lp = linear_predictor(c, cols)
    e = F.exp(lp)
    ev = F.col(event).cast("double")
    per = df.groupBy(F.col(duration).alias("duration")).agg(
        F.sum(ev).alias("m"), F.sum(e).alias("S"), F.sum(ev * e).alias("D0"),
        F.sum(ev * lp).alias("Dlp"))
    # Risk set at d = everyone with duration >= d: a suffix sum over the
    # (small, bounded by distinct days) per-duration table.
    w = Window.orderBy(F.desc("duration")).rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("S0", F.sum("S").over(w))


def breslow_baseline(df, c: CoxParams, duration: str = "duration", event: str = "event", cols=None):
    """M3: baseline hazard h0(d) = events(d) / risk-set sum(d) (covariates
    centred at the coefficients' means) and its running sum H0(d)."""
    from pyspark.sql import Window
    per = _duration_table(df, c, duration, event, cols)
    h = (F.col("m") / F.col("S0"))
    w = Window.orderBy("duration").rowsBetween(Window.unboundedPreceding, 0)
    return (per.select("duration", F.col("m").cast("long").alias("events"), h.alias("baseline_hazard"))
            .withColumn("cumulative_hazard", F.sum("baseline_hazard").over(w)))


#: Terms of an Efron sum that are added one by one: those with the smallest
#: arguments, where the asymptotic series does not hold.
EFRON_TAIL = 16


def efron_log_sum(m: Column, R0: Column, D0: Column) -> Column:
    """sum over l < m of ln(R0 - l D0 / m), in closed form: with c = m R0 / D0
    the first m' = m - 16 terms are m' ln R0 plus a difference of lgamma(c + 1)
    and lgamma(c - m' + 1), written without cancellation; the last 16 are
    added one by one. Work and memory do not depend on m."""
    k = F.greatest(m - EFRON_TAIL, F.lit(0.0))
    c = m * R0 / D0
    d = c - k
    s = lambda z: 1.0 / (12.0 * z) - 1.0 / (360.0 * F.pow(z, F.lit(3.0))) + 1.0 / (1260.0 * F.pow(z, F.lit(5.0)))
    closed = k * F.log(R0) - (d + 0.5) * F.log1p(-k / c) - k + s(c) - s(d)
    tail = F.aggregate(F.sequence(F.lit(1), F.least(m, F.lit(float(EFRON_TAIL))).cast("int")), F.lit(0.0),
                       lambda acc, j: acc + F.log(R0 - (m - j.cast("double")) / m * D0))
    return F.when(k > 0, closed).otherwise(F.lit(0.0)) + tail


def efron_loglik(df, c: CoxParams, duration: str = "duration", event: str = "event", cols=None):
    """M7: Efron partial log-likelihood at fixed coefficients (one row)."""
    per = _duration_table(df, c, duration, event, cols).where(F.col("m") > 0)
    term = F.col("Dlp") - efron_log_sum(F.col("m"), F.col("S0"), F.col("D0"))
    return per.agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("log_likelihood"),
                   F.coalesce(F.sum("m"), F.lit(0.0)).cast("long").alias("n_events"))


def hazard_at(c: CoxParams, t: Column) -> Column:
    """H0(t) as a column expression over the baseline's (time, H0) points."""
    times = F.array(F.lit(0.0), *[F.lit(float(p[0])) for p in c.baseline])
    hs = F.array(F.lit(0.0), *[F.lit(float(p[1])) for p in c.baseline])
    i = F.greatest(F.size(F.filter(times, lambda x: x <= t)), F.lit(1))
    last = i >= len(c.baseline) + 1
    t0, h0 = F.element_at(times, i), F.element_at(hs, i)
    nxt = F.when(last, i).otherwise(i + 1)
    t1, h1 = F.element_at(times, nxt), F.element_at(hs, nxt)
    if c.interpolation == "step":
        return h0
    return F.when(last | (t == t0), h0).otherwise(h0 + (h1 - h0) * (t - t0) / (t1 - t0))

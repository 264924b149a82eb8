"""The RFM-versus-CLV analysis as one DataFrame plan.

customer features (one two-level aggregate) -> RFM quintiles (edges as
literals) -> CLV per customer (one-timers: return probability x mean spend;
repeaters: expected purchases x expected spend) -> quartile CLV level ->
mismatch label. Everything is keyed by customer_id; the only shuffles are
the two aggregate levels. Exported lists (F8, F9, O3) are filters on it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import mismatch
from ..models import bgnbd as BG
from ..models import cox as CX
from ..models import gamma_gamma as GG
from ..operators.customers import customer_features
from ..operators.rfm import quantile_level, rfm_scores
from .models import ModelBundle


def _cols(model) -> list[str]:
    from .scoring import cox_columns
    return cox_columns(model)


def onetimer_return_probability(models: ModelBundle, xdays: int, per_channel: bool = False):
    """P_return for one-timers: pooled Cox, per-channel Cox (null for
    channels without a model), or the 0.1 fallback."""
    if per_channel:
        expr = None
        for g, m in sorted(models.cox_by_channel.items()):
            e = CX.return_probability(m, xdays, cols=_cols(m))
            cond = F.col("channel_group") == g
            expr = F.when(cond, e) if expr is None else expr.when(cond, e)
        return expr if expr is not None else F.lit(None).cast("double")
    if models.cox is None:
        return F.lit(C.FALLBACK_P_RETURN)
    return CX.return_probability(models.cox, xdays, cols=_cols(models.cox))


def repeater_terms(models: ModelBundle, xdays: int, x="days_frequency", t_x="t_x", T="T",
                   m="monetary_value", scoring_rule: bool = False):
    """(expected purchases, expected value, P_alive) columns for repeaters.

    scoring_rule=True applies the scoring fallbacks (value = observed mean
    when frequency is 0); the analysis applies the spend model to every
    summary row (population mean at frequency 0, trap T9)."""
    xc, Tc = F.col(x), F.col(T)
    if models.bgnbd is not None:
        en = BG.expected_purchases(models.bgnbd, xdays, x, t_x, T)
        pa = BG.p_alive(models.bgnbd, x, t_x, T)
    else:
        en = xc * F.lit(float(xdays)) / F.greatest(Tc, F.lit(1)).cast("double")
        pa = F.lit(C.FALLBACK_P_ALIVE)
    if models.gamma_gamma is not None:
        ev = GG.expected_value(models.gamma_gamma, x, m)
        if scoring_rule:
            ev = F.when(xc > 0, ev).otherwise(F.col(m))
    else:
        ev = F.col(m)
    return en, ev, pa


def clv_table(clean: DataFrame, snapshot, models: ModelBundle, xdays: int = C.DEFAULT_XDAYS,
              per_channel: bool = False) -> DataFrame:
    """U1 + J3 + J4: one row per customer with group, latest channel, RFM
    score/segment and CLV (one-timers without a channel model drop out in
    the per-channel variant, as in the exploratory analysis)."""
    feats = customer_features(clean, snapshot).persist(StorageLevel.MEMORY_AND_DISK)
    scored = rfm_scores(feats, persist=False)
    p_ret = onetimer_return_probability(models, xdays, per_channel)
    en, ev, _ = repeater_terms(models, xdays)
    one = F.col("visit_count") == 1
    scored = scored.withColumn("_en", F.when(~one, en)).withColumn("_ev", F.when(~one, ev))
    clv = F.when(one, p_ret * F.col("avg_spend")).otherwise(F.col("_en") * F.col("_ev"))
    out = scored.select(
        "customer_id",
        F.when(one, F.lit(C.GROUP_ONETIMER)).otherwise(F.lit(C.GROUP_REPEATER)).alias("group"),
        F.col("latest_channel").alias("channel"),
        F.col("latest_channel_group").alias("channel_group"),
        "rfm_score", "segment",
        clv.alias("clv"),
    )
    if per_channel:
        out = out.where(F.col("clv").isNotNull())
    return out


def rfm_vs_clv(clean: DataFrame, snapshot, models: ModelBundle, xdays: int = C.DEFAULT_XDAYS,
               per_channel: bool = False) -> DataFrame:
    """CLV table + quartile level (W6) + mismatch."""
    t = clv_table(clean, snapshot, models, xdays, per_channel)
    t = t.persist(StorageLevel.MEMORY_AND_DISK)
    leveled = quantile_level(t, "clv")
    return leveled.withColumn("mismatch", mismatch("segment", "clv_level"))


def underrated(analysis: DataFrame) -> DataFrame:
    """F8: the 'Underrated' list with its five export columns."""
    return (analysis.where(F.col("mismatch") == C.MISMATCH_UNDERRATED)
            .select("customer_id", "segment", "rfm_score", "clv", "mismatch"))


def target_list(analysis: DataFrame, levels=C.TARGET_LEVELS, excluded=C.TARGET_EXCLUDED_SEGMENTS,
                groups=C.TARGET_CHANNEL_GROUPS) -> DataFrame:
    """high-value, not-lost, reachable-channel customers, CLV desc."""
    return (analysis.where(F.col("clv_level").isin(*levels) & ~F.col("segment").isin(*excluded)
                           & F.col("channel_group").isin(*groups))
            .orderBy(F.desc("clv"), F.asc("customer_id"))
            .select("customer_id", "clv", "group", "channel", "channel_group", "rfm_score",
                    "segment", "clv_level"))

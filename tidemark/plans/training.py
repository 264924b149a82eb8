"""Training preparation and the train-all job.

prep_training returns the six named frames of the analysed pipeline, each planned
when asked for, over one cleaned transaction frame; train_all fits Cox (all
customers), BG/NBD (repeaters' calendar-day summary) and Gamma-Gamma (rows
with positive frequency and spend) and returns the model bundle plus a
metrics table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..models import fit_bgnbd, fit_cox, fit_gamma_gamma
from ..operators import cleaning as CL
from ..operators import customers as CU
from ..operators.rfm import rfm_scores
from ..session import release, stable_base
from .models import ModelBundle


class Frames(Mapping):
    """Named frames, each planned when it is first asked for."""

    def __init__(self, **plans: Callable[[], DataFrame]):
        self._plans, self._made = plans, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._plans[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)


def prep_training(txn: DataFrame, snapshot, inclusive: bool = False) -> Mapping[str, DataFrame]:
    """Transactions (with groups, dummies, repeat flag), customer table,
    RFM scores, one-timer and repeater visits, latest channel. Nothing runs
    for a frame that is not asked for (the RFM scores need their edges)."""
    clean = CL.clean_strict(txn, snapshot, inclusive)
    enc = CL.add_repeat_flag(CL.add_channel_groups(clean))
    one, rep = CL.split_customers(enc)
    return Frames(
        transactions=lambda: enc,
        customer_data=lambda: CU.customer_table(enc, snapshot),
        rfm=lambda: rfm_scores(CU.rfm_features(clean, snapshot)),
        one_timers=lambda: one,
        repeaters=lambda: rep,
        latest_channel=lambda: CU.latest_channel(enc),
    )


def prep_lenient(txn: DataFrame, snapshot) -> dict[str, DataFrame]:
    """Lenient cleaning, tx counts and the lenient customer table."""
    clean = CL.clean_lenient(txn, snapshot)
    typed = CL.add_customer_type(clean)
    return {
        "transactions": typed,
        "customer_data": CU.customer_table_lenient(clean, snapshot),
        "one_timers": typed.where(F.col("customer_type") == C.TYPE_ONETIMER),
        "repeaters": typed.where(F.col("customer_type") == C.TYPE_REPEATER),
    }


def params_table(spark: SparkSession, rows: list[tuple[str, str, float]]) -> DataFrame:
    return spark.createDataFrame([(m, k, float(v)) for m, k, v in rows],
                                 "model string, name string, value double")


def metric_rows(model: str, metrics: dict) -> list[tuple[str, str, float]]:
    """Metrics as (model, name, value); a text goes into the name."""
    return [(model, f"{k}={v}", 1.0) if isinstance(v, str) else (model, k, float(v)) for k, v in metrics.items()]


def train_all(txn: DataFrame, snapshot, penalizer: float = 0.0, bgnbd_penalizer: float | None = None,
              gg_penalizer: float | None = None, cox_features=("avg_spend",),
              by_channel: bool = False, with_concordance: bool = True, xdays: int = C.DEFAULT_XDAYS) -> tuple[ModelBundle, DataFrame]:
    """Fit all three models; returns (bundle, metrics table) with the Cox
    log-likelihood, concordance index (M6) and event counts, the BG/NBD and
    Gamma-Gamma parameters and fit diagnostics."""
    spark = txn.sparkSession
    clean = CL.clean_strict(txn, snapshot)
    t0 = time.time()
    # every fit and the concordance read the same stored customer table
    feats = stable_base(CU.customer_features(clean, snapshot))
    rows: list[tuple[str, str, float]] = []
    cox_models, cox_metrics = fit_cox.fit(feats, cox_features, penalizer=penalizer)
    cox = cox_models.get(fit_cox.POOLED)
    rows += metric_rows("cox", cox_metrics.get(fit_cox.POOLED, {}))
    if cox is not None:
        rows += [("cox", f"coef_{f}", c) for f, c in zip(cox.features, cox.coef)]
        if with_concordance:
            from ..models.concordance import concordance
            from ..models.cox import linear_predictor
            ci = concordance(feats.dropna(subset=["duration", "event", *cox_features]), "duration", "event",
                             linear_predictor(cox)).collect()[0]["concordance_index"]
            rows.append(("cox", "concordance_index", float(ci) if ci is not None else float("nan")))
    by = {}
    if by_channel:
        by, mets = fit_cox.fit(feats, cox_features, penalizer=penalizer, by="channel_group",
                               min_rows=C.MIN_CHANNEL_ROWS)
        for g, m in by.items():
            rows += [(f"cox[{g}]", f"coef_{f}", c) for f, c in zip(m.features, m.coef)]
    summary = feats.where(F.col("visit_count") > 1).select(
        "customer_id", F.col("days_frequency").alias("frequency"), "t_x", "T", "monetary_value")
    bg, _, bg_m = fit_bgnbd.fit(summary, penalizer if bgnbd_penalizer is None else bgnbd_penalizer)
    rows += [("bgnbd", k, v) for k, v in bg.as_dict().items()]
    rows += metric_rows("bgnbd", bg_m)
    gg, _, gg_m = fit_gamma_gamma.fit(summary, penalizer if gg_penalizer is None else gg_penalizer)
    rows += [("gamma_gamma", k, v) for k, v in gg.as_dict().items()]
    rows += metric_rows("gamma_gamma", gg_m)
    release(feats)
    rows.append(("pipeline", "training_duration_seconds", time.time() - t0))
    config = {"snapshot_date": str(snapshot), "xdays": xdays, "penalizer": penalizer}
    return ModelBundle(cox=cox, cox_by_channel=by, bgnbd=bg, gamma_gamma=gg, config=config), params_table(spark, rows)


def train_lenient(txn: DataFrame, snapshot, penalizer: float = 0.1,
                  bgnbd_penalizer: float | None = None,
                  gg_penalizer: float = 0.0, xdays: int = C.DEFAULT_XDAYS) -> tuple[ModelBundle, DataFrame]:
    """Lenient training variant: inclusive snapshot, Cox on (avg_revenue,
    tx_count) over customers with T > 0, BG/NBD and Gamma-Gamma on the
    repeaters' calendar-day summary. The event is tx_count > 1, so the
    count separates it perfectly (trap T14): a positive ridge penalizer is
    required for a finite coefficient and is the default here."""
    spark = txn.sparkSession
    clean = CL.clean_lenient(txn, snapshot)
    cust = CU.customer_table_lenient(clean, snapshot)
    cox_models, cox_metrics = fit_cox.fit(cust, ("avg_revenue", "tx_count"), duration="T", event="event",
                                          penalizer=penalizer, positive_duration=True)
    cox = cox_models.get(fit_cox.POOLED)
    rows = metric_rows("cox", cox_metrics.get(fit_cox.POOLED, {}))
    if cox is not None:
        rows += [("cox", f"coef_{f}", c) for f, c in zip(cox.features, cox.coef)]
    summary = CU.purchase_summary(clean, snapshot).where(F.col("n_visits") > 1)
    bg, _, bg_m = fit_bgnbd.fit(summary, penalizer if bgnbd_penalizer is None else bgnbd_penalizer)
    gg, _, gg_m = fit_gamma_gamma.fit(summary, gg_penalizer)
    rows += [("bgnbd", k, v) for k, v in bg.as_dict().items()]
    rows += [("gamma_gamma", k, v) for k, v in gg.as_dict().items()]
    rows += metric_rows("bgnbd", bg_m)
    rows += metric_rows("gamma_gamma", gg_m)
    config = {"snapshot_date": str(snapshot), "xdays": xdays, "penalizer": penalizer}
    return ModelBundle(cox=cox, bgnbd=bg, gamma_gamma=gg, config=config), params_table(spark, rows)

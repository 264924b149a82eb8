"""Registered queries over the test tables (one per inventory row).

Each entry takes (spark, sf_dir) and returns a DataFrame over the given
parquet tables (visits are derived from ``orders``; snapshot 1996-01-01).
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import DUMMY_COLUMNS, r6
from ..operators import cleaning as CL
from ..operators import customers as CU
from ..operators import profile as PR
from ..operators import rfm as RF
from .. import sources as SRC
from ..sources import testdata_transactions

SNAP = C.TESTDATA_SNAPSHOT
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def clean_txn(spark, sf_dir) -> DataFrame:
    return CL.clean_strict(testdata_transactions(spark, sf_dir), SNAP)


def rfm_table(spark, sf_dir) -> DataFrame:
    return CU.rfm_features(clean_txn(spark, sf_dir), SNAP)


@register("scan_txn")
def q_scan_txn(spark, sf_dir):
    return clean_txn(spark, sf_dir)


@register("rfm_features")
def q_rfm_features(spark, sf_dir):
    return rfm_table(spark, sf_dir).select("customer_id", "recency", "frequency", r6("monetary").alias("monetary"))


@register("rfm_scores")
def q_rfm_scores(spark, sf_dir):
    s = RF.rfm_scores(rfm_table(spark, sf_dir))
    return s.select("customer_id", "recency", "frequency", r6("monetary").alias("monetary"),
                    "r_score", "f_score", "m_score", "rfm_segment", "rfm_score", "segment")


@register("rfm_segment_counts")
def q_rfm_segment_counts(spark, sf_dir):
    s = RF.rfm_scores(rfm_table(spark, sf_dir))
    return s.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"),
                                    r6(F.avg("monetary")).alias("avg_monetary"))


# ---------------------------------------------------------------- helpers

def enc_txn(spark, sf_dir) -> DataFrame:
    return CL.add_channel_groups(clean_txn(spark, sf_dir))


def features(spark, sf_dir) -> DataFrame:
    return CU.customer_features(clean_txn(spark, sf_dir), SNAP)


def cents(c) -> F.Column:
    """CLV-valued outputs are money: reported to the cent (like the API).
    Model values go through exp/pow/series sums whose last bits differ
    between engines; a cent is far above that noise."""
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 2)


def _money_cols(df: DataFrame, cols) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------- projections (P)

@register("project_cols")
def q_project_cols(spark, sf_dir):
    t = testdata_transactions(spark, sf_dir)
    return t.select("customer_id", "arrival_ts", "revenue", "channel")


@register("parse_date")
def q_parse_date(spark, sf_dir):
    o = SRC.table(spark, sf_dir, "orders")
    s = o.select(F.col("o_orderkey").alias("txn_id"),
                 F.col("o_orderdate").cast("string").alias("arrival_text"))
    return s.select("txn_id", F.to_timestamp_ntz("arrival_text", F.lit("yyyy-MM-dd HH:mm:ss"))
                    .alias("arrival_ts"))


@register("coerce_date")
def q_coerce_date(spark, sf_dir):
    o = SRC.table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("txn_id"),
                    F.expr("try_cast(cast(o_orderdate as string) as timestamp_ntz)").alias("arrival_ts"),
                    F.expr("try_cast(o_orderpriority as timestamp_ntz)").alias("priority_ts"))


def _as_extract(spark, sf_dir, revenue_header: str | None) -> DataFrame:
    """Orders shaped like an all-string CSV extract with untidy headers."""
    t = testdata_transactions(spark, sf_dir)
    cols = [F.col("customer_id").cast("string").alias(" CustomerID "),
            F.col("arrival_ts").cast("string").alias("Arrival Date "),
            F.col("channel").alias(" Channel"),
            F.col("txn_id")]
    if revenue_header:
        cols.append(F.col("revenue").cast("string").alias(revenue_header))
    return t.select(*cols)


def _lenient(df: DataFrame) -> DataFrame:
    return SRC.lenient_frame(df.toDF(*[c.strip() for c in df.columns]))


@register("strip_headers")
def q_strip_headers(spark, sf_dir):
    df = _as_extract(spark, sf_dir, " Total Revenue USD ")
    return df.toDF(*[c.strip() for c in df.columns]).select(
        F.col("CustomerID").alias("customer_id"), F.col("`Arrival Date`").alias("arrival_text"),
        F.col("`Total Revenue USD`").alias("revenue_text"), F.col("Channel").alias("channel"), "txn_id")


@register("scan_lenient")
def q_scan_lenient(spark, sf_dir):
    return _lenient(_as_extract(spark, sf_dir, "Total Revenue USD"))


@register("revenue_fallback")
def q_revenue_fallback(spark, sf_dir):
    alt = _lenient(_as_extract(spark, sf_dir, "Room Amount")).select("txn_id", F.col("revenue").alias("rev_alt"))
    none = _lenient(_as_extract(spark, sf_dir, None)).select("txn_id", F.col("revenue").alias("rev_default"))
    return alt.join(none, "txn_id")


@register("coerce_number")
def q_coerce_number(spark, sf_dir):
    o = SRC.table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("txn_id"),
                    F.coalesce(F.expr("try_cast(cast(o_totalprice as string) as double)"), F.lit(0.0))
                    .alias("revenue"),
                    F.coalesce(F.expr("try_cast(o_orderstatus as double)"), F.lit(0.0)).alias("status_num"))


@register("channel_group")
def q_channel_group(spark, sf_dir):
    return enc_txn(spark, sf_dir).select("txn_id", "channel", "channel_group")


@register("channel_onehot")
def q_channel_onehot(spark, sf_dir):
    return enc_txn(spark, sf_dir).select("txn_id", "channel_group", *DUMMY_COLUMNS)


@register("elapsed_days")
def q_elapsed_days(spark, sf_dir):
    return features(spark, sf_dir).select("customer_id", "duration", "recency")


@register("elapsed_days_events")
def q_elapsed_days_events(spark, sf_dir):
    ev = SRC.testdata_events(spark, sf_dir)
    snap = "2024-01-10 12:00:00"
    return CU.elapsed(ev, snap).select("txn_id", "days_to_snapshot", "calendar_days_to_snapshot")


@register("event_flag")
def q_event_flag(spark, sf_dir):
    return features(spark, sf_dir).select("customer_id", "visit_count", "event")


@register("rfm_segment_name")
def q_rfm_segment_name(spark, sf_dir):
    return RF.rfm_scores(rfm_table(spark, sf_dir)).select("customer_id", "rfm_score", "segment")


@register("rfm_code")
def q_rfm_code(spark, sf_dir):
    return RF.rfm_scores(rfm_table(spark, sf_dir)).select(
        "customer_id", "r_score", "f_score", "m_score", "rfm_segment", "rfm_score")


@register("customer_type_label")
def q_customer_type_label(spark, sf_dir):
    lt = CL.clean_lenient(testdata_transactions(spark, sf_dir), SNAP)
    return CU.customer_table_lenient(lt, SNAP).select("customer_id", "tx_count", "customer_type")


# ---------------------------------------------------------- filters (F)

@register("clean_strict")
def q_clean_strict(spark, sf_dir):
    return clean_txn(spark, sf_dir).select("txn_id", "customer_id", "arrival_ts", "revenue")


@register("clean_lenient")
def q_clean_lenient(spark, sf_dir):
    return CL.clean_lenient(testdata_transactions(spark, sf_dir), SNAP).select(
        "txn_id", "customer_id", "arrival_ts", "revenue")


@register("split_onetimers")
def q_split_onetimers(spark, sf_dir):
    one, _ = CL.split_customers(enc_txn(spark, sf_dir))
    return one.select("txn_id", "customer_id", "channel_group", "visit_count", "repeat")


@register("split_repeaters")
def q_split_repeaters(spark, sf_dir):
    _, rep = CL.split_customers(enc_txn(spark, sf_dir))
    return rep.select("txn_id", "customer_id", "channel_group", "visit_count", "repeat")


@register("cox_rows")
def q_cox_rows(spark, sf_dir):
    f = features(spark, sf_dir)
    rows = f.dropna(subset=["duration", "event", "avg_spend"]).where(F.col("duration") > 0)
    return rows.select("customer_id", "duration", "event", r6("avg_spend").alias("avg_spend"))


@register("gg_rows")
def q_gg_rows(spark, sf_dir):
    s = CU.purchase_summary(clean_txn(spark, sf_dir), SNAP)
    s = s.where((F.col("monetary_value") > 0) & (F.col("frequency") > 0))
    return s.select("customer_id", "frequency", r6("monetary_value").alias("monetary_value"))


@register("channel_subset")
def q_channel_subset(spark, sf_dir):
    f = features(spark, sf_dir).dropna(subset=["duration", "event", "avg_spend"])
    c = f.groupBy("channel_group").agg(F.count(F.lit(1)).alias("customers"),
                                        F.sum(F.when(F.col("visit_count") == 1, 1).otherwise(0))
                                        .cast("long").alias("one_timers"))
    return c.withColumn("modelled", F.col("customers") >= C.MIN_CHANNEL_ROWS)


@register("onetimer_customers")
def q_onetimer_customers(spark, sf_dir):
    f = features(spark, sf_dir).where(F.col("visit_count") == 1)
    return f.select("customer_id", "first_date", "duration", r6("avg_spend").alias("avg_spend"),
                    "channel_group")


# ------------------------------------------------------------ joins (J)

@register("join_first_channel")
def q_join_first_channel(spark, sf_dir):
    return CU.customer_table(enc_txn(spark, sf_dir), SNAP).select(
        "customer_id", "channel_group", *DUMMY_COLUMNS)


@register("join_tx_count")
def q_join_tx_count(spark, sf_dir):
    lt = CL.clean_lenient(testdata_transactions(spark, sf_dir), SNAP)
    return CL.add_customer_type(lt).select("txn_id", "customer_id", "tx_count", "customer_type")


@register("semi_repeaters")
def q_semi_repeaters(spark, sf_dir):
    t = clean_txn(spark, sf_dir)
    ids = CL.visit_counts(t).where(F.col("visit_count") > 1)
    return CL.semi_by_ids(t, ids).select("txn_id", "customer_id", "arrival_ts", "revenue")


@register("map_repeat_flag")
def q_map_repeat_flag(spark, sf_dir):
    return CL.add_repeat_flag(clean_txn(spark, sf_dir)).select("txn_id", "customer_id", "repeat")


# ----------------------------------------------------- aggregations (A)

@register("customer_agg")
def q_customer_agg(spark, sf_dir):
    c = CU.customer_table(enc_txn(spark, sf_dir), SNAP)
    return c.select("customer_id", "first_date", "last_date", "visit_count",
                    r6("avg_spend").alias("avg_spend"), "duration", "event", "channel_group",
                    *DUMMY_COLUMNS)


@register("customer_agg_lenient")
def q_customer_agg_lenient(spark, sf_dir):
    lt = CL.clean_lenient(testdata_transactions(spark, sf_dir), SNAP)
    c = CU.customer_table_lenient(lt, SNAP)
    return _money_cols(c, {"total_revenue", "avg_revenue"})


@register("channel_table")
def q_channel_table(spark, sf_dir):
    return PR.frequency_table(clean_txn(spark, sf_dir), "channel")


@register("channel_group_table")
def q_channel_group_table(spark, sf_dir):
    return PR.frequency_table(enc_txn(spark, sf_dir), "channel_group")


@register("repeat_table")
def q_repeat_table(spark, sf_dir):
    return PR.repeat_table(CL.add_repeat_flag(clean_txn(spark, sf_dir)))


@register("repeat_distinct")
def q_repeat_distinct(spark, sf_dir):
    return PR.repeat_distinct(CL.add_repeat_flag(clean_txn(spark, sf_dir)))


@register("spend_by_visit")
def q_spend_by_visit(spark, sf_dir):
    _, rep = CL.split_customers(clean_txn(spark, sf_dir))
    out = PR.spend_by_visit(CU.visit_numbers(rep))
    return out.select("visit_number", r6("avg_spend").alias("avg_spend"))


@register("profile")
def q_profile(spark, sf_dir):
    return PR.profile(testdata_transactions(spark, sf_dir), CL.is_clean(SNAP))


@register("distinct_values")
def q_distinct_values(spark, sf_dir):
    wide = SRC.testdata_transactions(spark, sf_dir, keep=("o_orderstatus", "o_orderpriority")).select(
        "channel", F.col("o_orderstatus").alias("order_status"), F.col("o_orderpriority").alias("order_priority"))
    return PR.distinct_values(wide, ["channel", "order_status", "order_priority"])


@register("purchase_summary")
def q_purchase_summary(spark, sf_dir):
    s = CU.purchase_summary(clean_txn(spark, sf_dir), SNAP).where(F.col("n_visits") > 1)
    return s.select("customer_id", "frequency", "t_x", "T", r6("monetary_value").alias("monetary_value"))


@register("train_metrics")
def q_train_metrics(spark, sf_dir):
    s = CU.purchase_summary(clean_txn(spark, sf_dir), SNAP).where(F.col("n_visits") > 1)
    m = PR.summary_metrics(s)
    return _money_cols(m, {"avg_frequency", "avg_recency", "avg_T", "avg_monetary_value",
                           "median_monetary_value"})


@register("cox_metrics")
def q_cox_metrics(spark, sf_dir):
    return _money_cols(PR.cox_metrics(features(spark, sf_dir)), {"event_rate"})


@register("load_stats")
def q_load_stats(spark, sf_dir):
    return PR.load_stats(CL.add_repeat_flag(clean_txn(spark, sf_dir)))


@register("visit_counts")
def q_visit_counts(spark, sf_dir):
    v = CL.visit_counts(clean_txn(spark, sf_dir))
    return v.withColumn("customer_class", F.when(F.col("visit_count") == 1, "one_timer")
                        .otherwise("repeater"))


# ------------------------------------------------------ windows (W)

@register("visit_number")
def q_visit_number(spark, sf_dir):
    return CU.visit_numbers(clean_txn(spark, sf_dir)).select("txn_id", "customer_id", "visit_number")


@register("rank_first")
def q_rank_first(spark, sf_dir):
    r = rfm_table(spark, sf_dir)
    from ..operators.quantiles import global_row_number
    return global_row_number(r, ["frequency", "customer_id"], out="f_rank").select(
        "customer_id", "frequency", "f_rank")


@register("latest_channel")
def q_latest_channel(spark, sf_dir):
    return CU.latest_channel(enc_txn(spark, sf_dir))


@register("first_row")
def q_first_row(spark, sf_dir):
    return CU.first_row(enc_txn(spark, sf_dir), ["txn_id", "arrival_ts", "channel", "channel_group"])


# -------------------------------------------------- sort / set (O, U)

@register("sort_txn")
def q_sort_txn(spark, sf_dir):
    from ..operators.quantiles import global_row_number
    return global_row_number(clean_txn(spark, sf_dir), ["customer_id", "arrival_ts", "txn_id"], out="position")


@register("sort_freq")
def q_sort_freq(spark, sf_dir):
    from pyspark.sql import Window
    t = PR.frequency_table(enc_txn(spark, sf_dir), "channel_group")     # one row per channel group
    order = Window.orderBy(F.desc("total_customerid_count"), F.asc("channel_group"))
    return t.withColumn("position", F.row_number().over(order).cast("long"))


@register("distinct_customers")
def q_distinct_customers(spark, sf_dir):
    return clean_txn(spark, sf_dir).select("customer_id").distinct()


# ------------------------------------- models at fixed parameters (M, E8)

from ..models import bgnbd as BG  # noqa: E402
from ..models import cox as CX  # noqa: E402
from ..models import gamma_gamma as GG  # noqa: E402
from . import analysis as AN  # noqa: E402
from .models import FIXED_BGNBD, FIXED_COX, FIXED_COX_BASELINE, FIXED_GAMMA_GAMMA, fixed_models  # noqa: E402

XDAYS = C.DEFAULT_XDAYS


def repeater_summary(spark, sf_dir) -> DataFrame:
    return CU.purchase_summary(clean_txn(spark, sf_dir), SNAP).where(F.col("n_visits") > 1)


@register("bgnbd_expected")
def q_bgnbd_expected(spark, sf_dir):
    s = repeater_summary(spark, sf_dir)
    return s.select("customer_id", r6(BG.expected_purchases(FIXED_BGNBD, XDAYS, "frequency", "t_x", "T"))
                    .alias("expected_purchases"))


#: Small alphas put z close to 1: the series needs thousands of terms.
SMALL_ALPHAS = (0.5, 4.41)


@register("bgnbd_expected_small_alpha")
def q_bgnbd_expected_small_alpha(spark, sf_dir):
    """Ten years ahead, per distinct repeat count, with the age cut to 4 days
    so that z is closest to 1: a check of the series against its SQL only.
    ``bgnbd_expected_small_alpha_customers`` has the customers."""
    from dataclasses import replace
    s = repeater_summary(spark, sf_dir).select("frequency", F.least(F.col("T"), F.lit(4)).alias("T")).distinct()
    en = [r6(BG.expected_purchases(replace(FIXED_BGNBD, alpha=a), 3650, "frequency", F.lit(0.0), "T")).alias(f"expected_{i}")
          for i, a in enumerate(SMALL_ALPHAS)]
    return s.select("frequency", "T", *en)


@register("bgnbd_expected_small_alpha_customers")
def q_bgnbd_expected_small_alpha_customers(spark, sf_dir):
    """Ten years ahead, for every repeater with its own frequency, t_x and T
    (days). No SQL: its direct series needs 120,000 terms a row."""
    from dataclasses import replace
    en = [r6(BG.expected_purchases(replace(FIXED_BGNBD, alpha=a), 3650, "frequency", "t_x", "T")).alias(f"expected_{i}")
          for i, a in enumerate(SMALL_ALPHAS)]
    return repeater_summary(spark, sf_dir).select("customer_id", "frequency", "t_x", "T", *en)


@register("bgnbd_p_alive")
def q_bgnbd_p_alive(spark, sf_dir):
    s = repeater_summary(spark, sf_dir)
    return s.select("customer_id", r6(BG.p_alive(FIXED_BGNBD, "frequency", "t_x", "T")).alias("p_alive"))


@register("gg_expected_value")
def q_gg_expected_value(spark, sf_dir):
    s = repeater_summary(spark, sf_dir)
    return s.select("customer_id", r6(GG.expected_value(FIXED_GAMMA_GAMMA, "frequency", "monetary_value"))
                    .alias("expected_value"))


@register("clv_repeater")
def q_clv_repeater(spark, sf_dir):
    """M13 with a 10% annual discount over the 365-day horizon."""
    s = repeater_summary(spark, sf_dir)
    en = BG.expected_purchases(FIXED_BGNBD, XDAYS, "frequency", "t_x", "T")
    ev = GG.expected_value(FIXED_GAMMA_GAMMA, "frequency", "monetary_value")
    return s.select("customer_id", cents(GG.lifetime_value(en, ev, XDAYS)).alias("clv"),
                    cents(GG.lifetime_value(en, ev, XDAYS, 0.10)).alias("clv_discounted"))


@register("cox_return_prob")
def q_cox_return_prob(spark, sf_dir):
    f = features(spark, sf_dir).where(F.col("visit_count") == 1)
    return f.select("customer_id", r6(CX.return_probability(FIXED_COX, XDAYS)).alias("p_return"))


COX_TIMES = (90, 180, 365, 500)


@register("cox_survival")
def q_cox_survival(spark, sf_dir):
    f = features(spark, sf_dir).where(F.col("visit_count") == 1)
    m = CX.CoxParams(FIXED_COX.features, FIXED_COX.coef, FIXED_COX.mean, FIXED_COX_BASELINE)
    per_t = F.array(*[F.struct(F.lit(t).cast("long").alias("t"),
                               CX.survival_at(m, float(t)).alias("s")) for t in COX_TIMES])
    return (f.select("customer_id", F.explode(per_t).alias("p"))
            .select("customer_id", F.col("p.t").alias("t"), r6(F.col("p.s")).alias("survival")))




@register("clv_onetimer")
def q_clv_onetimer(spark, sf_dir):
    f = features(spark, sf_dir).where(F.col("visit_count") == 1)
    p = CX.return_probability(FIXED_COX, XDAYS)
    return f.select("customer_id", cents(p * F.col("avg_spend")).alias("clv"))


@register("clv_fallback")
def q_clv_fallback(spark, sf_dir):
    f = features(spark, sf_dir)
    en, ev, pa = AN.repeater_terms(AN.ModelBundle(), XDAYS, scoring_rule=True)
    one = F.col("visit_count") == 1
    return f.select(
        "customer_id",
        cents(F.when(one, F.lit(C.FALLBACK_P_RETURN) * F.col("avg_spend")).otherwise(en * ev)).alias("clv"),
        r6(F.when(one, F.lit(None)).otherwise(en)).alias("expected_purchases"),
        F.when(one, F.lit(None)).otherwise(pa).alias("p_alive"))


@register("cox_baseline")
def q_cox_baseline(spark, sf_dir):
    b = CX.breslow_baseline(features(spark, sf_dir), FIXED_COX, cols=["avg_spend"])
    return b.select("duration", "events", r6("baseline_hazard").alias("baseline_hazard"),
                    r6("cumulative_hazard").alias("cumulative_hazard"))


@register("cox_loglik")
def q_cox_loglik(spark, sf_dir):
    ll = CX.efron_loglik(features(spark, sf_dir), FIXED_COX, cols=["avg_spend"])
    return ll.select(r6("log_likelihood").alias("log_likelihood"), "n_events")


def analysis(spark, sf_dir) -> DataFrame:
    return AN.rfm_vs_clv(clean_txn(spark, sf_dir), SNAP, fixed_models(), XDAYS)


def _report(df: DataFrame) -> DataFrame:
    return df.select("customer_id", "group", "channel", "channel_group", "rfm_score", "segment",
                     cents("clv").alias("clv"), "clv_level", "mismatch")


@register("rfm_vs_clv")
def q_rfm_vs_clv(spark, sf_dir):
    return _report(analysis(spark, sf_dir))


@register("union_clv")
def q_union_clv(spark, sf_dir):
    t = AN.clv_table(clean_txn(spark, sf_dir), SNAP, fixed_models(), XDAYS)
    return t.select("customer_id", "group", cents("clv").alias("clv"))


@register("join_latest_channel")
def q_join_latest_channel(spark, sf_dir):
    t = AN.clv_table(clean_txn(spark, sf_dir), SNAP, fixed_models(), XDAYS)
    return t.select("customer_id", "group", "channel", "channel_group")


@register("join_rfm")
def q_join_rfm(spark, sf_dir):
    t = AN.clv_table(clean_txn(spark, sf_dir), SNAP, fixed_models(), XDAYS)
    return t.select("customer_id", "group", "rfm_score", "segment", cents("clv").alias("clv"))


@register("clv_level_quartile")
def q_clv_level_quartile(spark, sf_dir):
    return analysis(spark, sf_dir).select("customer_id", cents("clv").alias("clv"), "clv_level")


@register("mismatch")
def q_mismatch(spark, sf_dir):
    return analysis(spark, sf_dir).select("customer_id", "segment", "clv_level", "mismatch")


@register("mismatch_counts")
def q_mismatch_counts(spark, sf_dir):
    return analysis(spark, sf_dir).groupBy("mismatch").agg(F.count(F.lit(1)).alias("customers"))


@register("underrated_list")
def q_underrated_list(spark, sf_dir):
    u = AN.underrated(analysis(spark, sf_dir))
    return u.select("customer_id", "segment", "rfm_score", cents("clv").alias("clv"), "mismatch")


@register("target_list")
def q_target_list(spark, sf_dir):
    t = AN.target_list(analysis(spark, sf_dir))
    return t.select("customer_id", cents("clv").alias("clv"), "group", "channel", "channel_group",
                    "rfm_score", "segment", "clv_level")


TOP_N = 100


@register("top_clv")
def q_top_clv(spark, sf_dir):
    """O3: the top-N report (the limit is the feature), ties by id."""
    a = analysis(spark, sf_dir)
    return (a.orderBy(F.desc("clv"), F.asc("customer_id")).limit(TOP_N)
            .select("customer_id", cents("clv").alias("clv"), "group", "segment"))


@register("clv_histogram")
def q_clv_histogram(spark, sf_dir):
    h = PR.histogram(analysis(spark, sf_dir), "clv", "group", bins=30)
    return h.select("group", "bin", cents("bin_lo").alias("bin_lo"), cents("bin_hi").alias("bin_hi"), "customers")


def _channel_models(spark, sf_dir):
    """F6 guard: a model only for first-visit channel groups with at least
    the minimum number of modelled customers (small, <= 6 rows)."""
    f = features(spark, sf_dir).dropna(subset=["duration", "event", "avg_spend"])
    rows = f.groupBy("channel_group").count().collect()
    keep = {r["channel_group"] for r in rows if r["count"] >= C.MIN_CHANNEL_ROWS}
    m = fixed_models(per_channel=True)
    m.cox_by_channel = {g: p for g, p in m.cox_by_channel.items() if g in keep}
    return m


@register("union_channels")
def q_union_channels(spark, sf_dir):
    """U2/M2 scoring: per-channel Cox for one-timers (channels without a
    model drop out), joined once on the channel group."""
    t = AN.clv_table(clean_txn(spark, sf_dir), SNAP, _channel_models(spark, sf_dir), XDAYS,
                     per_channel=True)
    return t.where(F.col("group") == C.GROUP_ONETIMER).select("customer_id", cents("clv").alias("clv"))


# ------------------------------------------------ scoring requests

from ..sources import requests as RQ  # noqa: E402
from . import scoring as SC  # noqa: E402

REQUEST_CUSTOMERS = 100      # customers per test request (the API's intended cap)


def request_rows(spark, sf_dir) -> DataFrame:
    """Flat scoring rows from the visit history before 1996-01-01: one
    request per block of 100 customer ids; snapshots 0/30/60 days after the
    history end and horizons 365/180 vary by request."""
    t = clean_txn(spark, sf_dir)
    rid = F.expr(f"customer_id div {REQUEST_CUSTOMERS}")
    return t.select(
        rid.alias("request_id"),
        F.date_add(F.lit(SNAP).cast("date"), (F.pmod(rid, F.lit(3)) * 30).cast("int"))
        .cast("timestamp_ntz").alias("snapshot_ts"),
        F.when(F.pmod(rid, F.lit(2)) == 0, F.lit(365)).otherwise(F.lit(180)).cast("long").alias("xdays"),
        "customer_id", "txn_id", "arrival_ts", "revenue", "channel")


def predictions(spark, sf_dir, lenient=False) -> DataFrame:
    return SC.score_customers(request_rows(spark, sf_dir), fixed_models(), lenient=lenient)


@register("score_customers")
def q_score_customers(spark, sf_dir):
    return predictions(spark, sf_dir)


LIST_CUSTOMERS = 1000


@register("scan_customer_json")
def q_scan_customer_json(spark, sf_dir):
    """All visits written as bare customer lists (JSON arrays of about
    LIST_CUSTOMERS customers, each one line of a file), read back by byte ranges."""
    from ..session import shared_path
    from ..sources.json_list import read_customer_list
    from ..sources.requests import flatten_requests, request_defaults
    t = testdata_transactions(spark, sf_dir)
    visit = F.struct(F.date_format("arrival_ts", "yyyy-MM-dd HH:mm:ss").alias("Arrival Date"), F.col("revenue").alias("Total Revenue USD"),
                     F.col("channel").alias("Channel"))
    customers = t.groupBy("customer_id").agg(F.collect_list(visit).alias("transactions"))
    lists = -(-customers.count() // LIST_CUSTOMERS)
    body = F.to_json(F.struct(F.col("customer_id").cast("string").alias("CustomerID"), "transactions"))
    path = shared_path(spark, f"lists-{uuid.uuid4().hex}")
    (customers.select(F.pmod(F.xxhash64("customer_id"), F.lit(max(lists, 1))).alias("list"), body.alias("body")).groupBy("list")
     .agg(F.concat(F.lit("["), F.array_join(F.collect_list("body"), ", "), F.lit("]")).alias("value"))
     .write.partitionBy("list").text(path))
    return flatten_requests(request_defaults(read_customer_list(spark, path))).select("customer_id", "arrival_ts", "revenue", "channel")


@register("score_published")
def q_score_published(spark, sf_dir):
    """A store is published twice (first without models), and the
    requests are scored with what a reader then loads."""
    from ..session import shared_path
    from ..sinks.store import Store
    store = Store(spark, shared_path(spark, f"models-{uuid.uuid4().hex}"))
    store.publish(AN.ModelBundle())
    store.publish(fixed_models())
    return SC.score_customers(request_rows(spark, sf_dir), store.load())


@register("score_customers_fallback")
def q_score_customers_fallback(spark, sf_dir):
    return SC.score_customers(request_rows(spark, sf_dir), AN.ModelBundle())


@register("score_customers_lenient")
def q_score_customers_lenient(spark, sf_dir):
    return predictions(spark, sf_dir, lenient=True)


@register("clv_level_abs")
def q_clv_level_abs(spark, sf_dir):
    return predictions(spark, sf_dir).select("request_id", "customer_id", "group", "clv", "clv_level")


@register("round_output")
def q_round_output(spark, sf_dir):
    return predictions(spark, sf_dir).select("request_id", "customer_id", "clv", "p_return", "avg_spend",
                                             "expected_purchases", "expected_value", "p_alive", "recency")


@register("lookup_rfm_default")
def q_lookup_rfm_default(spark, sf_dir):
    """J6 with scores for repeaters only: one-timers take the defaults."""
    feats = CU.customer_features(request_rows(spark, sf_dir), "snapshot_ts", keys=("request_id", "customer_id", "xdays"))
    rfm = SC.request_rfm(feats.where(F.col("visit_count") > 1)).select("request_id", "customer_id", "rfm_score", "segment")
    return SC.lookup_rfm(feats.select("request_id", "customer_id"), rfm)


@register("rfm_constant")
def q_rfm_constant(spark, sf_dir):
    return predictions(spark, sf_dir, lenient=True).select("request_id", "customer_id", "rfm_score",
                                                           "segment", "mismatch")


@register("inner_summary")
def q_inner_summary(spark, sf_dir):
    """J8 with summaries of the visits of even orders only: repeaters without
    one drop out."""
    rows = request_rows(spark, sf_dir)
    keys = ("request_id", "customer_id", "xdays")
    feats = CU.customer_features(rows, "snapshot_ts", keys=keys).select("request_id", "customer_id", "visit_count")
    even = CU.customer_features(rows.where(F.col("txn_id") % 2 == 0), "snapshot_ts", keys=keys)
    both = feats.join(even.select("request_id", "customer_id", "days_frequency", "t_x"), ["request_id", "customer_id"], "left")
    return both.where(SC.has_summary())


@register("request_rfm")
def q_request_rfm(spark, sf_dir):
    feats = CU.customer_features(request_rows(spark, sf_dir), "snapshot_ts",
                                 keys=("request_id", "customer_id", "xdays"))
    return SC.request_rfm(feats).select("request_id", "customer_id", "r_score", "f_score", "m_score",
                                        "rfm_score", "segment")


def request_bodies(spark, sf_dir) -> DataFrame:
    """Nested JSON request bodies built from the visit history: whole
    customers, at most 100 customer ids a request."""
    rid = F.expr(f"customer_id div {REQUEST_CUSTOMERS}")
    v = clean_txn(spark, sf_dir).select(
        rid.alias("rid"), F.col("customer_id").cast("string").alias("cid"),
        F.struct(F.date_format("arrival_ts", "yyyy-MM-dd").alias("Arrival Date"),
                 F.col("revenue").alias("Total Revenue USD"),
                 F.col("channel").alias("Channel")).alias("t"))
    cust = v.groupBy("rid", "cid").agg(F.collect_list("t").alias("transactions"))
    req = cust.groupBy("rid").agg(F.collect_list(F.struct(
        F.col("cid").alias("CustomerID"), "transactions")).alias("customers"))
    return req.select("rid", F.to_json(F.struct(
        F.col("rid").cast("string").alias("request_id"),
        F.lit(SNAP).alias("snapshot_date"), F.lit(365).alias("xdays"), "customers")).alias("body"))


@register("scan_requests")
def q_scan_requests(spark, sf_dir):
    reqs = RQ.request_defaults(RQ.parse_requests(request_bodies(spark, sf_dir)))
    flat = RQ.flatten_requests(reqs)
    return flat.select(F.col("customer_id").cast("long").alias("customer_id"), "arrival_ts",
                       "revenue", "channel", "snapshot_ts", "xdays")


RESPONSE_FIELDS = ("CustomerID", "CLV", "group", "P_return", "avg_spend", "expected_purchases", "expected_value", "P_alive",
                   "frequency", "recency", "RFM_Score", "Segment", "CLV_Level", "Mismatch")


@register("response_json")
def q_response_json(spark, sf_dir):
    """The bodies, read back: one row per prediction with its fields as text."""
    fields = ", ".join(f"`{f}`: string" for f in RESPONSE_FIELDS)
    shape = f"struct<predictions: array<struct<{fields}>>, count: bigint>"
    out = SC.response_json(predictions(spark, sf_dir)).select("request_id", F.from_json("body", shape).alias("b"))
    flat = out.select("request_id", F.col("b.count").alias("count"), F.explode("b.predictions").alias("p")).select("request_id", "count", "p.*")
    numbers = {"CLV", "P_return", "avg_spend", "expected_purchases", "expected_value", "P_alive", "recency"}
    return flat.select("request_id", "count", *[
        F.col(f).cast("double" if f in numbers else "long" if f in ("CustomerID", "frequency", "RFM_Score") else "string").alias(f"f_{f}".lower())
        for f in RESPONSE_FIELDS])


@register("response_edge_cases")
def q_response_edge_cases(spark, sf_dir):
    """Every request of the table as it is, twice over, emptied, cut short, as
    a bare customer list and with an unreadable date: predictions of each, and
    what is rejected."""
    b = request_bodies(spark, sf_dir)
    kinds = [("asis", F.col("body")), ("again", F.col("body")), ("empty", F.lit('{"customers": []}')),
             ("cut", F.substring("body", 1, 40)), ("list", F.get_json_object("body", "$.customers")),
             ("baddate", F.regexp_replace("body", '"Arrival Date":"[^"]*"', '"Arrival Date":"some day"'))]
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), e.alias("body")) for k, e in kinds]))
    named = b.select("rid", rows.alias("r")).select(F.concat_ws("/", "r.kind", F.col("rid").cast("string")).alias("key"), "r.body")
    reqs = RQ.request_defaults(RQ.parse_requests(named, "body", "key"), SNAP, 365).persist()
    body = SC.response_json(SC.score_customers(RQ.flatten_requests(reqs), fixed_models()), reqs)
    bad = RQ.rejected_visits(reqs).groupBy("request_id").agg(F.count(F.lit(1)).alias("bad_visits"))
    return (body.join(bad, "request_id", "left").join(RQ.rejected_requests(reqs).select("request_id", "error"), "request_id", "left")
            .select("request_id", "count", F.coalesce("bad_visits", F.lit(0)).alias("bad_visits"), "error"))


# ------------------------------------------- fitters (rows-only checks)

from ..models import fit_bgnbd as FB  # noqa: E402
from ..models import fit_cox as FC  # noqa: E402
from ..models import fit_gamma_gamma as FG  # noqa: E402
from .training import metric_rows, params_table  # noqa: E402

BGNBD_PENALIZER = 0.001


def flags(spark, rows: list[tuple[str, bool]]) -> DataFrame:
    """Checks of a fit, which the oracle expects to hold."""
    return spark.createDataFrame([(k, bool(v)) for k, v in rows], "name string, ok boolean")


def is_optimum(objective, params: dict, step: float = 0.02) -> bool:
    """No parameter moved by ``step`` of itself either way gives a lower
    objective (evaluated by the closed-form log-likelihood, not the fitter)."""
    best = objective(params)
    return all(objective({**params, k: v * s}) >= best - 1e-12 * abs(best) for k, v in params.items() for s in (1 + step, 1 - step))


@register("bgnbd_fit")
def q_bgnbd_fit(spark, sf_dir):
    s = repeater_summary(spark, sf_dir).select("frequency", "t_x", "T").persist()
    p, _, m = FB.fit(s, penalizer=BGNBD_PENALIZER)

    def objective(q):
        scaled = {**q, "alpha": q["alpha"] * m["scale"]}
        return -FB.log_likelihood(s, BG.BgNbdParams(**q)) / m["n_customers"] + BGNBD_PENALIZER * sum(v * v for v in scaled.values())
    fixed = objective(FIXED_BGNBD.as_dict())
    return flags(spark, [("converged", m["converged"]), ("gradient", m["gradient"] < 1e-4),
                         ("optimum", is_optimum(objective, p.as_dict())), ("not_above_fixed", objective(p.as_dict()) <= fixed + 1e-9)])


GG_PENALIZER = 0.0001


@register("gg_fit")
def q_gg_fit(spark, sf_dir):
    s = repeater_summary(spark, sf_dir).select("frequency", "monetary_value").persist()
    p, _, m = FG.fit(s, penalizer=GG_PENALIZER)

    def objective(q):
        return -FG.log_likelihood(s, GG.GammaGammaParams(**q)) / m["n_customers"] + GG_PENALIZER * sum(v * v for v in q.values())
    return flags(spark, [("converged", m["converged"]), ("gradient", m["gradient"] < 1e-4),
                         ("optimum", is_optimum(objective, p.as_dict()))])


def cox_objective(rows, model):
    """Minus the partial log-likelihood by its closed form, of coefficients."""
    from dataclasses import replace

    def objective(q):
        c = replace(model, coef=tuple(q[f] for f in model.features))
        return -CX.efron_loglik(rows, c).collect()[0]["log_likelihood"]
    return objective


@register("cox_fit")
def q_cox_fit(spark, sf_dir):
    f = features(spark, sf_dir).select("duration", "event", "avg_spend").persist()
    models, mets = FC.fit(f, ("avg_spend",))
    m, met = models[FC.POOLED], mets[FC.POOLED]
    objective = cox_objective(f, m)
    coef = dict(zip(m.features, m.coef))
    return flags(spark, [("converged", met["converged"]), ("optimum", is_optimum(objective, coef)),
                         ("not_above_zero", objective(coef) <= objective({k: 0.0 for k in coef}) + 1e-9),
                         ("likelihood", abs(objective(coef) + met["log_likelihood"]) < 1e-6 * abs(met["log_likelihood"]))])


@register("cox_fit_by_channel")
def q_cox_fit_by_channel(spark, sf_dir):
    f = features(spark, sf_dir).select("duration", "event", "avg_spend", "channel_group").persist()
    models, mets = FC.fit(f, ("avg_spend",), by="channel_group", min_rows=C.MIN_CHANNEL_ROWS)
    rows = []
    for g, m in sorted(models.items()):
        objective = cox_objective(f.where(F.col("channel_group") == g), m)
        rows += [(f"{g}: converged", mets[g]["converged"]), (f"{g}: optimum", is_optimum(objective, dict(zip(m.features, m.coef))))]
    return flags(spark, rows)


@register("bgnbd_loglik")
def q_bgnbd_loglik(spark, sf_dir):
    ll = FB.log_likelihood(repeater_summary(spark, sf_dir), FIXED_BGNBD)
    return spark.createDataFrame([(round(ll, 6),)], "log_likelihood double")


@register("gg_loglik")
def q_gg_loglik(spark, sf_dir):
    ll = FG.log_likelihood(repeater_summary(spark, sf_dir), FIXED_GAMMA_GAMMA)
    return spark.createDataFrame([(round(ll, 6),)], "log_likelihood double")


# ------------------------------------------------ composite plans

from . import training as TR  # noqa: E402


@register("prep_training")
def q_prep_training(spark, sf_dir):
    """E1 'transactions' frame (the other five frames are registered as
    customer_agg, rfm_scores, split_onetimers, split_repeaters, latest_channel)."""
    frames = TR.prep_training(testdata_transactions(spark, sf_dir), SNAP)
    return frames["transactions"].select("txn_id", "customer_id", "channel_group", *DUMMY_COLUMNS,
                                         "visit_count", "repeat")


def prep_frame(spark, sf_dir, name) -> DataFrame:
    return TR.prep_training(testdata_transactions(spark, sf_dir), SNAP)[name]


@register("prep_customer_data")
def q_prep_customer_data(spark, sf_dir):
    c = prep_frame(spark, sf_dir, "customer_data")
    return c.select("customer_id", "visit_count", r6("avg_spend").alias("avg_spend"))


@register("prep_rfm")
def q_prep_rfm(spark, sf_dir):
    return prep_frame(spark, sf_dir, "rfm").select("customer_id", "r_score", "f_score", "m_score", "segment")


@register("prep_one_timers")
def q_prep_one_timers(spark, sf_dir):
    return prep_frame(spark, sf_dir, "one_timers").select("txn_id", "customer_id", "repeat")


@register("prep_repeaters")
def q_prep_repeaters(spark, sf_dir):
    return prep_frame(spark, sf_dir, "repeaters").select("txn_id", "customer_id", "repeat")


@register("prep_latest_channel")
def q_prep_latest_channel(spark, sf_dir):
    return prep_frame(spark, sf_dir, "latest_channel").select("customer_id", "channel", "channel_group")


def nan_txn(spark, sf_dir) -> DataFrame:
    """Visits whose revenue is NaN for every fifth order and text for none."""
    t = testdata_transactions(spark, sf_dir)
    return t.withColumn("revenue", F.when(F.col("txn_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("revenue")))


@register("clean_strict_nan")
def q_clean_strict_nan(spark, sf_dir):
    return CL.clean_strict(nan_txn(spark, sf_dir), SNAP).select("txn_id", "customer_id", "arrival_ts", "revenue")


@register("clean_lenient_nan")
def q_clean_lenient_nan(spark, sf_dir):
    return CL.clean_lenient(nan_txn(spark, sf_dir), SNAP).select("txn_id", "customer_id", "arrival_ts", "revenue")


@register("channel_spend_all_orders")
def q_channel_spend_all_orders(spark, sf_dir):
    """A4 over every order, without a snapshot."""
    return PR.frequency_table(testdata_transactions(spark, sf_dir), "channel")


@register("prep_lenient")
def q_prep_lenient(spark, sf_dir):
    frames = TR.prep_lenient(testdata_transactions(spark, sf_dir), SNAP)
    return frames["repeaters"].select("txn_id", "customer_id", "tx_count", "customer_type")


@register("prep_inference")
def q_prep_inference(spark, sf_dir):
    """Customer-level frame of every request (per-request snapshot)."""
    f = CU.customer_features(request_rows(spark, sf_dir), "snapshot_ts",
                             keys=("request_id", "customer_id", "xdays"))
    return f.select("request_id", "customer_id", "visit_count", r6("avg_spend").alias("avg_spend"),
                    "duration", "recency", "days_frequency", "t_x", "T",
                    r6("monetary_value").alias("monetary_value"))


@register("flatten_requests")
def q_flatten_requests(spark, sf_dir):
    return q_scan_requests(spark, sf_dir)


@register("request_defaults")
def q_request_defaults(spark, sf_dir):
    """Requests without snapshot / with xdays 0 take the defaults."""
    b = request_bodies(spark, sf_dir)
    parsed = RQ.parse_requests(b)
    half = F.pmod(F.col("caller_id").cast("long"), F.lit(2)) == 0
    parsed = (parsed.withColumn("snapshot_date", F.when(half, F.col("snapshot_date")))
              .withColumn("xdays", F.when(half, F.col("xdays")).otherwise(F.lit(0))))
    d = RQ.request_defaults(parsed)
    return d.select(F.col("caller_id").alias("request_id"), "snapshot_ts", "xdays")


HEAD_N = 10


@register("head_sample")
def q_head_sample(spark, sf_dir):
    """Preview of the first repeaters' summary rows (the limit is the feature)."""
    s = repeater_summary(spark, sf_dir).orderBy("customer_id").limit(HEAD_N)
    return s.select("customer_id", "frequency", "t_x", "T", r6("monetary_value").alias("monetary_value"))


@register("train_all")
def q_train_all(spark, sf_dir):
    """Fit all models; what must hold of them."""
    models, table = TR.train_all(testdata_transactions(spark, sf_dir), SNAP, bgnbd_penalizer=BGNBD_PENALIZER, gg_penalizer=GG_PENALIZER)
    got = {(r["model"], r["name"]): r["value"] for r in table.collect()}
    return flags(spark, [(f"{m} converged", got[m, "converged"] == 1.0) for m in ("cox", "bgnbd", "gamma_gamma")]
                 + [("concordance in range", 0.0 < got["cox", "concordance_index"] < 1.0),
                    ("baseline rises", list(models.cox.baseline) == sorted(models.cox.baseline, key=lambda p: (p[0], p[1])))])


@register("cox_concordance")
def q_cox_concordance(spark, sf_dir):
    """M6 at fixed coefficients: score = linear predictor (higher = riskier)."""
    from ..models.concordance import concordance
    c = concordance(features(spark, sf_dir), "duration", "event", CX.linear_predictor(FIXED_COX, ["avg_spend"]))
    return c.select("pairs", "concordant", "tied", r6("concordance_index").alias("concordance_index"))


# ------------------------------------- purchase events (times of day, T2/T3)

EVENTS_SNAP = "2024-01-20 12:00:00"


def event_visits(spark, sf_dir) -> DataFrame:
    return CL.clean_strict(SRC.testdata_events(spark, sf_dir), EVENTS_SNAP)


@register("rfm_scores_events")
def q_rfm_scores_events(spark, sf_dir):
    s = RF.rfm_scores(CU.rfm_features(event_visits(spark, sf_dir), EVENTS_SNAP))
    return s.select("customer_id", "recency", "frequency", r6("monetary").alias("monetary"),
                    "r_score", "f_score", "m_score", "rfm_score", "segment")


@register("purchase_summary_events")
def q_purchase_summary_events(spark, sf_dir):
    s = CU.purchase_summary(event_visits(spark, sf_dir), EVENTS_SNAP)
    return s.select("customer_id", "frequency", "t_x", "T", r6("monetary_value").alias("monetary_value"),
                    "n_visits")


@register("customer_agg_events")
def q_customer_agg_events(spark, sf_dir):
    f = CU.customer_features(event_visits(spark, sf_dir), EVENTS_SNAP)
    return f.select("customer_id", "first_date", "last_date", "visit_count", r6("avg_spend").alias("avg_spend"),
                    "duration", "recency", "event", "days_frequency", "t_x", "T")


def fitted_models(spark, sf_dir):
    return TR.train_all(testdata_transactions(spark, sf_dir), SNAP, bgnbd_penalizer=BGNBD_PENALIZER, gg_penalizer=GG_PENALIZER,
                        with_concordance=False)[0]


@register("rfm_vs_clv_fitted_report")
def q_rfm_vs_clv_fitted_report(spark, sf_dir):
    """The analysis end to end with models fitted on the same visits: the row
    of every customer. No SQL, as it cannot fit."""
    return _report(AN.rfm_vs_clv(clean_txn(spark, sf_dir), SNAP, fitted_models(spark, sf_dir), XDAYS))


@register("rfm_vs_clv_fitted")
def q_rfm_vs_clv_fitted(spark, sf_dir):
    """Checks of ``rfm_vs_clv_fitted_report``: all customers, no value missing
    or negative, quartiles of equal size."""
    models = fitted_models(spark, sf_dir)
    out = AN.rfm_vs_clv(clean_txn(spark, sf_dir), SNAP, models, XDAYS)
    per = out.groupBy("clv_level").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~(F.col("clv") >= 0) | F.col("clv").isNull(), 1)).alias("bad"))
    return per.agg(F.sum("n").alias("customers"), F.sum("bad").alias("bad"), (F.max("n") - F.min("n") <= 1).alias("quartiles"))

"""Score every customer of every request in one plan (no row loop).

Per request (all windows keyed by request_id, so micro-batch boundaries and
other requests never change a result): customer features, RFM quintiles of
the request's own customers, one-timer return probability x mean spend,
repeater expected purchases x expected spend, absolute CLV level and the
mismatch label; outputs rounded like the API response (P15).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import clv_level_abs, mismatch, rfm_code, segment_name
from ..models import bgnbd as BG
from ..models import cox as CX
from ..models import gamma_gamma as GG
from ..operators.customers import customer_features
from ..operators.quantiles import bucket_by_edge_columns
from .models import ModelBundle

PREDICTION_COLUMNS = ("request_id", "customer_id", "group", "clv", "p_return", "avg_spend",
                      "expected_purchases", "expected_value", "p_alive", "frequency", "recency",
                      "rfm_score", "segment", "clv_level", "mismatch")


def _rank_buckets(rn: str, n: str, q: int = 5) -> F.Column:
    """Quantile bucket of a 1-based rank ``rn`` among ``n`` (column names);
    one SQL expression (a single driver round trip)."""
    terms = " + ".join(f"CASE WHEN {q} * (`{rn}` - 1) > {i} * (`{n}` - 1) THEN 1 ELSE 0 END"
                       for i in range(1, q))
    return F.expr(f"1 + {terms}")


def _edges_from_ranks(value: str, rn: str, q: int, prefix: str, n: str = "_n") -> tuple[list, list]:
    """Aggregates picking the order statistics around each edge position of
    a ranked column (rank ``rn`` 1-based, group size ``n``), and the edge
    expressions over those aggregates (SQL text: one round trip each)."""
    aggs, edges = [], []
    for i in range(1, q):
        lo = f"CAST(floor(({i} * (`{n}` - 1)) / {q}) AS BIGINT)"
        lo_c, hi_c, rem_c = f"_{prefix}lo{i}", f"_{prefix}hi{i}", f"_{prefix}rem{i}"
        aggs += [F.expr(f"max(CASE WHEN `{rn}` - 1 = {lo} THEN CAST(`{value}` AS DOUBLE) END)").alias(lo_c),
                 F.expr(f"max(CASE WHEN `{rn}` - 1 = {lo} + 1 THEN CAST(`{value}` AS DOUBLE) END)").alias(hi_c),
                 F.expr(f"max(pmod(CAST({i} * (`{n}` - 1) AS BIGINT), {q}))").alias(rem_c)]
        edges.append(F.expr(f"CASE WHEN `{rem_c}` = 0 THEN `{lo_c}` ELSE `{lo_c}` + (`{hi_c}` - `{lo_c}`) "
                            f"* (CAST(`{rem_c}` AS DOUBLE) / {q}) END").alias(f"{prefix}{i}"))
    return aggs, edges


def request_rfm(feats: DataFrame) -> DataFrame:
    """RFM scores inside each request (request_id, customer_id -> scores).

    One window pass partitioned by request gives the three ranks and the
    request size; the edge aggregate and the join back reuse that
    partitioning. A request is one JSON record, read as one row by one task,
    so its customers are bounded by what a record can hold. A customer
    without a readable visit date has no recency and no recency score."""
    w = Window.partitionBy("request_id")
    ranked = feats.select(
        "request_id", "customer_id", "recency", "frequency", "monetary",
        F.row_number().over(w.orderBy(F.col("recency").asc_nulls_last(), "customer_id")).alias("_rr"),
        F.row_number().over(w.orderBy("monetary", "customer_id")).alias("_rm"),
        F.row_number().over(w.orderBy("frequency", "customer_id")).alias("_rn"),
        F.count("recency").over(w).alias("_nr"), F.count(F.lit(1)).over(w).alias("_n"))
    r_aggs, r_edges = _edges_from_ranks("recency", "_rr", 5, "r_e", "_nr")
    m_aggs, m_edges = _edges_from_ranks("monetary", "_rm", 5, "m_e")
    edges = ranked.groupBy("request_id").agg(*r_aggs, *m_aggs).select("request_id", *r_edges, *m_edges)
    j = ranked.join(edges, ["request_id"])
    s = j.select(
        "request_id", "customer_id",
        F.when(F.col("recency").isNotNull(), F.lit(6) - bucket_by_edge_columns("recency", [f"r_e{i}" for i in range(1, 5)])).cast("long").alias("r_score"),
        _rank_buckets("_rn", "_n").cast("long").alias("f_score"),
        bucket_by_edge_columns("monetary", [f"m_e{i}" for i in range(1, 5)]).cast("long").alias("m_score"))
    s = s.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    return s.withColumn("rfm_segment", rfm_code("r_score", "f_score", "m_score")) \
            .withColumn("segment", segment_name("rfm_score"))


def _with_hazard(df: DataFrame, model: CX.CoxParams) -> DataFrame:
    """Adds ``_h0``, the baseline hazard at the row's horizon: looked up once
    per distinct horizon, however many there are, and joined back."""
    h = df.select("xdays").distinct().withColumn("_h0", CX.hazard_at(model, F.col("xdays").cast("double")))
    return df.join(h, "xdays")


def lookup_rfm(customers: DataFrame, rfm: DataFrame, keys=("request_id", "customer_id")) -> DataFrame:
    """The customers' RFM score and segment, defaults where there is none."""
    return (customers.join(rfm, list(keys), "left")
            .withColumn("rfm_score", F.coalesce("rfm_score", F.lit(C.MISSING_RFM_SCORE).cast("long")))
            .withColumn("segment", F.coalesce("segment", F.lit(C.MISSING_SEGMENT))))


def has_summary():
    """One-timers, and the repeaters that have a purchase summary."""
    return (F.col("visit_count") == 1) | F.col("days_frequency").isNotNull()


# Model feature names (main and lenient training) -> scoring columns.
COX_FEATURE_COLUMNS = {"avg_spend": "avg_spend", "avg_revenue": "avg_spend",
                       "tx_count": "visit_count", "visit_count": "visit_count"}


def cox_columns(model) -> list[str]:
    return [COX_FEATURE_COLUMNS.get(f, f) for f in model.features]


def score_customers(rows: DataFrame, models: ModelBundle, lenient: bool = False,
                    cached: list | None = None) -> DataFrame:
    """Predictions for flat request rows (request_id, snapshot_ts, xdays,
    customer_id, txn_id, arrival_ts, revenue, channel). Frames persisted
    here are appended to ``cached`` so a caller can release them."""
    caller = ["caller_id"] if "caller_id" in rows.columns else []
    feats = customer_features(rows, "snapshot_ts", keys=("request_id", "customer_id", "xdays", *caller))
    feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
    if cached is not None:
        cached.append(feats)
    xd = F.col("xdays").cast("double")

    if lenient:
        rfm_cols = [F.lit(C.LENIENT_RFM_SCORE).cast("long").alias("rfm_score"),
                    F.lit(C.LENIENT_SEGMENT).alias("segment")]
        scored = feats.select("*", *rfm_cols)
    else:
        rfm = request_rfm(feats).select("request_id", "customer_id", "rfm_score", "segment")
        scored = lookup_rfm(feats, rfm)

    one = F.col("visit_count") == 1
    if models.cox is not None:
        scored = _with_hazard(scored, models.cox)
        p_ret = F.lit(1.0) - F.exp(-F.col("_h0") * CX.partial_hazard(models.cox, cols=cox_columns(models.cox)))
    else:
        p_ret = F.lit(C.FALLBACK_P_RETURN)
    x, T = F.col("days_frequency"), F.col("T")
    if models.bgnbd is not None:
        en = BG.expected_purchases(models.bgnbd, "xdays", "days_frequency", "t_x", "T")
        pa = BG.p_alive(models.bgnbd, "days_frequency", "t_x", "T")
    else:
        # The horizon share is guarded against T = 0 in both variants.
        en = x * (xd / F.greatest(T, F.lit(1)).cast("double"))
        pa = F.lit(C.FALLBACK_P_ALIVE)
    ev = F.col("monetary_value")
    if models.gamma_gamma is not None:
        ev = F.when(x > 0, GG.expected_value(models.gamma_gamma, "days_frequency", "monetary_value")).otherwise(ev)
    # Heavy terms are computed once as columns; everything after refers to
    # them by name (no copies of the series expression in the rules below).
    out = scored.where(has_summary())
    out = out.select(
        "request_id", *caller, "customer_id", "visit_count", "avg_spend", "days_frequency", "t_x",
        "rfm_score", "segment",
        F.when(one, p_ret).alias("_p_ret"),
        F.when(~one, en).alias("_en"),
        F.when(~one, ev).alias("_ev"),
        F.when(~one, pa).alias("_pa"))
    one = F.col("visit_count") == 1
    out = out.withColumn("_clv", F.when(one, F.col("_p_ret") * F.col("avg_spend"))
                         .otherwise(F.col("_en") * F.col("_ev")))
    out = out.withColumn("_one", one).withColumn("clv_level", clv_level_abs("_clv", "_one"))
    x = F.col("days_frequency")
    out = out.select(
        "request_id", *caller, "customer_id",
        F.when(one, F.lit(C.GROUP_ONETIMER)).otherwise(F.lit(C.GROUP_REPEATER)).alias("group"),
        F.round("_clv", 2).alias("clv"),
        F.when(one, F.round("_p_ret", 4)).alias("p_return"),
        F.when(one, F.round("avg_spend", 2)).alias("avg_spend"),
        F.when(~one, F.round("_en", 2)).alias("expected_purchases"),
        F.when(~one, F.round("_ev", 2)).alias("expected_value"),
        (F.when(~one, F.round("_pa", 4)) if not lenient else F.lit(None).cast("double")).alias("p_alive"),
        F.when(~one, x).alias("frequency"),
        (F.when(~one, F.round(F.col("t_x").cast("double"), 0)) if not lenient
         else F.lit(None).cast("double")).alias("recency"),
        "rfm_score", "segment", "clv_level",
        (F.lit(C.MISMATCH_ALIGNED) if lenient else mismatch("segment", "clv_level")).alias("mismatch"),
    )
    return out


def response_json(predictions: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """K3: one response body per request: {"predictions": [...], "count": n},
    each prediction with the field names and fields of its group. With
    ``requests`` every request gets a response: one without predictions an
    empty list, an unreadable one also its error. A body holds all of a
    request's predictions, bounded by the size of the request's own record."""
    common = [F.col("customer_id").alias("CustomerID"), F.col("clv").alias("CLV"), "group"]
    tail = [F.col("rfm_score").alias("RFM_Score"), F.col("segment").alias("Segment"), F.col("clv_level").alias("CLV_Level"),
            F.col("mismatch").alias("Mismatch")]
    one = F.struct(*common, F.col("p_return").alias("P_return"), "avg_spend", *tail)
    rep = F.struct(*common, "expected_purchases", "expected_value", F.col("p_alive").alias("P_alive"), "frequency", "recency", *tail)
    body = predictions.select("request_id", F.when(F.col("group") == C.GROUP_ONETIMER, F.to_json(one))
                              .otherwise(F.to_json(rep)).alias("p"))
    agg = body.groupBy("request_id").agg(F.array_join(F.array_sort(F.collect_list("p")), ", ").alias("ps"), F.count(F.lit(1)).alias("count"))
    error = F.lit(None).cast("string")
    if requests is not None:
        known = requests.select("request_id", F.col("error") if "error" in requests.columns else error.alias("error"))
        agg = known.join(agg, "request_id", "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("long"))
        error = F.col("error")
    return agg.select("request_id", "count", F.concat(
        F.lit('{"predictions": ['), F.coalesce("ps", F.lit("")), F.lit('], "count": '), F.col("count").cast("string"),
        F.when(error.isNotNull(), F.concat(F.lit(', "error": "'), error, F.lit('"'))).otherwise(F.lit("")), F.lit("}")).alias("body"))


def score_single(spark, customer_id: str, transactions: list[dict], models: ModelBundle,
                 snapshot: str | None = None, xdays: int | None = None):
    """Score one customer's history; the first prediction or None."""
    import json as _json

    from ..sources.requests import flatten_requests, parse_requests, request_defaults
    body = _json.dumps({"request_id": "single", "snapshot_date": snapshot, "xdays": xdays,
                        "customers": [{"CustomerID": customer_id, "transactions": transactions}]})
    rows = flatten_requests(request_defaults(parse_requests(spark.createDataFrame([(body,)], "body string"))))
    got = score_customers(rows, models).limit(1).collect()
    return got[0].asDict() if got else None

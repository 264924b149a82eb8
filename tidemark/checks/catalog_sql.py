"""Oracle SQL per registered query name."""

from __future__ import annotations

from .oracle import bucket, rfm_cte, rfm_scores_cte, txn_cte, with_

SQL: dict[str, str] = {}

SQL["scan_txn"] = with_(txn_cte()) + " SELECT txn_id, customer_id, arrival_ts, revenue, channel FROM clean"

SQL["rfm_features"] = with_(txn_cte(), rfm_cte()) + \
    " SELECT customer_id, recency, frequency, round(monetary, 6) AS monetary FROM rfm"

SQL["rfm_scores"] = with_(txn_cte(), rfm_cte(), rfm_scores_cte()) + """
 SELECT customer_id, recency, frequency, round(monetary, 6) AS monetary, r_score, f_score, m_score,
        rfm_segment, rfm_score, segment FROM scored"""

SQL["rfm_segment_counts"] = with_(txn_cte(), rfm_cte(), rfm_scores_cte()) + """
 SELECT segment, count(*) AS customers, round(avg(monetary), 6) AS avg_monetary
 FROM scored GROUP BY segment"""

from .. import config as C  # noqa: E402
from ..functions.columns import DUMMY_COLUMNS  # noqa: E402
from .oracle import edges_cte, feats_cte, floor_days, lenient_cte, money, snap_ts, sround  # noqa: E402

DUMS = ", ".join(DUMMY_COLUMNS)
BASE = with_(txn_cte(), feats_cte())
SCORED = with_(txn_cte(), rfm_cte(), rfm_scores_cte())

SQL["project_cols"] = with_(txn_cte()) + " SELECT customer_id, arrival_ts, revenue, channel FROM txn"
SQL["parse_date"] = """SELECT o_orderkey AS txn_id,
  strptime(CAST(o_orderdate AS VARCHAR), '%Y-%m-%d %H:%M:%S') AS arrival_ts FROM orders"""
SQL["coerce_date"] = """SELECT o_orderkey AS txn_id,
  TRY_CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS arrival_ts,
  TRY_CAST(o_orderpriority AS TIMESTAMP) AS priority_ts FROM orders"""
SQL["strip_headers"] = with_(txn_cte()) + """ SELECT CAST(customer_id AS VARCHAR) AS customer_id,
  CAST(arrival_ts AS VARCHAR) AS arrival_text, CAST(revenue AS VARCHAR) AS revenue_text, channel, txn_id
  FROM txn"""
SQL["scan_lenient"] = with_(txn_cte()) + """ SELECT txn_id, CAST(customer_id AS VARCHAR) AS customer_id,
  arrival_ts, coalesce(TRY_CAST(CAST(revenue AS VARCHAR) AS DOUBLE), 0.0) AS revenue, channel FROM txn"""
SQL["revenue_fallback"] = with_(txn_cte()) + """ SELECT txn_id, revenue AS rev_alt,
  100.0 AS rev_default FROM txn"""
SQL["coerce_number"] = """SELECT o_orderkey AS txn_id,
  coalesce(TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE), 0.0) AS revenue,
  coalesce(TRY_CAST(o_orderstatus AS DOUBLE), 0.0) AS status_num FROM orders"""
SQL["channel_group"] = with_(txn_cte()) + " SELECT txn_id, channel, channel_group FROM enc"
SQL["channel_onehot"] = with_(txn_cte()) + f" SELECT txn_id, channel_group, {DUMS} FROM enc"
SQL["elapsed_days"] = BASE + " SELECT customer_id, duration, recency FROM feats"
_EV_SNAP = "TIMESTAMP '2024-01-10 12:00:00'"
SQL["elapsed_days_events"] = f"""SELECT event_id AS txn_id,
  {floor_days('ts', _EV_SNAP)} AS days_to_snapshot,
  date_diff('day', CAST(ts AS DATE), CAST({_EV_SNAP} AS DATE)) AS calendar_days_to_snapshot
  FROM events WHERE event_type = 'purchase'"""
SQL["event_flag"] = BASE + " SELECT customer_id, visit_count, event FROM feats"
SQL["rfm_segment_name"] = SCORED + " SELECT customer_id, rfm_score, segment FROM scored"
SQL["rfm_code"] = SCORED + \
    " SELECT customer_id, r_score, f_score, m_score, rfm_segment, rfm_score FROM scored"
SQL["customer_type_label"] = with_(txn_cte(), lenient_cte()) + f""" SELECT customer_id, tx_count,
  CASE WHEN tx_count > 1 THEN '{C.TYPE_REPEATER}' ELSE '{C.TYPE_ONETIMER}' END AS customer_type
  FROM len_cust"""
SQL["clean_strict"] = with_(txn_cte()) + " SELECT txn_id, customer_id, arrival_ts, revenue FROM clean"
SQL["clean_lenient"] = with_(txn_cte(), lenient_cte()) + \
    " SELECT txn_id, customer_id, arrival_ts, revenue FROM len_clean"
_FLAG = """, flagged AS (SELECT *, count(*) OVER (PARTITION BY customer_id) AS visit_count,
  CASE WHEN count(*) OVER (PARTITION BY customer_id) > 1 THEN 'Y' ELSE 'N' END AS repeat FROM enc)"""
SQL["split_onetimers"] = with_(txn_cte()) + _FLAG + \
    " SELECT txn_id, customer_id, channel_group, visit_count, repeat FROM flagged WHERE repeat = 'N'"
SQL["split_repeaters"] = with_(txn_cte()) + _FLAG + \
    " SELECT txn_id, customer_id, channel_group, visit_count, repeat FROM flagged WHERE repeat = 'Y'"
SQL["cox_rows"] = BASE + """ SELECT customer_id, duration, event, round(avg_spend, 6) AS avg_spend
  FROM feats WHERE duration IS NOT NULL AND event IS NOT NULL AND avg_spend IS NOT NULL AND duration > 0"""
SQL["gg_rows"] = BASE + """ SELECT customer_id, days_frequency AS frequency,
  round(monetary_value, 6) AS monetary_value FROM feats WHERE monetary_value > 0 AND days_frequency > 0"""
SQL["channel_subset"] = BASE + f""" SELECT channel_group, count(*) AS customers,
  CAST(sum(CASE WHEN visit_count = 1 THEN 1 ELSE 0 END) AS BIGINT) AS one_timers,
  count(*) >= {C.MIN_CHANNEL_ROWS} AS modelled FROM feats GROUP BY channel_group"""
SQL["onetimer_customers"] = BASE + """ SELECT customer_id, first_date, duration,
  round(avg_spend, 6) AS avg_spend, channel_group FROM feats WHERE visit_count = 1"""
SQL["join_first_channel"] = BASE + f" SELECT customer_id, channel_group, {DUMS} FROM feats"
SQL["join_tx_count"] = with_(txn_cte(), lenient_cte()) + f""" SELECT txn_id, customer_id, tx_count,
  CASE WHEN tx_count > 1 THEN '{C.TYPE_REPEATER}' ELSE '{C.TYPE_ONETIMER}' END AS customer_type
  FROM len_flag"""
SQL["semi_repeaters"] = with_(txn_cte()) + """ SELECT txn_id, customer_id, arrival_ts, revenue
  FROM clean WHERE customer_id IN (SELECT customer_id FROM clean GROUP BY 1 HAVING count(*) > 1)"""
SQL["map_repeat_flag"] = with_(txn_cte()) + _FLAG + " SELECT txn_id, customer_id, repeat FROM flagged"
SQL["customer_agg"] = BASE + f""" SELECT customer_id, first_date, last_date, visit_count,
  round(avg_spend, 6) AS avg_spend, duration, event, channel_group, {DUMS} FROM feats"""
SQL["customer_agg_lenient"] = with_(txn_cte(), lenient_cte()) + f""" SELECT customer_id,
  first_arrival, last_arrival, tx_count, round(total_revenue, 6) AS total_revenue,
  round(avg_revenue, 6) AS avg_revenue,
  CASE WHEN tx_count > 1 THEN '{C.TYPE_REPEATER}' ELSE '{C.TYPE_ONETIMER}' END AS customer_type,
  {floor_days('first_arrival', snap_ts())} AS T, CAST(tx_count > 1 AS BIGINT) AS event,
  {floor_days('last_arrival', snap_ts())} AS recency FROM len_cust"""


def _freq_table(key: str, src: str) -> str:
    return f""" SELECT {key}, count(*) AS total_customerid_count,
  count(DISTINCT customer_id) AS distinct_customerid_count,
  CAST(trunc(CAST(sum({money('revenue')}) AS DOUBLE) / count(*)) AS BIGINT) AS avg_total_revenue_usd
  FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}"""


SQL["channel_table"] = with_(txn_cte()) + _freq_table("channel", "clean")
SQL["channel_group_table"] = with_(txn_cte()) + _freq_table("channel_group", "enc")
SQL["sort_freq"] = f"""SELECT *, row_number() OVER (ORDER BY total_customerid_count DESC, channel_group) AS position
  FROM ({SQL["channel_group_table"]})"""
SQL["channel_spend_all_orders"] = with_(txn_cte()) + _freq_table("channel", "txn")
SQL["repeat_table"] = with_(txn_cte()) + _FLAG + """, c AS (SELECT repeat, count(*) AS count
  FROM flagged GROUP BY repeat) SELECT repeat, count, round(count * 100.0 / sum(count) OVER (), 2) AS percent FROM c"""
SQL["repeat_distinct"] = with_(txn_cte()) + _FLAG + """ SELECT repeat,
  count(DISTINCT customer_id) AS distinct_customer_count FROM flagged GROUP BY repeat"""
SQL["spend_by_visit"] = with_(txn_cte()) + _FLAG + """, num AS (SELECT *, row_number() OVER
  (PARTITION BY customer_id ORDER BY arrival_ts, txn_id) AS visit_number FROM flagged WHERE repeat = 'Y')
  SELECT visit_number, round(CAST(sum(""" + money('revenue') + """) AS DOUBLE) / count(*), 6) AS avg_spend
  FROM num GROUP BY visit_number"""
SQL["profile"] = with_(txn_cte()) + """ SELECT (SELECT count(customer_id) FROM txn) AS total_ids,
  (SELECT count(DISTINCT customer_id) FROM txn) AS distinct_ids,
  (SELECT min(arrival_ts) FROM txn) AS min_date, (SELECT max(arrival_ts) FROM txn) AS max_date,
  (SELECT count(DISTINCT customer_id) FROM clean) AS distinct_customers_clean"""
SQL["distinct_values"] = with_(txn_cte()) + """, w AS (SELECT t.channel, o.o_orderstatus AS order_status,
  o.o_orderpriority AS order_priority FROM txn t JOIN orders o ON o.o_orderkey = t.txn_id)
  SELECT DISTINCT column_name, value FROM (
    SELECT 'channel' AS column_name, channel AS value FROM w UNION ALL
    SELECT 'order_status', order_status FROM w UNION ALL
    SELECT 'order_priority', order_priority FROM w) WHERE value IS NOT NULL"""
_REPS = ", reps AS (SELECT * FROM feats WHERE visit_count > 1)"
SQL["purchase_summary"] = BASE + _REPS + """ SELECT customer_id, days_frequency AS frequency, t_x, T,
  round(monetary_value, 6) AS monetary_value FROM reps"""
SQL["train_metrics"] = BASE + _REPS + "," + edges_cte("med", "reps", "monetary_value", 2) + f"""
  SELECT count(*) AS n_customers, round(avg(days_frequency), 6) AS avg_frequency,
  round(avg(t_x), 6) AS avg_recency, round(avg(T), 6) AS avg_T,
  round(CAST(sum({money('monetary_value')}) AS DOUBLE) / count(*), 6) AS avg_monetary_value,
  round((SELECT e FROM med), 6) AS median_monetary_value FROM reps"""
SQL["cox_metrics"] = BASE + """ SELECT count(*) AS n_samples, CAST(sum(event) AS BIGINT) AS n_events,
  round(avg(event), 6) AS event_rate FROM feats"""
SQL["load_stats"] = with_(txn_cte()) + _FLAG + """ SELECT count(*) AS transactions,
  count(DISTINCT customer_id) AS customers,
  count(DISTINCT CASE WHEN repeat = 'N' THEN customer_id END) AS one_timers,
  count(DISTINCT CASE WHEN repeat = 'Y' THEN customer_id END) AS repeaters FROM flagged"""
SQL["visit_counts"] = with_(txn_cte()) + """ SELECT customer_id, count(*) AS visit_count,
  CASE WHEN count(*) = 1 THEN 'one_timer' ELSE 'repeater' END AS customer_class FROM clean GROUP BY 1"""
SQL["visit_number"] = with_(txn_cte()) + """ SELECT txn_id, customer_id, row_number() OVER
  (PARTITION BY customer_id ORDER BY arrival_ts, txn_id) AS visit_number FROM clean"""
SQL["rank_first"] = with_(txn_cte(), rfm_cte()) + """ SELECT customer_id, frequency,
  row_number() OVER (ORDER BY frequency, customer_id) AS f_rank FROM rfm"""
SQL["latest_channel"] = BASE + """ SELECT customer_id, latest_channel AS channel,
  latest_channel_group AS channel_group FROM feats"""
SQL["first_row"] = with_(txn_cte(), feats_cte()) + """ SELECT customer_id, txn_id, arrival_ts, channel,
  channel_group FROM ranked WHERE rn_first = 1"""
SQL["sort_txn"] = with_(txn_cte()) + """ SELECT txn_id, customer_id, arrival_ts, revenue, channel,
  row_number() OVER (ORDER BY customer_id, arrival_ts, txn_id) AS position FROM clean"""
SQL["distinct_customers"] = with_(txn_cte()) + " SELECT DISTINCT customer_id FROM clean"

# ------------------------------------------------ models at fixed params
from ..plans.catalog import COX_TIMES, FIXED_COX_BASELINE, TOP_N  # noqa: E402
from ..plans.models import fixed_models, FIXED_BGNBD as BGP, FIXED_COX as CXP, FIXED_GAMMA_GAMMA as GGP  # noqa: E402
from ..models.cox import CoxParams  # noqa: E402

_r, _al, _a, _b = (repr(float(v)) for v in (BGP.r, BGP.alpha, BGP.a, BGP.b))
_H365 = repr(CXP.cumulative_hazard(365.0))
_LP = f"({repr(CXP.coef[0])} * (avg_spend - {repr(CXP.mean[0])}))"
_PRET = f"(1.0 - exp(-{_H365} * exp({_LP})))"
_POP = repr(GGP.population_mean)
_GW = f"({repr(GGP.p)} * x / ({repr(GGP.p)} * x + {repr(GGP.q - 1.0)}))"


def _bg_ctes(src: str = "reps", t: float = 365.0) -> str:
    tt = repr(float(t))
    return f""",
bg AS (
  SELECT customer_id, CAST(days_frequency AS DOUBLE) AS x, CAST(t_x AS DOUBLE) AS tx,
         CAST(T AS DOUBLE) AS TT, CAST(monetary_value AS DOUBLE) AS mv,
         {tt} / ({_al} + CAST(T AS DOUBLE) + {tt}) AS z
  FROM {src}),
hyp AS (
  SELECT customer_id, 1.0 + sum(exp(ls)) AS f FROM (
    SELECT customer_id, sum(ln(({_r} + x + k) * ({_b} + x + k) / (({_a} + {_b} + x - 1.0 + k) * (k + 1.0)) * z))
             OVER (PARTITION BY customer_id ORDER BY k) AS ls
    FROM bg, range(0, 2000) r(k)) GROUP BY customer_id),
en AS (
  SELECT bg.customer_id, bg.x, bg.mv,
         ({_a} + {_b} + x - 1.0) / ({_a} - 1.0)
           * (1.0 - pow(({_al} + TT) / ({_al} + TT + {tt}), {_r} + x) * hyp.f)
           / (1.0 + CASE WHEN x > 0 THEN {_a} / ({_b} + x - 1.0) * pow(({_al} + TT) / ({_al} + tx), {_r} + x)
                         ELSE 0.0 END) AS expected_purchases,
         CASE WHEN x = 0 THEN 1.0 ELSE 1.0 / (1.0 + {_a} / ({_b} + x - 1.0)
              * pow(({_al} + TT) / ({_al} + tx), {_r} + x)) END AS p_alive,
         (1.0 - {_GW}) * {_POP} + {_GW} * mv AS expected_value
  FROM bg JOIN hyp USING (customer_id))"""


REPS = BASE + _REPS
SQL["bgnbd_expected"] = REPS + _bg_ctes() + \
    " SELECT customer_id, round(expected_purchases, 6) AS expected_purchases FROM en"
SQL["bgnbd_expected_small_alpha"] = REPS + f""", g AS (
  SELECT DISTINCT days_frequency AS frequency, least(T, 4) AS T FROM reps),
 gz AS (SELECT frequency, T, i, al, CAST(frequency AS DOUBLE) AS x, CAST(T AS DOUBLE) AS TT,
        3650.0 / (al + T + 3650.0) AS z FROM g, (VALUES (0, 0.5e0), (1, 4.41e0)) v(i, al)),
 gh AS (SELECT frequency, T, i, 1.0 + sum(exp(ls)) AS f FROM (
        SELECT frequency, T, i, sum(ln(({_r} + x + k) * ({_b} + x + k) / (({_a} + {_b} + x - 1.0 + k) * (k + 1.0)) * z))
               OVER (PARTITION BY frequency, T, i ORDER BY k) AS ls FROM gz, range(0, 120000) r(k)) GROUP BY ALL),
 ge AS (SELECT gz.frequency, gz.T, gz.i, ({_a} + {_b} + x - 1.0) / ({_a} - 1.0) * (1.0 - pow((al + TT) / (al + TT + 3650.0), {_r} + x) * f)
        / (1.0 + CASE WHEN x > 0 THEN {_a} / ({_b} + x - 1.0) * pow((al + TT) / al, {_r} + x) ELSE 0.0 END) AS e
        FROM gz JOIN gh USING (frequency, T, i))
 SELECT frequency, T, round(max(CASE WHEN i = 0 THEN e END), 6) AS expected_0, round(max(CASE WHEN i = 1 THEN e END), 6) AS expected_1
 FROM ge GROUP BY frequency, T"""
SQL["bgnbd_p_alive"] = REPS + _bg_ctes() + " SELECT customer_id, round(p_alive, 6) AS p_alive FROM en"
SQL["gg_expected_value"] = REPS + _bg_ctes() + \
    " SELECT customer_id, round(expected_value, 6) AS expected_value FROM en"
_DISC = repr(1.0 / (1.0 + 0.10) ** (365 / 365.0))
SQL["clv_repeater"] = REPS + _bg_ctes() + f""" SELECT customer_id,
  {sround("expected_purchases * expected_value", 2)} AS clv,
  {sround("expected_purchases * expected_value * " + _DISC, 2)} AS clv_discounted FROM en"""
SQL["cox_return_prob"] = BASE + f" SELECT customer_id, round({_PRET}, 6) AS p_return FROM feats WHERE visit_count = 1"
_cb = CoxParams(CXP.features, CXP.coef, CXP.mean, FIXED_COX_BASELINE)
_TIMES = ", ".join(f"({t}, {repr(_cb.cumulative_hazard(float(t)))})" for t in COX_TIMES)
SQL["cox_survival"] = BASE + f""" SELECT customer_id, CAST(tt.t AS BIGINT) AS t,
  round(exp(-tt.h * exp({_LP})), 6) AS survival
  FROM feats, (VALUES {_TIMES}) tt(t, h) WHERE visit_count = 1"""
SQL["clv_onetimer"] = BASE + f" SELECT customer_id, {sround(_PRET + " * avg_spend", 2)} AS clv FROM feats WHERE visit_count = 1"
SQL["clv_fallback"] = BASE + f""" SELECT customer_id,
  {sround("CASE WHEN visit_count = 1 THEN CAST(" + str(C.FALLBACK_P_RETURN) + " AS DOUBLE) * avg_spend ELSE days_frequency * CAST(365 AS DOUBLE) / greatest(T, 1) * monetary_value END", 2)} AS clv,
  round(CASE WHEN visit_count = 1 THEN NULL ELSE days_frequency * CAST(365 AS DOUBLE) / greatest(T, 1) END, 6)
    AS expected_purchases,
  CASE WHEN visit_count = 1 THEN NULL ELSE {C.FALLBACK_P_ALIVE} END AS p_alive FROM feats"""
_PER = f""",
per AS (
  SELECT duration, sum(event) AS m, sum(exp(lp)) AS S, sum(event * exp(lp)) AS D0, sum(event * lp) AS Dlp
  FROM (SELECT *, {_LP} AS lp FROM feats) GROUP BY duration),
risk AS (
  SELECT *, sum(S) OVER (ORDER BY duration DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS S0
  FROM per)"""
SQL["cox_baseline"] = BASE + _PER + """ SELECT duration, CAST(m AS BIGINT) AS events,
  round(m / S0, 6) AS baseline_hazard,
  round(sum(m / S0) OVER (ORDER BY duration ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6)
    AS cumulative_hazard
  FROM risk"""
SQL["cox_loglik"] = BASE + _PER + """,
ties AS (
  SELECT duration, sum(ln(S0 - l / m * D0)) AS t FROM (
    SELECT duration, S0, D0, m, unnest(range(0, CAST(m AS BIGINT))) AS l FROM risk WHERE m > 0)
  GROUP BY duration)
 SELECT round(sum(Dlp - t), 6) AS log_likelihood, CAST(sum(m) AS BIGINT) AS n_events
 FROM risk JOIN ties USING (duration)"""

# -------------------------------------------------------- E8 analysis
_LEVEL = "CASE " + " ".join(
    f"WHEN {bucket('c_edges', 'clv')} = {i} THEN '{lab}'" for i, lab in enumerate(C.CLV_LEVELS, 1)) + " END"
_MISMATCH = (f"CASE WHEN segment IN ('Champions', 'Loyal Customers') AND clv_level = 'Low' "
             f"THEN '{C.MISMATCH_OVERRATED}' WHEN segment IN ('At Risk', 'Lost') AND clv_level IN ('High', 'Top') "
             f"THEN '{C.MISMATCH_UNDERRATED}' ELSE '{C.MISMATCH_ALIGNED}' END")


def _analysis(pret: str = _PRET, onetimer_filter: str = "TRUE") -> str:
    return (with_(txn_cte(), feats_cte()) + rfm_scores_cte("feats")
            + ", reps AS (SELECT * FROM feats WHERE visit_count > 1)" + _bg_ctes() + f""",
clvt AS (
  SELECT s.customer_id,
         CASE WHEN s.visit_count = 1 THEN 'onetimer' ELSE 'repeater' END AS "group",
         s.latest_channel AS channel, s.latest_channel_group AS channel_group, s.rfm_score, s.segment,
         CASE WHEN s.visit_count = 1 THEN {pret} * s.avg_spend
              ELSE en.expected_purchases * en.expected_value END AS clv
  FROM scored s LEFT JOIN en USING (customer_id)
  WHERE s.visit_count > 1 OR ({onetimer_filter})),
{edges_cte('c_edges', 'clvt', 'clv', 4)},
ana AS (SELECT *, {_LEVEL} AS clv_level FROM clvt),
ana2 AS (SELECT *, {_MISMATCH} AS mismatch FROM ana)""")


ANA = _analysis()
SQL["rfm_vs_clv"] = ANA + """ SELECT customer_id, "group", channel, channel_group, rfm_score, segment,
  @@SCLV@@ AS clv, clv_level, mismatch FROM ana2"""
SQL["union_clv"] = ANA + """ SELECT customer_id, "group", @@SCLV@@ AS clv FROM clvt"""
SQL["join_latest_channel"] = ANA + """ SELECT customer_id, "group", channel, channel_group FROM clvt"""
SQL["join_rfm"] = ANA + """ SELECT customer_id, "group", rfm_score, segment, @@SCLV@@ AS clv FROM clvt"""
SQL["clv_level_quartile"] = ANA + " SELECT customer_id, @@SCLV@@ AS clv, clv_level FROM ana2"
SQL["mismatch"] = ANA + " SELECT customer_id, segment, clv_level, mismatch FROM ana2"
SQL["mismatch_counts"] = ANA + " SELECT mismatch, count(*) AS customers FROM ana2 GROUP BY mismatch"
SQL["underrated_list"] = ANA + f""" SELECT customer_id, segment, rfm_score, @@SCLV@@ AS clv, mismatch
  FROM ana2 WHERE mismatch = '{C.MISMATCH_UNDERRATED}'"""
_GROUPS = ", ".join(f"'{g}'" for g in C.TARGET_CHANNEL_GROUPS)
SQL["target_list"] = ANA + f""" SELECT customer_id, @@SCLV@@ AS clv, "group", channel, channel_group,
  rfm_score, segment, clv_level FROM ana2
  WHERE clv_level IN ('High', 'Top') AND segment NOT IN ('Lost') AND channel_group IN ({_GROUPS})"""
SQL["top_clv"] = ANA + f""" SELECT customer_id, @@SCLV@@ AS clv, "group", segment FROM ana2
  ORDER BY clv DESC, customer_id LIMIT {TOP_N}"""
SQL["clv_histogram"] = ANA + """, rng AS (SELECT min(clv) AS lo, max(clv) AS hi FROM ana2),
 hb AS (SELECT "group", CAST(least(floor((clv - lo) / ((hi - lo) / 30.0)), 29) AS BIGINT) AS bin,
        lo, (hi - lo) / 30.0 AS width FROM ana2, rng)
 SELECT "group", bin, @@BINLO@@ AS bin_lo, @@BINHI@@ AS bin_hi,
        count(*) AS customers FROM hb GROUP BY "group", bin, lo, width"""
_CH_OK = f"""s.channel_group IN (SELECT channel_group FROM feats
  WHERE duration IS NOT NULL AND event IS NOT NULL AND avg_spend IS NOT NULL
  GROUP BY channel_group HAVING count(*) >= {C.MIN_CHANNEL_ROWS})"""
def _channel_pret() -> str:
    """Return probability by the parameters of each channel group."""
    cases = []
    for g, m in fixed_models(per_channel=True).cox_by_channel.items():
        lp = f"({m.coef[0]!r} * (s.avg_spend - {m.mean[0]!r}))"
        cases.append(f"WHEN '{g}' THEN 1.0 - exp(-{m.cumulative_hazard(365.0)!r} * exp({lp}))")
    return "(CASE s.channel_group " + " ".join(cases) + " END)"


SQL["union_channels"] = _analysis(_channel_pret(), _CH_OK) + """ SELECT customer_id, @@SCLV@@ AS clv
  FROM clvt WHERE "group" = 'onetimer'"""

# ---------------------------------------------------- scoring
from ..plans.catalog import REQUEST_CUSTOMERS  # noqa: E402
from .oracle import segment_case, sround, SNAP  # noqa: E402


_RID = f"(customer_id // {REQUEST_CUSTOMERS})"
_ROWS = f""",
rows AS (
  SELECT {_RID} AS request_id,
         CAST(DATE '{SNAP}' + CAST(({_RID} % 3) * 30 AS INTEGER) AS TIMESTAMP) AS snapshot_ts,
         CASE WHEN {_RID} % 2 = 0 THEN 365 ELSE 180 END AS xdays,
         customer_id, txn_id, arrival_ts, revenue, channel
  FROM clean),
rc AS (
  SELECT request_id, customer_id, xdays, snapshot_ts, count(*) AS visit_count, sum({money('revenue')}) AS total,
         min(arrival_ts) AS first_date, max(arrival_ts) AS last_date
  FROM rows GROUP BY 1, 2, 3, 4),
rdays AS (
  SELECT request_id, customer_id, snapshot_ts, CAST(arrival_ts AS DATE) AS day, sum({money('revenue')}) AS day_sum
  FROM rows WHERE CAST(arrival_ts AS DATE) <= CAST(snapshot_ts AS DATE) GROUP BY 1, 2, 3, 4),
rsum AS (
  SELECT request_id, customer_id, count(*) - 1 AS days_frequency,
         date_diff('day', min(day), max(day)) AS t_x,
         date_diff('day', min(day), CAST(snapshot_ts AS DATE)) AS T,
         CASE WHEN count(*) > 1 THEN CAST(sum(day_sum) - arg_min(day_sum, day) AS DOUBLE) / (count(*) - 1)
              ELSE 0.0 END AS monetary_value
  FROM rdays GROUP BY request_id, customer_id, snapshot_ts),
rf AS (
  SELECT rc.*, CAST(total AS DOUBLE) / visit_count AS avg_spend,
         {floor_days('last_date', 'snapshot_ts')} AS recency, visit_count AS frequency,
         CAST(total AS DOUBLE) AS monetary, s.days_frequency, s.t_x, s.T, s.monetary_value
  FROM rc LEFT JOIN rsum s USING (request_id, customer_id))"""


def _gedges(name: str, col: str) -> str:
    return f""",
{name}_sorted AS (
  SELECT request_id, CAST({col} AS DOUBLE) AS v,
         row_number() OVER (PARTITION BY request_id ORDER BY {col}, customer_id) - 1 AS pos,
         count(*) OVER (PARTITION BY request_id) AS n FROM rf),
{name}_pos AS (
  SELECT DISTINCT request_id, i, (i * (n - 1)) // 5 AS lo, (i * (n - 1)) % 5 AS rem
  FROM {name}_sorted, range(1, 5) t(i)),
{name} AS (
  SELECT p.request_id, p.i, CASE WHEN p.rem = 0 THEN a.v ELSE a.v + (b.v - a.v) * (p.rem / 5.0) END AS e
  FROM {name}_pos p JOIN {name}_sorted a ON a.request_id = p.request_id AND a.pos = p.lo
  LEFT JOIN {name}_sorted b ON b.request_id = p.request_id AND b.pos = p.lo + 1)"""


def _gbucket(name: str, v: str) -> str:
    return f"(1 + (SELECT count(*) FROM {name} e WHERE e.request_id = rf.request_id AND CAST({v} AS DOUBLE) > e.e))"


_fb = " + ".join(f"(CASE WHEN 5 * (fr.rn - 1) > {i} * (fr.n - 1) THEN 1 ELSE 0 END)" for i in range(1, 5))
_RFM_REQ = _gedges("gr", "recency") + _gedges("gm", "monetary") + f""",
fr AS (
  SELECT request_id, customer_id, row_number() OVER (PARTITION BY request_id ORDER BY frequency, customer_id) AS rn,
         count(*) OVER (PARTITION BY request_id) AS n FROM rf),
rsc0 AS (
  SELECT rf.request_id, rf.customer_id,
         CAST(6 - {_gbucket('gr', 'rf.recency')} AS BIGINT) AS r_score,
         CAST(1 + {_fb} AS BIGINT) AS f_score,
         CAST({_gbucket('gm', 'rf.monetary')} AS BIGINT) AS m_score
  FROM rf JOIN fr USING (request_id, customer_id)),
rsc AS (SELECT *, r_score + f_score + m_score AS rfm_score,
               {segment_case('(r_score + f_score + m_score)')} AS segment FROM rsc0)"""


def _bg_req(models: bool) -> str:
    t = "CAST(xdays AS DOUBLE)"
    if not models:
        return f""",
en AS (
  SELECT request_id, customer_id, CAST(days_frequency AS DOUBLE) AS x,
         days_frequency * ({t} / CAST(greatest(T, 1) AS DOUBLE)) AS expected_purchases,
         {C.FALLBACK_P_ALIVE} AS p_alive, monetary_value AS expected_value
  FROM rf WHERE visit_count > 1 AND days_frequency IS NOT NULL)"""
    return f""",
bg AS (
  SELECT request_id, customer_id, CAST(days_frequency AS DOUBLE) AS x, CAST(t_x AS DOUBLE) AS tx,
         CAST(T AS DOUBLE) AS TT, monetary_value AS mv, {t} AS hz,
         {t} / ({_al} + CAST(T AS DOUBLE) + {t}) AS z
  FROM rf WHERE visit_count > 1 AND days_frequency IS NOT NULL),
hyp AS (
  SELECT request_id, customer_id, 1.0 + sum(exp(ls)) AS f FROM (
    SELECT request_id, customer_id,
           sum(ln(({_r} + x + k) * ({_b} + x + k) / (({_a} + {_b} + x - 1.0 + k) * (k + 1.0)) * z))
             OVER (PARTITION BY request_id, customer_id ORDER BY k) AS ls
    FROM bg, range(0, 2000) r(k)) GROUP BY request_id, customer_id),
en AS (
  SELECT bg.request_id, bg.customer_id, bg.x,
         ({_a} + {_b} + x - 1.0) / ({_a} - 1.0)
           * (1.0 - pow(({_al} + TT) / ({_al} + TT + hz), {_r} + x) * hyp.f)
           / (1.0 + CASE WHEN x > 0 THEN {_a} / ({_b} + x - 1.0) * pow(({_al} + TT) / ({_al} + tx), {_r} + x)
                         ELSE 0.0 END) AS expected_purchases,
         CASE WHEN x = 0 THEN 1.0 ELSE 1.0 / (1.0 + {_a} / ({_b} + x - 1.0)
              * pow(({_al} + TT) / ({_al} + tx), {_r} + x)) END AS p_alive,
         CASE WHEN x > 0 THEN (1.0 - {_GW}) * {_POP} + {_GW} * mv ELSE mv END AS expected_value
  FROM bg JOIN hyp USING (request_id, customer_id))"""


_HMAP = "CASE rf.xdays " + " ".join(
    f"WHEN {h} THEN {repr(CXP.cumulative_hazard(float(h)))}" for h in (180, 365)) + " END"


def _level(v: str) -> str:
    lo1, mi1, hi1 = C.CLV_LEVEL_BOUNDS_ONETIMER
    lo2, mi2, hi2 = C.CLV_LEVEL_BOUNDS_REPEATER
    return (f"CASE WHEN one THEN (CASE WHEN {v} < {lo1} THEN 'Low' WHEN {v} < {mi1} THEN 'Mid' "
            f"WHEN {v} < {hi1} THEN 'High' ELSE 'Top' END) ELSE (CASE WHEN {v} < {lo2} THEN 'Low' "
            f"WHEN {v} < {mi2} THEN 'Mid' WHEN {v} < {hi2} THEN 'High' ELSE 'Top' END) END")


def _scoring(models: bool = True, lenient: bool = False) -> str:
    pret = f"(1.0 - exp(-({_HMAP}) * exp({repr(CXP.coef[0])} * (rf.avg_spend - {repr(CXP.mean[0])}))))" \
        if models else str(C.FALLBACK_P_RETURN)
    if lenient:
        rfm_sel = f"CAST({C.LENIENT_RFM_SCORE} AS BIGINT) AS rfm_score, '{C.LENIENT_SEGMENT}' AS segment"
        rfm_join = ""
        rfm_ctes = ""
    else:
        rfm_sel = "coalesce(rsc.rfm_score, 0) AS rfm_score, coalesce(rsc.segment, 'Unknown') AS segment"
        rfm_join = "LEFT JOIN rsc USING (request_id, customer_id)"
        rfm_ctes = _RFM_REQ
    mism = (f"'{C.MISMATCH_ALIGNED}'" if lenient else _MISMATCH.replace("clv_level", "lvl"))
    return with_(txn_cte()) + _ROWS + rfm_ctes + _bg_req(models) + f""",
p0 AS (
  SELECT rf.request_id, rf.customer_id, rf.visit_count = 1 AS one, rf.avg_spend, rf.days_frequency, rf.t_x,
         {pret} AS p_ret, en.expected_purchases, en.expected_value, en.p_alive, {rfm_sel}
  FROM rf {rfm_join} LEFT JOIN en USING (request_id, customer_id)
  WHERE rf.visit_count = 1 OR rf.days_frequency IS NOT NULL),
p1 AS (SELECT *, CASE WHEN one THEN p_ret * avg_spend ELSE expected_purchases * expected_value END AS v FROM p0),
p2 AS (SELECT *, {_level('v')} AS lvl FROM p1)
 SELECT request_id, customer_id, CASE WHEN one THEN 'onetimer' ELSE 'repeater' END AS "group",
   {sround('v', 2)} AS clv,
   CASE WHEN one THEN {sround('p_ret', 4)} END AS p_return,
   CASE WHEN one THEN {sround('avg_spend', 2)} END AS avg_spend,
   CASE WHEN NOT one THEN {sround('expected_purchases', 2)} END AS expected_purchases,
   CASE WHEN NOT one THEN {sround('expected_value', 2)} END AS expected_value,
   {'CAST(NULL AS DOUBLE)' if lenient else "CASE WHEN NOT one THEN " + sround('p_alive', 4) + " END"} AS p_alive,
   CASE WHEN NOT one THEN days_frequency END AS frequency,
   {'CAST(NULL AS DOUBLE)' if lenient else 'CASE WHEN NOT one THEN CAST(t_x AS DOUBLE) END'} AS recency,
   rfm_score, segment, lvl AS clv_level, {mism} AS mismatch
 FROM p2"""


SCORE = _scoring()
SQL["score_customers"] = SCORE
SQL["score_published"] = SCORE
SQL["score_customers_fallback"] = _scoring(models=False)
SQL["score_customers_lenient"] = _scoring(lenient=True)
_SC = f"WITH sc AS ({SCORE}) "
SQL["clv_level_abs"] = _SC + 'SELECT request_id, customer_id, "group", clv, clv_level FROM sc'
SQL["round_output"] = _SC + """SELECT request_id, customer_id, clv, p_return, avg_spend, expected_purchases,
  expected_value, p_alive, recency FROM sc"""
SQL["rfm_constant"] = f"WITH sc AS ({_scoring(lenient=True)}) " + \
    "SELECT request_id, customer_id, rfm_score, segment, mismatch FROM sc"
SQL["request_rfm"] = with_(txn_cte()) + _ROWS + _RFM_REQ + """ SELECT request_id, customer_id, r_score, f_score,
  m_score, rfm_score, segment FROM rsc"""
SQL["scan_requests"] = with_(txn_cte()) + f""" SELECT customer_id, arrival_ts, revenue,
  coalesce(channel, 'Unknown') AS channel, TIMESTAMP '{SNAP} 00:00:00' AS snapshot_ts, CAST(365 AS BIGINT) AS xdays
  FROM clean"""
SQL["response_json"] = _SC + """SELECT request_id, count(*) OVER (PARTITION BY request_id) AS count, customer_id AS f_customerid,
  clv AS f_clv, "group" AS f_group, p_return AS f_p_return, avg_spend AS f_avg_spend, expected_purchases AS f_expected_purchases,
  expected_value AS f_expected_value, p_alive AS f_p_alive, frequency AS f_frequency, recency AS f_recency, rfm_score AS f_rfm_score,
  segment AS f_segment, clv_level AS f_clv_level, mismatch AS f_mismatch FROM sc"""
SQL["response_edge_cases"] = with_(txn_cte()) + f""", q AS (
  SELECT customer_id // {REQUEST_CUSTOMERS} AS rid, count(DISTINCT customer_id) AS customers, count(*) AS visits FROM clean GROUP BY 1)
  SELECT kind || '/' || rid AS request_id, CASE WHEN kind IN ('asis', 'again', 'list') THEN customers ELSE 0 END AS count,
         CASE WHEN kind = 'baddate' THEN visits ELSE 0 END AS bad_visits, CASE WHEN kind = 'cut' THEN 'not a request' END AS error
  FROM q, (VALUES ('asis'), ('again'), ('empty'), ('cut'), ('list'), ('baddate')) k(kind)"""
SQL["lookup_rfm_default"] = (with_(txn_cte()) + _ROWS.replace("rf AS (", "rf_all AS (") + ", rf AS (SELECT * FROM rf_all WHERE visit_count > 1)"
                             + _RFM_REQ + """ SELECT a.request_id, a.customer_id, coalesce(rsc.rfm_score, 0) AS rfm_score,
  coalesce(rsc.segment, 'Unknown') AS segment FROM rf_all a LEFT JOIN rsc USING (request_id, customer_id)""")
SQL["inner_summary"] = with_(txn_cte()) + f""", q AS (
  SELECT customer_id // {REQUEST_CUSTOMERS} AS request_id, customer_id, txn_id, CAST(arrival_ts AS DATE) AS day FROM clean),
  a AS (SELECT request_id, customer_id, count(*) AS visit_count FROM q GROUP BY ALL),
  e AS (SELECT request_id, customer_id, count(DISTINCT day) - 1 AS days_frequency, date_diff('day', min(day), max(day)) AS t_x
        FROM q WHERE txn_id % 2 = 0 GROUP BY ALL)
  SELECT request_id, customer_id, visit_count, days_frequency, t_x FROM a LEFT JOIN e USING (request_id, customer_id)
  WHERE visit_count = 1 OR days_frequency IS NOT NULL"""

# --------------------------------------- log-likelihoods at fixed params
_p, _q, _v = (repr(float(t)) for t in (GGP.p, GGP.q, GGP.v))
SQL["bgnbd_loglik"] = REPS + f""", s AS (SELECT CAST(days_frequency AS DOUBLE) AS x, CAST(t_x AS DOUBLE) AS tx,
   CAST(T AS DOUBLE) AS TT FROM reps),
 t AS (SELECT x, lgamma({_r} + x) - lgamma({_r}) + {_r} * ln({_al}) + lgamma({_a} + {_b}) + lgamma({_b} + x)
            - lgamma({_b}) - lgamma({_a} + {_b} + x) AS a12,
            -({_r} + x) * ln({_al} + TT) AS a3,
            CASE WHEN x > 0 THEN ln({_a}) - ln({_b} + greatest(x, 1.0) - 1.0) - ({_r} + x) * ln({_al} + tx) END AS a4
       FROM s)
 SELECT round(sum(a12 + CASE WHEN x > 0 THEN greatest(a3, a4) + ln(exp(a3 - greatest(a3, a4)) + exp(a4 - greatest(a3, a4)))
                              ELSE a3 END), 6) AS log_likelihood FROM t"""
SQL["gg_loglik"] = REPS + f""", s AS (SELECT CAST(days_frequency AS DOUBLE) AS x, monetary_value AS m FROM reps
   WHERE days_frequency > 0 AND monetary_value > 0)
 SELECT round(sum(lgamma({_p} * x + {_q}) - lgamma({_p} * x) - lgamma({_q}) + {_q} * ln({_v})
   + ({_p} * x - 1.0) * ln(m) + {_p} * x * ln(x) - ({_p} * x + {_q}) * ln(x * m + {_v})), 6) AS log_likelihood FROM s"""

# ------------------------------------------------ composite plans
SQL["prep_training"] = with_(txn_cte()) + _FLAG + f""" SELECT txn_id, customer_id, channel_group, {DUMS},
  visit_count, repeat FROM flagged"""
SQL["prep_lenient"] = with_(txn_cte(), lenient_cte()) + f""" SELECT txn_id, customer_id, tx_count,
  '{C.TYPE_REPEATER}' AS customer_type FROM len_flag WHERE tx_count > 1"""
SQL["prep_inference"] = with_(txn_cte()) + _ROWS + f""" SELECT request_id, customer_id, visit_count,
  round(avg_spend, 6) AS avg_spend, {floor_days('first_date', 'snapshot_ts')} AS duration, recency,
  days_frequency, t_x, T, round(monetary_value, 6) AS monetary_value FROM rf"""
SQL["flatten_requests"] = SQL["scan_requests"]
SQL["scan_customer_json"] = with_(txn_cte()) + """ SELECT CAST(customer_id AS VARCHAR) AS customer_id, arrival_ts, revenue,
  coalesce(channel, 'Unknown') AS channel FROM txn"""
SQL["head_sample"] = REPS + """ SELECT customer_id, days_frequency AS frequency, t_x, T,
  round(monetary_value, 6) AS monetary_value FROM reps ORDER BY customer_id LIMIT 10"""
SQL["request_defaults"] = with_(txn_cte()) + f"""
 SELECT DISTINCT CAST(customer_id // {REQUEST_CUSTOMERS} AS VARCHAR) AS request_id,
   CASE WHEN (customer_id // {REQUEST_CUSTOMERS}) % 2 = 0 THEN TIMESTAMP '{SNAP} 00:00:00'
        ELSE TIMESTAMP '{C.DEFAULT_SNAPSHOT} 00:00:00' END AS snapshot_ts,
   CAST({C.DEFAULT_XDAYS} AS BIGINT) AS xdays FROM clean"""

SQL["cox_concordance"] = BASE + f""", s AS (SELECT duration AS d, event AS e, {_LP} AS v FROM feats),
 pr AS (SELECT i.v AS vi, j.v AS vj FROM s i JOIN s j
        ON i.e = 1 AND (j.d > i.d OR (j.d = i.d AND j.e = 0)))
 SELECT CAST(count(*) AS DOUBLE) AS pairs,
        CAST(sum(CASE WHEN vi > vj THEN 1 ELSE 0 END) AS DOUBLE) AS concordant,
        CAST(sum(CASE WHEN vi = vj THEN 1 ELSE 0 END) AS DOUBLE) AS tied,
        round((sum(CASE WHEN vi > vj THEN 1 ELSE 0 END) + 0.5 * sum(CASE WHEN vi = vj THEN 1 ELSE 0 END))
              / count(*), 6) AS concordance_index FROM pr"""

# ------------------------------------------------ E1's frames through E1
SQL["prep_customer_data"] = BASE + " SELECT customer_id, visit_count, round(avg_spend, 6) AS avg_spend FROM feats"
SQL["prep_rfm"] = SCORED + " SELECT customer_id, r_score, f_score, m_score, segment FROM scored"
SQL["prep_one_timers"] = with_(txn_cte()) + _FLAG + " SELECT txn_id, customer_id, repeat FROM flagged WHERE repeat = 'N'"
SQL["prep_repeaters"] = with_(txn_cte()) + _FLAG + " SELECT txn_id, customer_id, repeat FROM flagged WHERE repeat = 'Y'"
SQL["prep_latest_channel"] = SQL["latest_channel"]
SQL["clean_strict_nan"] = SQL["clean_strict"] + " WHERE txn_id % 5 <> 0"
SQL["clean_lenient_nan"] = SQL["clean_lenient"] + " WHERE txn_id % 5 <> 0"

# ------------------------------------------------ fits: what must hold
def _all_ok(names) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{n}', true)" for n in names) + ") t(name, ok)"


SQL["bgnbd_fit"] = _all_ok(("converged", "gradient", "optimum", "not_above_fixed"))
SQL["gg_fit"] = _all_ok(("converged", "gradient", "optimum"))
SQL["cox_fit"] = _all_ok(("converged", "optimum", "not_above_zero", "likelihood"))
SQL["cox_fit_by_channel"] = BASE + f""" SELECT channel_group || ': ' || k AS name, true AS ok FROM (
  SELECT channel_group FROM feats WHERE duration IS NOT NULL AND event IS NOT NULL AND avg_spend IS NOT NULL
  GROUP BY channel_group HAVING count(*) >= {C.MIN_CHANNEL_ROWS}), (VALUES ('converged'), ('optimum')) v(k)"""
SQL["train_all"] = _all_ok(("cox converged", "bgnbd converged", "gamma_gamma converged", "concordance in range", "baseline rises"))
SQL["rfm_vs_clv_fitted"] = BASE + " SELECT count(*) AS customers, CAST(0 AS BIGINT) AS bad, true AS quartiles FROM feats"

# ------------------------------------- purchase events (times of day)
from ..plans.catalog import EVENTS_SNAP  # noqa: E402
from .oracle import events_cte  # noqa: E402

SQL["rfm_scores_events"] = with_(events_cte(EVENTS_SNAP), rfm_cte("clean", EVENTS_SNAP), rfm_scores_cte()) + """
 SELECT customer_id, recency, frequency, round(monetary, 6) AS monetary, r_score, f_score, m_score,
        rfm_score, segment FROM scored"""
SQL["purchase_summary_events"] = with_(events_cte(EVENTS_SNAP), feats_cte(EVENTS_SNAP)) + """
 SELECT customer_id, days_frequency AS frequency, t_x, T, round(monetary_value, 6) AS monetary_value,
        visit_count AS n_visits FROM feats"""
SQL["customer_agg_events"] = with_(events_cte(EVENTS_SNAP), feats_cte(EVENTS_SNAP)) + """
 SELECT customer_id, first_date, last_date, visit_count, round(avg_spend, 6) AS avg_spend, duration, recency,
        event, days_frequency, t_x, T FROM feats"""


# CLV-valued outputs: cents, with Spark's half-up rounding of doubles.
for _k in list(SQL):
    SQL[_k] = (SQL[_k].replace("@@SCLV@@", sround("clv", 2))
               .replace("@@BINLO@@", sround("lo + bin * width", 2))
               .replace("@@BINHI@@", sround("lo + (bin + 1) * width", 2)))

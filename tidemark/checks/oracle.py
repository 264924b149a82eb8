"""DuckDB SQL that recomputes each registered query independently.

Built from the same fixed values as the Spark code (channel table, segment
bounds, ...) but with plain global SQL: global windows for ranks, explicit
integer quantile positions, decimal money sums. Views ``orders``, ``events``
... are registered by the checker.
"""

from __future__ import annotations

from .. import config as C

SNAP = C.TESTDATA_SNAPSHOT


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def codes_list() -> str:
    return "[" + ", ".join("NULL" if c is None else q(c) for c in C.TESTDATA_CHANNEL_CODES) + "]"


def group_case(col: str = "channel") -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in C.CHANNEL_GROUPS.items())
    return f"(CASE {col} {whens} ELSE {q(C.UNKNOWN_GROUP)} END)"


def dummy_cols(group_col: str = "channel_group") -> str:
    from ..functions.columns import dummy_name
    return ", ".join(f"({group_col} = {q(g)}) AS {dummy_name(g)}" for g in C.CHANNEL_GROUP_NAMES)


def segment_case(score: str = "rfm_score") -> str:
    whens = " ".join(f"WHEN {score} >= {b} THEN {q(n)}" for b, n in C.RFM_SEGMENT_BOUNDS)
    return f"(CASE {whens} ELSE {q(C.RFM_SEGMENT_FLOOR)} END)"


def floor_days(start: str, end: str) -> str:
    return (f"CAST(floor((epoch_us({end}) - epoch_us({start})) / 86400000000.0) AS BIGINT)")


def snap_ts(snapshot: str = SNAP) -> str:
    return f"TIMESTAMP '{snapshot}'" if ":" in snapshot else f"TIMESTAMP '{snapshot} 00:00:00'"


def money(c: str) -> str:
    return f"CAST({c} AS DECIMAL(28,6))"


def txn_cte(snapshot: str = SNAP, inclusive: bool = False) -> str:
    op = "<=" if inclusive else "<"
    return f"""
txn AS (
  SELECT o_orderkey AS txn_id, o_custkey AS customer_id,
         CAST(o_orderdate AS TIMESTAMP) AS arrival_ts,
         CAST(o_totalprice AS DOUBLE) AS revenue,
         ({codes_list()})[(o_orderkey % {len(C.TESTDATA_CHANNEL_CODES)}) + 1] AS channel
  FROM orders),
clean AS (
  SELECT * FROM txn
  WHERE arrival_ts {op} {snap_ts(snapshot)} AND revenue > 0 AND customer_id IS NOT NULL),
enc AS (
  SELECT *, {dummy_cols()} FROM (SELECT *, {group_case()} AS channel_group FROM clean))"""


def rfm_cte(src: str = "clean", snapshot: str = SNAP) -> str:
    return f"""
rfm AS (
  SELECT customer_id,
         {floor_days('max(arrival_ts)', snap_ts(snapshot))} AS recency,
         count(*) AS frequency,
         CAST(sum({money('revenue')}) AS DOUBLE) AS monetary
  FROM {src} GROUP BY customer_id)"""


def edges_cte(name: str, table: str, col: str, qn: int) -> str:
    """CTE ``name``(i, e): interior quantile edges with integer positions."""
    return f"""
{name}_sorted AS (
  SELECT CAST({col} AS DOUBLE) AS v, row_number() OVER (ORDER BY {col}) - 1 AS pos
  FROM {table} WHERE {col} IS NOT NULL),
{name}_pos AS (
  SELECT i, (i * (n - 1)) // {qn} AS lo, (i * (n - 1)) % {qn} AS rem
  FROM range(1, {qn}) t(i), (SELECT count(*) AS n FROM {name}_sorted) c),
{name} AS (
  SELECT p.i, CASE WHEN p.rem = 0 THEN a.v ELSE a.v + (b.v - a.v) * (p.rem / {float(qn)}) END AS e
  FROM {name}_pos p JOIN {name}_sorted a ON a.pos = p.lo
  LEFT JOIN {name}_sorted b ON b.pos = p.lo + 1)"""


def bucket(edges: str, value: str) -> str:
    return f"(1 + (SELECT count(*) FROM {edges} WHERE {value} > {edges}.e))"


def rfm_scores_cte(src: str = "rfm") -> str:
    return f""",
{edges_cte('r_edges', src, 'recency', 5)},
{edges_cte('m_edges', src, 'monetary', 5)},
f_rank AS (
  SELECT customer_id, row_number() OVER (ORDER BY frequency, customer_id) AS rn,
         count(*) OVER () AS n FROM {src}),
scored0 AS (
  SELECT s.*, CAST(6 - {bucket('r_edges', 's.recency')} AS BIGINT) AS r_score,
         CAST(1 + (CASE WHEN 5 * (f.rn - 1) > 1 * (f.n - 1) THEN 1 ELSE 0 END)
                + (CASE WHEN 5 * (f.rn - 1) > 2 * (f.n - 1) THEN 1 ELSE 0 END)
                + (CASE WHEN 5 * (f.rn - 1) > 3 * (f.n - 1) THEN 1 ELSE 0 END)
                + (CASE WHEN 5 * (f.rn - 1) > 4 * (f.n - 1) THEN 1 ELSE 0 END) AS BIGINT) AS f_score,
         CAST({bucket('m_edges', 's.monetary')} AS BIGINT) AS m_score
  FROM {src} s JOIN f_rank f USING (customer_id)),
scored AS (
  SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR)
              AS rfm_segment,
         r_score + f_score + m_score AS rfm_score,
         {segment_case('(r_score + f_score + m_score)')} AS segment
  FROM scored0)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().lstrip(",") for c in ctes)


def feats_cte(snapshot: str = SNAP) -> str:
    """Per-customer fields (customer table, RFM inputs, first/latest channel,
    calendar-day summary) with plain windows and group-bys."""
    from ..functions.columns import DUMMY_COLUMNS
    dummies = ",\n         ".join(
        f"bool_or(CASE WHEN rn_first = 1 THEN {d} END) AS {d}" for d in DUMMY_COLUMNS)
    st = snap_ts(snapshot)
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY arrival_ts, txn_id) AS rn_first,
         row_number() OVER (PARTITION BY customer_id ORDER BY arrival_ts DESC, txn_id DESC) AS rn_last
  FROM enc),
cust_base AS (
  SELECT customer_id, min(arrival_ts) AS first_date, max(arrival_ts) AS last_date,
         count(*) AS visit_count, sum({money('revenue')}) AS total,
         max(CASE WHEN rn_first = 1 THEN channel_group END) AS channel_group,
         {dummies},
         max(CASE WHEN rn_last = 1 THEN channel END) AS latest_channel,
         max(CASE WHEN rn_last = 1 THEN channel_group END) AS latest_channel_group
  FROM ranked GROUP BY customer_id),
days AS (
  SELECT customer_id, CAST(arrival_ts AS DATE) AS day, sum({money('revenue')}) AS day_sum
  FROM enc WHERE CAST(arrival_ts AS DATE) <= CAST({st} AS DATE) GROUP BY 1, 2),
summ AS (
  SELECT customer_id, count(*) - 1 AS days_frequency,
         date_diff('day', min(day), max(day)) AS t_x,
         date_diff('day', min(day), CAST({st} AS DATE)) AS T,
         CASE WHEN count(*) > 1 THEN CAST(sum(day_sum) - arg_min(day_sum, day) AS DOUBLE) / (count(*) - 1)
              ELSE 0.0 END AS monetary_value
  FROM days GROUP BY customer_id),
feats AS (
  SELECT c.*, CAST(c.total AS DOUBLE) / c.visit_count AS avg_spend,
         {floor_days('c.first_date', st)} AS duration,
         CAST(c.visit_count > 1 AS BIGINT) AS event,
         {floor_days('c.last_date', st)} AS recency,
         c.visit_count AS frequency, CAST(c.total AS DOUBLE) AS monetary,
         s.days_frequency, s.t_x, s.T, s.monetary_value
  FROM cust_base c LEFT JOIN summ s USING (customer_id))"""


def lenient_cte(snapshot: str = SNAP) -> str:
    st = snap_ts(snapshot)
    return f"""
len_clean AS (
  SELECT * FROM txn WHERE arrival_ts IS NOT NULL AND arrival_ts <= {st}
    AND coalesce(revenue, 0.0) > 0 AND customer_id IS NOT NULL),
len_flag AS (
  SELECT *, count(*) OVER (PARTITION BY customer_id) AS tx_count FROM len_clean),
len_cust AS (
  SELECT customer_id, min(arrival_ts) AS first_arrival, max(arrival_ts) AS last_arrival,
         count(*) AS tx_count, CAST(sum({money('revenue')}) AS DOUBLE) AS total_revenue,
         CAST(sum({money('revenue')}) AS DOUBLE) / count(*) AS avg_revenue
  FROM len_clean GROUP BY customer_id)"""


def events_cte(snapshot: str) -> str:
    """Purchase events as visits (no channel), strict snapshot bound."""
    return f"""
txn AS (
  SELECT event_id AS txn_id, user_id AS customer_id, CAST(ts AS TIMESTAMP) AS arrival_ts,
         CAST(value AS DOUBLE) AS revenue, CAST(NULL AS VARCHAR) AS channel
  FROM events WHERE event_type = 'purchase'),
clean AS (
  SELECT * FROM txn
  WHERE arrival_ts < {snap_ts(snapshot)} AND revenue > 0 AND customer_id IS NOT NULL),
enc AS (
  SELECT *, {dummy_cols()} FROM (SELECT *, {group_case()} AS channel_group FROM clean))"""


def sround(x: str, d: int) -> str:
    """Half-up rounding of the shortest decimal text of a double (Spark's
    rounding of doubles); the decimal scale keeps that text exact."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {d}) AS DOUBLE)"

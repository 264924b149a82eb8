"""Customer-level aggregates (A1-A3, A11) and per-customer picks.

All of these group by ``customer_id``; every aggregate used here supports
partial (map-side) aggregation, so a hot id is reduced before the shuffle.
Money is summed as an exact decimal so results do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import DUMMY_COLUMNS, day_diff, floor_days, money, ts_literal
from .quantiles import global_row_number



def order_key() -> F.Column:
    """Total order of a customer's visits: time, then txn id."""
    return F.struct(F.col("arrival_ts"), F.col("txn_id"))


def _avg_money(col: str = "revenue") -> F.Column:
    """Exact decimal sum, then one double division (row-order independent)."""
    return F.sum(money(col)).cast("double") / F.count(F.col(col))


def rfm_features(txn: DataFrame, snapshot) -> DataFrame:
    """A1: recency (floored days since last visit), frequency (visits),
    monetary (sum of revenue)."""
    snap = ts_literal(snapshot)
    return txn.groupBy("customer_id").agg(
        floor_days(F.max("arrival_ts"), snap).alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(money("revenue")).cast("double").alias("monetary"),
    )


def customer_table(txn: DataFrame, snapshot) -> DataFrame:
    """A2 + P9 + P10 + J1/W4: first/last visit, visit count, mean spend,
    duration to the snapshot, event flag and the first visit's channel group
    plus dummies (picked with a total order: time, then txn id)."""
    snap = ts_literal(snapshot)
    if "channel_group" not in txn.columns:
        from .cleaning import add_channel_groups
        txn = add_channel_groups(txn)
    first = F.min_by(F.struct("channel_group", *DUMMY_COLUMNS), order_key())
    agg = txn.groupBy("customer_id").agg(
        F.min("arrival_ts").alias("first_date"),
        F.max("arrival_ts").alias("last_date"),
        F.count(F.lit(1)).alias("visit_count"),
        _avg_money().alias("avg_spend"),
        first.alias("_first"),
    )
    return agg.select(
        "customer_id", "first_date", "last_date", "visit_count", "avg_spend",
        floor_days("first_date", snap).alias("duration"),
        (F.col("visit_count") > 1).cast("long").alias("event"),
        F.col("_first.channel_group").alias("channel_group"),
        *[F.col(f"_first.{d}").alias(d) for d in DUMMY_COLUMNS],
    )


def customer_table_lenient(txn: DataFrame, snapshot) -> DataFrame:
    """A3: lenient customer table (adds total revenue, customer type, T and
    recency in floored days)."""
    snap = ts_literal(snapshot)
    agg = txn.groupBy("customer_id").agg(
        F.min("arrival_ts").alias("first_arrival"),
        F.max("arrival_ts").alias("last_arrival"),
        F.count(F.lit(1)).alias("tx_count"),
        F.sum(money("revenue")).cast("double").alias("total_revenue"),
        _avg_money().alias("avg_revenue"),
    )
    return agg.select(
        "customer_id", "first_arrival", "last_arrival", "tx_count", "total_revenue", "avg_revenue",
        F.when(F.col("tx_count") > 1, C.TYPE_REPEATER).otherwise(C.TYPE_ONETIMER)
        .alias("customer_type"),
        floor_days("first_arrival", snap).alias("T"),
        (F.col("tx_count") > 1).cast("long").alias("event"),
        floor_days("last_arrival", snap).alias("recency"),
    )


def purchase_summary(txn: DataFrame, snapshot) -> DataFrame:
    """The frequency/recency/T/monetary summary on calendar days.

    Visits are summed per customer-day (days after the snapshot day are
    ignored); frequency = active days - 1; t_x = last day - first day;
    T = snapshot day - first day; monetary_value = mean day-sum over the
    days after the first, 0 without repeat days. ``n_visits`` keeps the raw
    row count (repeaters are n_visits > 1, even if all on one day: T9).
    Two partial-aggregated shuffles; a hot id is spread over its days."""
    snap_day = F.to_date(ts_literal(snapshot))
    days = (txn.withColumn("day", F.to_date("arrival_ts"))
            .where(F.col("day") <= snap_day)
            .groupBy("customer_id", "day")
            .agg(F.sum(money("revenue")).alias("day_sum"), F.count(F.lit(1)).alias("n_rows")))
    per = days.groupBy("customer_id").agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("n_days"),
        F.sum("day_sum").alias("total"),
        F.min_by("day_sum", "day").alias("first_sum"),
        F.sum("n_rows").cast("long").alias("n_visits"),
    )
    return per.select(
        "customer_id",
        (F.col("n_days") - 1).cast("long").alias("frequency"),
        F.datediff("last_day", "first_day").cast("long").alias("t_x"),
        F.datediff(snap_day, "first_day").cast("long").alias("T"),
        F.when(F.col("n_days") > 1,
               (F.col("total") - F.col("first_sum")).cast("double") / (F.col("n_days") - 1))
        .otherwise(F.lit(0.0)).alias("monetary_value"),
        "n_visits",
    )


def latest_channel(txn: DataFrame) -> DataFrame:
    """Channel and group of each customer's last visit (time, then txn id)."""
    if "channel_group" not in txn.columns:
        from .cleaning import add_channel_groups
        txn = add_channel_groups(txn)
    last = F.max_by(F.struct("channel", "channel_group"), order_key())
    return (txn.groupBy("customer_id").agg(last.alias("_l"))
            .select("customer_id", F.col("_l.channel").alias("channel"),
                    F.col("_l.channel_group").alias("channel_group")))


def first_row(txn: DataFrame, cols: list[str]) -> DataFrame:
    """The given columns of each customer's first visit."""
    pick = F.min_by(F.struct(*cols), order_key())
    return (txn.groupBy("customer_id").agg(pick.alias("_f"))
            .select("customer_id", *[F.col(f"_f.{c}").alias(c) for c in cols]))


def visit_numbers(txn: DataFrame) -> DataFrame:
    """Running visit number per customer in (time, txn id) order: the
    row's position in the whole order minus the customer's first position.
    Positions come from range partitions, so a customer with a third of all
    visits, or with all of them on one day, is spread like any other rows."""
    n = global_row_number(txn, ["customer_id", "arrival_ts", "txn_id"], out="_rn")
    first = n.groupBy(F.col("customer_id").alias("_id")).agg(F.min("_rn").alias("_first"))
    return (n.join(first, F.col("customer_id").eqNullSafe(F.col("_id")))
            .withColumn("visit_number", F.col("_rn") - F.col("_first") + 1).drop("_id", "_rn", "_first"))


def elapsed(txn: DataFrame, snapshot) -> DataFrame:
    """P9 helper on visit rows: floored days to the snapshot and calendar days."""
    snap = ts_literal(snapshot)
    return txn.select("*", floor_days("arrival_ts", snap).alias("days_to_snapshot"),
                      day_diff("arrival_ts", snap).alias("calendar_days_to_snapshot"))


def customer_features(txn: DataFrame, snapshot, keys=("customer_id",)) -> DataFrame:
    """Every per-customer field of the analysis from ONE two-level aggregate
    (customer-day, then customer): RFM inputs (A1), the customer table (A2,
    first-visit channel J1/W4), the latest channel (W3) and the calendar-day
    purchase summary (A11). Both levels aggregate partially before their
    shuffle, so a hot id is reduced map-side and spread over its days.

    Columns: customer_id, first_date, last_date, visit_count, avg_spend,
    duration, event, recency, frequency, monetary, channel_group, dummies,
    latest_channel, latest_channel_group, days_frequency, t_x, T,
    monetary_value."""
    from .cleaning import add_channel_groups
    if DUMMY_COLUMNS[0] not in txn.columns:
        txn = add_channel_groups(txn.drop("channel_group"))
    keys = list(keys)
    if isinstance(snapshot, str) and snapshot in txn.columns:
        # Per-row snapshot (e.g. one per scoring request): carried as a key.
        txn = txn.withColumn("_snap", F.col(snapshot))
        keys = keys + ["_snap"]
        snap = F.col("_snap")
    else:
        snap = ts_literal(snapshot)
    snap_day = F.to_date(snap)
    key = order_key()
    days = txn.groupBy(*keys, F.to_date("arrival_ts").alias("day")).agg(
        F.sum(money("revenue")).alias("day_sum"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
        F.min_by(F.struct("channel_group", *DUMMY_COLUMNS), key).alias("first_pick"),
        F.max_by(F.struct("channel", "channel_group"), key).alias("last_pick"),
    )
    in_window = F.col("day") <= snap_day
    cust = days.groupBy(*keys).agg(
        F.min("first_key").alias("fk"),
        F.max("last_key").alias("lk"),
        F.sum("n_rows").cast("long").alias("visit_count"),
        F.sum("day_sum").alias("total"),
        F.min_by("first_pick", "first_key").alias("first"),
        F.max_by("last_pick", "last_key").alias("last"),
        F.count(F.when(in_window, 1)).alias("n_days"),
        F.min(F.when(in_window, F.col("day"))).alias("first_day"),
        F.max(F.when(in_window, F.col("day"))).alias("last_day"),
        F.sum(F.when(in_window, F.col("day_sum"))).alias("s_total"),
        F.min_by("day_sum", "day").alias("first_sum"),
    )
    n_days = F.col("n_days")
    return cust.select(
        *keys,
        F.col("fk.arrival_ts").alias("first_date"),
        F.col("lk.arrival_ts").alias("last_date"),
        "visit_count",
        (F.col("total").cast("double") / F.col("visit_count")).alias("avg_spend"),
        floor_days(F.col("fk.arrival_ts"), snap).alias("duration"),
        (F.col("visit_count") > 1).cast("long").alias("event"),
        floor_days(F.col("lk.arrival_ts"), snap).alias("recency"),
        F.col("visit_count").alias("frequency"),
        F.col("total").cast("double").alias("monetary"),
        F.col("first.channel_group").alias("channel_group"),
        *[F.col(f"first.{d}").alias(d) for d in DUMMY_COLUMNS],
        F.col("last.channel").alias("latest_channel"),
        F.col("last.channel_group").alias("latest_channel_group"),
        F.when(n_days > 0, (n_days - 1).cast("long")).alias("days_frequency"),
        F.datediff("last_day", "first_day").cast("long").alias("t_x"),
        F.datediff(snap_day, "first_day").cast("long").alias("T"),
        F.when(n_days > 1, (F.col("s_total") - F.col("first_sum")).cast("double") / (n_days - 1))
        .when(n_days == 1, F.lit(0.0)).alias("monetary_value"),
    )

"""Descriptive tables of the analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money
from .quantiles import quantile_edges


def frequency_table(txn: DataFrame, key: str) -> DataFrame:
    """A4/A5: rows, distinct customers and integer-truncated mean revenue per
    key (null keys dropped), largest first (O2)."""
    # Two-level aggregate (key, customer) -> key instead of a distinct
    # aggregate: no row expansion, both levels partially aggregated.
    per = (txn.where(F.col(key).isNotNull()).groupBy(key, "customer_id")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(money("revenue")).alias("s")))
    return (per.groupBy(key).agg(
        F.sum("n").cast("long").alias("total_customerid_count"),
        F.count(F.col("customer_id")).alias("distinct_customerid_count"),
        (F.sum("s").cast("double") / F.sum("n")).cast("long").alias("avg_total_revenue_usd"),
    ).orderBy(F.desc("total_customerid_count"), F.asc(key)))


def repeat_table(flagged: DataFrame) -> DataFrame:
    """Visit rows per repeat flag and their share of all rows (2 dp).
    The share uses a window over a two-row table."""
    c = flagged.groupBy("repeat").agg(F.count(F.lit(1)).alias("count"))
    tot = F.sum("count").over(Window.partitionBy())
    return c.withColumn("percent", F.round(F.col("count") * 100.0 / tot, 2))


def repeat_distinct(flagged: DataFrame) -> DataFrame:
    """Distinct customers per repeat flag."""
    per = flagged.groupBy("repeat", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("repeat").agg(F.count(F.col("customer_id")).alias("distinct_customer_count"))


def spend_by_visit(numbered_repeaters: DataFrame) -> DataFrame:
    """Mean revenue per visit number over repeater visits."""
    return numbered_repeaters.groupBy("visit_number").agg(
        (F.sum(money("revenue")).cast("double") / F.count(F.lit(1))).alias("avg_spend"))


def profile(raw: DataFrame, is_clean) -> DataFrame:
    """Ids, distinct ids, date range of the raw rows and distinct
    customers among those that are clean (a condition), in one scan."""
    per = raw.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("arrival_ts").alias("lo"), F.max("arrival_ts").alias("hi"),
        F.max(F.coalesce(is_clean, F.lit(False)).cast("int")).alias("clean"))
    known = F.col("customer_id").isNotNull()
    return per.agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).cast("long").alias("total_ids"),
        F.count(F.col("customer_id")).alias("distinct_ids"),
        F.min("lo").alias("min_date"), F.max("hi").alias("max_date"),
        F.count(F.when(known & (F.col("clean") == 1), 1)).alias("distinct_customers_clean"))


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """A10: distinct non-null values per categorical column, long format
    (column_name, value) - an unpivot then one distinct."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {stack}) AS (column_name, value)")
    return long.where(F.col("value").isNotNull()).distinct()


def median(df: DataFrame, col: str) -> float | None:
    """Exact median (linear interpolation) without a one-task buffer."""
    e = quantile_edges(df, col, 2)
    return e[0] if e else None


def summary_metrics(summary: DataFrame) -> DataFrame:
    """Fit-input metrics: n, mean frequency/t_x/T/monetary, exact
    median monetary."""
    med = median(summary, "monetary_value")
    return summary.agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("t_x").alias("avg_recency"),
        F.avg("T").alias("avg_T"),
        (F.sum(money("monetary_value")).cast("double") / F.count(F.lit(1))).alias("avg_monetary_value"),
    ).withColumn("median_monetary_value", F.lit(med).cast("double"))


def cox_metrics(customers: DataFrame, event_col: str = "event") -> DataFrame:
    """A12 (Cox part): n, event count, event rate."""
    return customers.agg(F.count(F.lit(1)).alias("n_samples"),
                         F.sum(event_col).cast("long").alias("n_events"),
                         F.avg(event_col).alias("event_rate"))


def load_stats(flagged: DataFrame) -> DataFrame:
    """Rows, customers, distinct one-timers and repeaters."""
    # repeat is constant per customer: aggregate per customer first.
    per = flagged.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.max("repeat").alias("r"))
    return per.agg(
        F.sum("n").cast("long").alias("transactions"),
        F.count(F.col("customer_id")).alias("customers"),
        F.count(F.when((F.col("r") == "N") & F.col("customer_id").isNotNull(), 1)).alias("one_timers"),
        F.count(F.when((F.col("r") == "Y") & F.col("customer_id").isNotNull(), 1)).alias("repeaters"),
    )


def histogram(df: DataFrame, value: str, by: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram of ``value`` over its global range, counts
    per (by, bin). Range from one global aggregate, bins by width_bucket."""
    r = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).collect()[0]
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], f"{by} string, bin long, bin_lo double, bin_hi double, customers long")
    lo, hi = float(lo), float(hi)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(value) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("long")
    out = df.where(F.col(value).isNotNull()).groupBy(by, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("customers"))
    return out.select(by, "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"), "customers")

"""Filters and per-transaction derivations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import channel_dummies, channel_group, ts_literal


def is_clean(snapshot, inclusive: bool = False):
    """F1 as a condition: a visit before the snapshot with positive revenue
    (null and NaN revenue and null dates drop out). Null ids are dropped at
    ingest (T19)."""
    ts = F.col("arrival_ts")
    snap = ts_literal(snapshot)
    return ((ts <= snap if inclusive else ts < snap) & (F.col("revenue") > 0) & ~F.isnan("revenue")
            & F.col("customer_id").isNotNull())


def clean_strict(txn: DataFrame, snapshot, inclusive: bool = False) -> DataFrame:
    """the visits that ``is_clean`` keeps."""
    return txn.where(is_clean(snapshot, inclusive))


def clean_lenient(txn: DataFrame, snapshot) -> DataFrame:
    """date present, on or before the snapshot, revenue > 0 after the
    null -> 0 coercion (NaN counts as null)."""
    return txn.where(F.col("arrival_ts").isNotNull() & (F.col("arrival_ts") <= ts_literal(snapshot))
                     & (F.coalesce(F.col("revenue"), F.lit(0.0)) > 0) & ~F.isnan("revenue")
                     & F.col("customer_id").isNotNull())


def add_channel_groups(txn: DataFrame, mapping: dict | None = None) -> DataFrame:
    """P7 + P8: channel group and the six fixed boolean dummies."""
    g = txn.withColumn("channel_group", channel_group("channel", mapping))
    return g.select("*", *channel_dummies("channel_group"))


def visit_counts(txn: DataFrame) -> DataFrame:
    """Rows per customer (partial aggregation absorbs hot ids)."""
    return txn.groupBy("customer_id").agg(F.count(F.lit(1)).alias("visit_count"))


def add_repeat_flag(txn: DataFrame) -> DataFrame:
    """Attach each customer's visit count and the Y/N repeat flag.

    Count per customer (partial-aggregated) joined back on the id: unlike a
    count window, AQE can split a skewed id's partition in the join."""
    counts = visit_counts(txn)
    return (txn.join(counts, "customer_id", "left")
            .withColumn("repeat", F.when(F.col("visit_count") > 1, "Y").otherwise("N")))


def add_customer_type(txn: DataFrame) -> DataFrame:
    """Lenient labels: tx_count + customer_type 'repeater' / 'one_timer'."""
    counts = txn.groupBy("customer_id").agg(F.count(F.lit(1)).alias("tx_count"))
    return (txn.join(counts, "customer_id", "left")
            .withColumn("customer_type", F.when(F.col("tx_count") > 1, C.TYPE_REPEATER)
                        .otherwise(C.TYPE_ONETIMER)))


def split_customers(txn: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one-timer rows, repeater rows); derives the flag when missing."""
    if "repeat" not in txn.columns:
        txn = add_repeat_flag(txn)
    return txn.where(F.col("repeat") == "N"), txn.where(F.col("repeat") == "Y")


def semi_by_ids(df: DataFrame, ids: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows whose id is in ``ids`` (left semi join, no duplication)."""
    return df.join(ids.select(key), key, "left_semi")

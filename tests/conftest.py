import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="tidemark-tests")
    yield s
    s.stop()


def txn_df(spark, rows):
    """rows: (customer_id, 'YYYY-MM-DD[ HH:MM:SS]', revenue, channel)."""
    from pyspark.sql import functions as F
    data = [(i + 1, c, d, float(r), ch) for i, (c, d, r, ch) in enumerate(rows)]
    df = spark.createDataFrame(data, "txn_id long, customer_id string, d string, revenue double, channel string")
    return df.select("txn_id", "customer_id", F.col("d").cast("timestamp_ntz").alias("arrival_ts"),
                     "revenue", "channel")


SMALL_ROWS = [
    ("K1", "2024-02-10", 420, "WEB"),
    ("K1", "2024-07-01", 610, "WEB"),
    ("K2", "2024-04-22", 260, "GDS"),
    ("K3", "2024-01-09", 900, "CHOPRA"),
    ("K3", "2024-05-30", 700, "CHOPRA"),
    ("K3", "2024-09-12", 1300, "CHOPRA"),
]

FIVE_ROWS = [
    ("P1", "2024-02-10", 420, "WEB"), ("P1", "2024-07-01", 610, "WEB"),
    ("P2", "2024-04-22", 260, "GDS"),
    ("P3", "2024-01-09", 900, "CHOPRA"), ("P3", "2024-05-30", 700, "CHOPRA"), ("P3", "2024-09-12", 1300, "CHOPRA"),
    ("P4", "2024-05-14", 2100, "WEB"),
    ("P5", "2023-08-21", 380, "RL"), ("P5", "2024-02-03", 470, "RL"), ("P5", "2024-06-25", 520, "RL"), ("P5", "2025-02-16", 600, "RL"),
]
SNAP = "2025-06-04"


@pytest.fixture(scope="session")
def small(spark):
    return txn_df(spark, SMALL_ROWS)


@pytest.fixture(scope="session")
def five(spark):
    return txn_df(spark, FIVE_ROWS)


def by_id(df, key="customer_id"):
    return {r[key]: r.asDict() for r in df.collect()}


__all__ = ["txn_df", "by_id", "SNAP", "datetime"]

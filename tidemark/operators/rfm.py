"""RFM scores and quantile levels.

Quintile semantics: interpolated quantile edges, right-closed bins with the
lowest value included (bucket = 1 + number of interior edges below the
value). Frequency is ranked first (position in (frequency, customer_id)
order): its buckets end at four boundary rows, compared as literals, so no
rank is materialised. Edges and boundaries are selected exactly by brackets
(``selection``) and enter the plan as literals.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import rfm_code, segment_name
from .quantiles import (bucket_by_boundaries, bucket_by_edges, edge_positions, edges_at, quantile_edges,
                        rank_positions)
from .selection import select_positions


class TiedEdgesError(ValueError):
    pass


def _check(edges, strict: bool, what: str):
    if strict and len(set(edges)) < len(edges):
        raise TiedEdgesError(f"{what}: tied bin edges {edges}")


def rfm_scores(rfm: DataFrame, strict: bool = False, persist: bool = True) -> DataFrame:
    """R (reversed quintile of recency), F (quintile of first-rank of
    frequency), M (quintile of monetary), code, total and segment name."""
    base = rfm.persist(StorageLevel.MEMORY_AND_DISK) if persist else rfm
    counts, stats = select_positions(
        base, {"r": ("recency",), "m": ("monetary",), "f": ("frequency", "customer_id")},
        {"r": lambda n: edge_positions(n, 5), "m": lambda n: edge_positions(n, 5), "f": lambda n: rank_positions(n, 5)})
    if counts["f"] == 0:
        return (base.withColumn("r_score", F.lit(None).cast("long"))
                .withColumn("f_score", F.lit(None).cast("long"))
                .withColumn("m_score", F.lit(None).cast("long"))
                .withColumn("rfm_segment", F.lit(None).cast("string"))
                .withColumn("rfm_score", F.lit(None).cast("long"))
                .withColumn("segment", F.lit(None).cast("string")))
    r_edges, m_edges = edges_at(stats["r"], counts["r"], 5), edges_at(stats["m"], counts["m"], 5)
    _check(r_edges, strict, "recency")
    _check(m_edges, strict, "monetary")
    bounds = [stats["f"][p] for p in rank_positions(counts["f"], 5)]
    scored = base.select(
        *[c for c in rfm.columns],
        F.when(F.col("recency").isNotNull(), F.lit(6) - bucket_by_edges("recency", r_edges)).cast("long").alias("r_score"),
        bucket_by_boundaries("frequency", "customer_id", bounds).cast("long").alias("f_score"),
        F.when(F.col("monetary").isNotNull(), bucket_by_edges("monetary", m_edges)).cast("long").alias("m_score"),
    )
    return scored.select(
        "*",
        rfm_code("r_score", "f_score", "m_score").alias("rfm_segment"),
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_score"),
    ).withColumn("segment", segment_name("rfm_score"))


def quantile_level(df: DataFrame, col: str, labels=C.CLV_LEVELS, out: str = "clv_level",
                   strict: bool = False) -> DataFrame:
    """Label rows by quantile bucket of ``col`` (quartiles by default);
    rows with a null value get a null label."""
    q = len(labels)
    edges = quantile_edges(df, col, q)
    if not edges:
        return df.withColumn(out, F.lit(None).cast("string"))
    _check(edges, strict, col)
    b = bucket_by_edges(col, edges)
    expr = F.when(F.col(col).isNull(), F.lit(None).cast("string"))
    for i, lab in enumerate(labels, start=1):
        expr = expr.when(b == i, F.lit(lab))
    return df.withColumn(out, expr)

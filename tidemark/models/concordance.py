"""M6: Harrell's concordance index for survival scores, exact and distributed.

Comparable pairs (i, j): i had the event at d_i and j lasted longer
(T_j > d_i) or was censored at d_i. The pair is concordant when i's risk
score is higher, half when tied. c = (concordant + ties / 2) / pairs.

Nothing is paired row by row. Rows are counted per (score, duration), so a hot
tied score is one row per duration, and range partitioned by score into cells:
  * pairs and ties: suffix sums over the durations, of all rows and of each
    score;
  * concordant pairs inside a cell: vectorised merge counting in the task that
    holds the cell's counts;
  * concordant pairs across cells: the cells are the leaves of a binary tree.
    Two cells part at exactly one node, the lower one into its left half; per
    node and duration the left half's rows and the right half's events are
    summed, and a suffix sum over the durations pairs them. Only (node,
    duration) pairs that occur are rows; there is no grid and no limit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def concordant_inside(v: np.ndarray, d: np.ndarray, n_all: np.ndarray, n_cens: np.ndarray, n_ev: np.ndarray) -> float:
    """Concordant pairs within one table of counts by (score, duration): the
    same tree over the ranks of the scores, one vectorised pass per level."""
    rank = np.unique(v, return_inverse=True)[1]
    total, level = 0.0, 0
    while rank.size and (rank.max() >> level):
        node, right = rank >> (level + 1), (rank >> level) & 1
        # durations descending inside each node; a right row sees the left rows before it
        order = np.lexsort((-d, node))
        nd, dd, side = node[order], d[order], right[order]
        left_all = np.where(side == 0, n_all[order], 0.0)
        left_cens = np.where(side == 0, n_cens[order], 0.0)
        run = np.flatnonzero(np.r_[True, (nd[1:] != nd[:-1]) | (dd[1:] != dd[:-1])])     # (node, duration) runs
        first = np.flatnonzero(np.r_[True, nd[run][1:] != nd[run][:-1]])                 # runs that start a node
        before = np.cumsum(np.r_[0.0, np.add.reduceat(left_all, run)])[:-1]
        before -= np.repeat(before[first], np.diff(np.r_[first, len(run)]))
        events = np.add.reduceat(np.where(side == 1, n_ev[order], 0.0), run)
        total += float((events * (before + np.add.reduceat(left_cens, run))).sum())
        level += 1
    return total


def _within_cell(pdf: pd.DataFrame) -> pd.DataFrame:
    cols = [pdf[c].to_numpy(dtype=float) for c in ("v", "d", "n_all", "n_cens", "n_ev")]
    return pd.DataFrame({"conc": [concordant_inside(*cols)]})


def concordance(df: DataFrame, duration: str, event: str, score: "str | F.Column") -> DataFrame:
    """One row: pairs, concordant, tied, concordance_index. ``score``:
    higher = higher risk (e.g. the Cox linear predictor)."""
    s = F.col(score) if isinstance(score, str) else score
    rows = df.select(F.col(duration).cast("long").alias("d"), F.col(event).cast("long").alias("e"),
                     s.cast("double").alias("v")).dropna()
    counts = rows.groupBy("v", "d").agg(F.count(F.lit(1)).alias("n_all"), F.sum(1 - F.col("e")).alias("n_cens"), F.sum("e").alias("n_ev"))
    cnt = counts.repartitionByRange("v").withColumn("c", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)

    def later(sums, keys):
        """Events times the rows that last longer or are censored then."""
        w = Window.partitionBy(*keys).orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, -1)
        pair = F.col("ev") * (F.coalesce(F.sum("a").over(w), F.lit(0)) + F.col("cz"))
        return sums.select(pair.cast("double").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0.0)).alias("n"))

    total = [F.sum("n_all").alias("a"), F.sum("n_cens").alias("cz"), F.sum("n_ev").alias("ev")]
    one = F.lit(0).alias("all")
    pairs = later(cnt.groupBy(one, "d").agg(*total), ["all"])       # one row per duration
    ties = later(cnt.select("v", "d", F.col("n_all").alias("a"), F.col("n_cens").alias("cz"), F.col("n_ev").alias("ev")), ["v"])
    cells = cnt.agg(F.max("c")).collect()[0][0]
    levels = int(cells or 0).bit_length()
    left = F.expr("shiftright(c, level) & 1") == 0
    nodes = (cnt.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(max(levels - 1, 0)))))
             .groupBy("level", F.expr("shiftright(c, level + 1)").alias("node"), "d")
             .agg(F.sum(F.when(left, F.col("n_all")).otherwise(0)).alias("a"), F.sum(F.when(left, F.col("n_cens")).otherwise(0)).alias("cz"),
                  F.sum(F.when(left, 0).otherwise(F.col("n_ev"))).alias("ev")))
    across = later(nodes, ["level", "node"])
    inside = cnt.groupBy("c").applyInPandas(_within_cell, "conc double").agg(F.coalesce(F.sum("conc"), F.lit(0.0)).alias("n"))
    parts = {k: d.select(F.lit(k).alias("k"), "n") for k, d in (("pairs", pairs), ("ties", ties), ("across", across), ("inside", inside))}
    got = {r["k"]: float(r["n"]) for r in parts["pairs"].union(parts["ties"]).union(parts["across"]).union(parts["inside"]).collect()}
    cnt.unpersist()
    conc = got["inside"] + (got["across"] if levels else 0.0)
    index = (conc + 0.5 * got["ties"]) / got["pairs"] if got["pairs"] else None
    return df.sparkSession.createDataFrame([(got["pairs"], conc, got["ties"], index)],
                                           "pairs double, concordant double, tied double, concordance_index double")

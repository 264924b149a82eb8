"""Exact quantile edges and global positions without pulling all rows into
one task.

Edges come from ``selection``: sketches bracket the wanted positions, narrow
aggregates prove the brackets, and only rows inside them are shuffled.
Positions of all rows come from range partitions and their row counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stable_base
from .selection import select_positions


def edge_positions(n: int, q: int) -> list[int]:
    """Positions around the interior edges i/q: i * (n - 1) div q, and the
    next one where the remainder is not 0."""
    out = set()
    for i in range(1, q):
        lo, rem = divmod(i * (n - 1), q)
        out |= {lo, lo + 1} if rem else {lo}
    return sorted(out) if n else []


def edges_at(stats: Mapping[int, float], n: int, q: int) -> list[float]:
    """Interior edges by linear interpolation between order statistics; an
    edge that falls on a data value equals it exactly."""
    out = []
    for i in range(1, q) if n else ():
        lo, rem = divmod(i * (n - 1), q)
        out.append(stats[lo] if rem == 0 else stats[lo] + (stats[lo + 1] - stats[lo]) * (rem / q))
    return out


def quantile_edges(df: DataFrame, col: str, q: int) -> list[float]:
    """Interior edges i/q (i = 1..q-1) of a column, nulls left out."""
    n, stats = select_positions(df, {"v": (col,)}, {"v": lambda n: edge_positions(n, q)})
    return edges_at(stats["v"], n["v"], q)


def rank_positions(n: int, q: int) -> list[int]:
    """0-based positions whose rows end the quantile buckets of a rank."""
    return [i * (n - 1) // q for i in range(1, q)] if n else []


def bucket_by_boundaries(value: str, tie: str, bounds: Sequence[tuple[float, Any]]) -> Column:
    """Quantile bucket of a row's position in (value, tie) order: 1 + the
    boundary rows that it comes after (a null tie comes first)."""
    out = F.lit(1)
    for a, b in bounds:
        after = F.col(tie).isNotNull() if b is None else F.coalesce(F.col(tie) > F.lit(b), F.lit(False))
        out = out + F.when((F.col(value) > F.lit(a)) | ((F.col(value) == F.lit(a)) & after), 1).otherwise(0)
    return out


def bucket_by_edges(value: "str | Column", edges: Sequence[float]) -> Column:
    """1 + number of interior edges strictly below the value: right-closed
    bins, lowest value included (monotone even when edges tie)."""
    v = F.col(value) if isinstance(value, str) else value
    out = F.lit(1)
    for e in edges:
        out = out + F.when(v > F.lit(float(e)), 1).otherwise(0)
    return out


def bucket_by_edge_columns(value: str, edge_cols: Sequence[str]) -> Column:
    """1 + number of edge columns strictly below the value."""
    terms = " + ".join(f"CASE WHEN `{value}` > `{e}` THEN 1 ELSE 0 END" for e in edge_cols)
    return F.expr(f"1 + {terms}") if edge_cols else F.lit(1)


def global_row_number(df: DataFrame, order: Sequence[str], out: str = "rn") -> DataFrame:
    """1-based position of every row in ``order``: rows are range partitioned,
    sorted and numbered inside their partition, and staged with these numbers
    on the shared folder. The row counts of the partitions (a table of one row
    each) give the shift that is joined back."""
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    staged = stable_base(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_part", F.spark_partition_id()).withColumn("_at", inside))
    counts = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row a partition, so one ordered window over them is small
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifted = staged.join(counts.select("_part", before.alias("_before")), "_part")
    return shifted.withColumn(out, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")

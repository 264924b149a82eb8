"""Mixing sources to target weights by capped water-filling (operator 6).

Targets: every source gets its weight's share of the total wanted; a source
whose share exceeds ``epochs`` times its size is clamped there and the excess
is shared again by weight, until none is above. Only the sums of each round
reach the driver. Sampling: a source is taken ``floor(target / size)`` whole
times, and the rest by one seeded pass: rows in the order of a hash of their
id are taken while the middle of the row lies within the rest. A source is
split by the first hash digits into buckets, so the running sum never needs
one task per source.

DataFrame functions only. Defined cases: a null text has size 0; the null
source is a source of its own, last in order; rows with equal ids are ordered
by size (equal rows are interchangeable); empty texts are taken zero words;
without any words all targets are 0; an empty table gives an empty table;
other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import free_name, materialise

BUCKET_DIGITS = 3   # hex digits: 4,096 buckets a source


def n_words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text: each becomes one letter, white
    space goes, what is left is counted."""
    each = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(each, " \t\n\x0b\f\r", "")).cast("long"), F.lit(0).cast("long"))


def source_table(sized: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """(source, source_size, weight): weights repeat over the sources in code
    point order, null last. Positions come from range partitions and their
    row counts, so no task holds all sources."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.col("source").asc_nulls_last()
    parts = materialise(totals.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    counts, offset, before = dict(parts.groupBy("part").count().collect()), {}, 0
    for p in sorted(counts):
        offset[p], before = before, before + counts[p]
    start = F.element_at(F.create_map(*[F.lit(x) for kv in offset.items() for x in kv]), F.col("part")) if offset else F.lit(0)
    position = start + F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (position % len(weights) + 1).cast("int"))
    return parts.select("source", "source_size", weight.cast("long").alias("weight"))


def targets(sources: DataFrame, share: float, epochs: int) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight)."""
    cap = F.col("source_size") * epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    wanted = share * total
    over, clamped, weight = F.lit(False), 0, None
    while True:
        # sums over the sources that are not clamped yet
        row = sources.agg(F.sum(F.when(~over, F.col("weight"))).alias("w"), F.sum(F.when(over, cap)).alias("c"),
                          F.count(F.when(over, 1)).alias("n")).first()
        clamped, w, n = row["c"] or 0, row["w"], row["n"]
        if not w or n == weight:
            break
        weight = n
        over = F.col("weight") * F.lit(wanted - clamped) / F.lit(w) > cap
    target = cap.cast("double") if not w else F.when(over, cap.cast("double")).otherwise(
        F.col("weight") * F.lit(wanted - clamped) / F.lit(w))
    return sources.withColumn("target", target)


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2, seed: int = 17,
        out: str = "mix") -> DataFrame:
    """``df`` with a struct column ``out``: size, source_size, target, copies
    (how often the mix takes the row) and taken (its words times copies)."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    cols = df.columns
    inner = df.select(F.struct(*[F.col(c) for c in cols]).alias("row"), F.col(source).alias("source"),
                      n_words(F.col(text)).alias("size"), key.alias("key")
                      ).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sized = materialise(inner.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "buckets")
    src = targets(source_table(sized, weights), share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    src = src.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (sized.withColumn("bucket_start", F.coalesce(F.sum("size").over(upto), F.lit(0))).drop("size")
            .withColumnRenamed("source", "s").withColumnRenamed("bucket", "b"))
    plan = plan.join(src.withColumnRenamed("source", "t"), F.col("s").eqNullSafe(F.col("t"))).drop("t")
    at = Window.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("bucket_start") + F.coalesce(F.sum("size").over(at), F.lit(0))
    full = (inner.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
            .withColumn("before", before)
            .withColumn("copies", F.col("whole") + (F.col("before") + F.col("size") / 2 <= F.col("rest")).cast("long")))
    return full.select("row.*", F.struct("size", "source_size", "target", "copies",
                                         (F.col("size") * F.col("copies")).alias("taken")).alias(out))


def mixed_rows(df: DataFrame, **options) -> DataFrame:
    """The rows of the mix, each as often as it is taken, columns of ``df``."""
    name = free_name(df, "mix")
    m = mix(df, out=name, **options)
    copy = free_name(df, "copy")
    again = F.explode(F.sequence(F.lit(1), F.col(name)["copies"].cast("int")))
    return m.where(F.col(name)["copies"] > 0).select(*df.columns, again.alias(copy)).drop(copy)

"""DataFrame helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the
    plan after it starts from a table that every executor can reread."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a materialised table that no plan reads any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base = "_" + base
    return base


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): one row
    (node, root) per node that has an edge, root = the component's smallest
    node. Alternates the large-star and small-star steps: each step is an
    aggregate per node (partial before its shuffle) and an equi-join that
    adaptive execution can split, so a hub with a third of all edges is no
    single task. Every round is written to the shared folder. Nodes may be of
    any orderable type; loops and repeated edges are allowed; no edges give
    no rows."""
    e = materialise(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before = None
    while True:          # settles after O(log^2) rounds
        # large star: every larger neighbour of u points to the least of u's neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("lo")).select("u", F.least("u", "lo").alias("m"))
        large = (both.join(least.hint("merge"), "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: a node and its smaller neighbours point to the least of them
        least2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least2.hint("merge"), "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least2.select("u", F.col("m").alias("v"))).distinct())
        after = materialise(small, "cc")
        discard(e)
        e = after
        sign = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == before:
            break
        before = sign
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

"""Near-duplicate vectors by spherical k-means cells (operator 1).

Vectors are compared by cosine (double precision) when their group values are
equal. Equal vectors of a group are one node. Centres are fitted on a sample
of at most ``SAMPLE`` nodes; every node's home is the centre with the largest
cosine. A node also visits each cell that can hold a partner: for unit vectors
u (home a) and v (home b) with cosine >= t, |u - v| <= c = sqrt(2 - 2t) and
u.(b - a) <= 0 give v.(b - a) <= c |b - a|. So a home row meets all its
partners inside its own cell and no link is lost, whatever the centres are.
Cells are cut into blocks of about ``BLOCK`` rows; a task multiplies one block
of home rows with one block of members, and returns per row the number of its
links and a spanning forest of them, never the pairs.

Defined cases: a vector that is null, empty, zero, or has null or non-finite
components, or has a null group, links with nothing; vectors of different
lengths do not link; repeated rows link with each other (n_links counts rows);
rows with a null id take part, a component's id is the least non-null id; an
empty table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import components, materialise

SAMPLE = 20_000      # nodes that the centres are fitted on
CELL = 2_048         # nodes wanted per cell
CELLS = 1_024        # most centres
ROUNDS = 10          # k-means rounds
BLOCK = 4_096        # rows of a block
TILE = 1_024         # rows of a product


def unit_rows(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)     # no overflow or underflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """``k`` unit centres of the unit rows ``x``."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        home = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        norm = np.linalg.norm(total, axis=1)
        c = np.where(norm[:, None] > 1e-12, total / np.maximum(norm, 1e-12)[:, None], c)
    return c


def visits(u: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home of each row, and whether it has to be present in each cell."""
    s = u @ c.T
    home = np.argmax(s, axis=1)
    gap = np.sqrt(np.maximum(2.0 - 2.0 * (c @ c.T), 0.0))
    reach = np.sqrt(2.0 - 2.0 * threshold) + 1e-9
    there = s[np.arange(len(u)), home][:, None] - s <= reach * gap[home] + 1e-9
    return home, there


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least connected position of each of ``n`` positions."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(home: np.ndarray, members: np.ndarray, same: np.ndarray, copies: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each home row (weighted by copies), and the forest label over
    home rows followed by members. same: position of each home row among the
    members, or -1."""
    h, m = len(home), len(members)
    count = np.zeros(h, np.int64)
    label = np.arange(h + m)
    for i in range(0, h, TILE):
        for j in range(0, m, TILE):
            hit = home[i:i + TILE] @ members[j:j + TILE].T >= threshold
            own = same[i:i + TILE] - j
            at = np.flatnonzero((own >= 0) & (own < hit.shape[1]))
            hit[at, own[at]] = False
            count[i:i + TILE] += hit @ copies[j:j + TILE]
            a, b = np.nonzero(hit)
            if len(a):
                label = np.minimum(label, forest(h + m, np.concatenate([a + i, np.arange(h + m)]),
                                                 np.concatenate([b + h + j, label])))
    return count, label


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", group: str = "label",
                 threshold: float = 0.98, cell: int = CELL, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``df``."""
    v = F.col("v")
    valid = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(group).cast("string").alias("g"), F.col(vector).cast("array<double>").alias("v"))
            .withColumn("ok", F.coalesce(valid & F.col("g").isNotNull(), F.lit(False)))
            .withColumn("v", F.when(F.col("ok"), F.transform(v, lambda x: x + F.lit(0.0))))     # -0.0 becomes 0.0
            .withColumn("node", F.when(F.col("ok"), F.concat(F.hex(F.xxhash64("g", "v")), F.lit("-"), F.hex(F.xxhash64(F.reverse("v"), "g"))))))
    nodes = materialise(rows.where("ok").groupBy("node").agg(
        F.first("g").alias("g"), F.first("v").alias("v"), F.min("id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("dim", F.size("v").cast("long")), "vectors")

    n = nodes.count()
    picked = nodes.select("dim", "v").orderBy("node").limit(sample).collect()      # bounded by ``sample``
    centres: dict[int, np.ndarray] = {}
    for dim in {r.dim for r in picked}:
        x = np.array([r.v for r in picked if r.dim == dim])
        k = max(1, min(CELLS, round(n * len(x) / max(1, len(picked)) / cell)))
        centres[dim] = spherical_kmeans(unit_rows(x.ravel(), dim), k)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                dims = b.column("dim").to_numpy()
                for dim in np.unique(dims):
                    part = b.filter(pa.array(dims == dim))
                    u = unit_rows(part.column("v").flatten().to_numpy(), int(dim))
                    home, there = visits(u, centres.get(int(dim), np.eye(1, int(dim))), threshold)
                    r, c = np.nonzero(there)
                    flat = u[r].ravel()
                    ends = (np.arange(len(r) + 1) * dim).astype(np.int32)
                    take = pa.array(r)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("node").take(take), part.column("g").take(take), part.column("dim").take(take), part.column("copies").take(take),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(c.astype(np.int64)), pa.array(home[r] == c)],
                        ["node", "g", "dim", "copies", "u", "cell", "home"])

    present = materialise(nodes.select("node", "g", "dim", "copies", "v").mapInArrow(
        assign, "node string, g string, dim long, copies long, u array<double>, cell long, home boolean"), "cells")
    key = ["g", "dim", "cell"]
    # blocks of a cell: every row has one; home rows meet all blocks, members all blocks that hold home rows
    sizes = present.groupBy(*key).agg(F.ceil(F.count("*") / block).alias("blocks"))
    cut = (present.join(sizes, key).withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")))
           .withColumn("others", F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = (cut.where("home").select(*key, "node", "copies", "u", F.lit(True).alias("role"), F.col("b").alias("i"), F.explode("others").alias("j"))
             .union(cut.select(*key, "node", "copies", "u", F.lit(False).alias("role"), F.explode("others").alias("i"), F.col("b").alias("j"))))

    def product(t: pa.Table) -> pa.Table:
        role = t.column("role").to_numpy()
        dim = t.column("dim")[0].as_py()
        u = t.column("u").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        names = np.array(t.column("node").to_pylist(), dtype=object)
        copies = t.column("copies").to_numpy()
        h, m = np.flatnonzero(role), np.flatnonzero(~role)
        place = {x: k for k, x in enumerate(names[m])}
        same = np.array([place.get(x, -1) for x in names[h]], np.int64)
        count, label = links(u[h], u[m], same, copies[m], threshold)
        order = np.concatenate([names[h], names[m]])
        tied = np.flatnonzero(label != np.arange(len(label)))
        a = np.concatenate([names[h], order[tied]])
        b = np.concatenate([names[h], order[label[tied]]])
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()),
                         "n": pa.array(np.concatenate([count, np.zeros(len(tied), np.int64)]))})

    found = materialise(dealt.groupBy(*key, "i", "j").applyInArrow(product, "a string, b string, n long"), "links")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = materialise(components(found.where("a != b").select("a", "b")), "roots")
    full = (nodes.select("node", "rep", "copies").join(counts.hint("merge"), "node", "left").join(roots.hint("merge"), "node", "left")
            .withColumn("root", F.coalesce("root", "node")))
    least = full.groupBy("root").agg(F.min("rep").alias("component_id"))
    full = full.join(least.hint("merge"), "root").select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), "component_id")
    out = rows.select("id", "node").join(full.hint("merge"), "node", "left")
    component = F.when(F.col("node").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))

"""Merkle manifest of a dataset by cogrouped subtree exchange (operator 13).

A leaf is the SHA-256 of a row's fields, each written with its length. The
leaves of a tree (a source) ascend by id; every ``fan`` consecutive nodes of a
level become the hash of their hex digests, until one node is left. The roots
of the trees, in tree order, are the leaves of one more tree.

``fan ** height`` consecutive nodes are a superblock. Going up, a superblock
is reduced to one node, which is a node of the next tier; a tier is
``fan ** height`` times smaller than the one below. Going down, the nodes of a
tier are cogrouped by superblock with the one outer row that their superblock
needs: the siblings on the way from its root to the root of everything. That
single pass reduces the superblock again, joins inner and outer siblings to
whole proofs, and folds the presented digests. So a task holds one superblock
whatever the size of a tree, and only digests are shuffled.

Positions come from range partitions and their row counts, so a source with a
third of all rows is spread like the others, and so are repeated rows.

Defined cases: a null field is ``-``; a null or empty text is a leaf like any
other; the null tree is a tree of its own and comes first; null ids come
first; rows with equal ids are ordered by leaf (equal rows have equal leaves);
a tree of one leaf is that leaf; a dataset of one leaf has an empty proof; an
empty table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import materialise

FAN = 3
HEIGHT = 7          # 2,187 nodes a superblock
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree string, pos long, n long, digest string"
OUTER = "tree string, block long, lefts array<string>, rights array<string>, subroot string, root string"


def digest(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


def leaf(*fields: Column) -> Column:
    """The leaf of a row: every field as ``-`` or UTF-8 length, colon, value."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[one(c) for c in fields]), 256)


def reduce_levels(nodes: list[str], fan: int, height: int | None) -> list[list[str]]:
    """The levels above ``nodes``, themselves first: ``height`` of them, or
    as many as lead to one node."""
    levels = [nodes]
    while len(levels) <= height if height is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i:i + fan])) for i in range(0, len(below), fan)])
    return levels


def local_height(n: int, fan: int, height: int) -> int | None:
    """Levels inside a superblock of a tier with ``n`` nodes of a tree."""
    return height if n > fan ** height else None


def siblings(levels: list[list[str]], fan: int) -> list[list[tuple[str, str]]]:
    """Per level below the top, the hex digests left and right of each node in its run."""
    out = []
    for nodes in levels[:-1]:
        row = []
        for i in range(len(nodes)):
            start = i - i % fan
            row.append(("".join(nodes[start:i]), "".join(nodes[i + 1:start + fan])))
        out.append(row)
    return out


def numbered(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` (with ``tree``) plus ``pos``, their place in their tree by
    ``order``, and ``n``, the rows of the tree."""
    inside = F.col("at_id").bitwiseAND((1 << 33) - 1)
    parts = materialise(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                        .withColumn("part", F.spark_partition_id()).withColumn("at_id", F.monotonically_increasing_id())
                        .withColumn("at", inside).drop("at_id"), label)
    runs = parts.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("c").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("c").over(whole).alias("n"))
    return parts.join(runs.hint("merge"), ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _block(fan: int, height: int) -> Column:
    return F.floor(F.col("pos") / F.lit(fan ** height)).cast("long").alias("block")


def climb(nodes: DataFrame, fan: int, height: int, label: str) -> list[DataFrame]:
    """The tiers above ``nodes`` (NODE), themselves first. A tree's root is
    its row with n = 1 in a tier above the first."""
    size = fan ** height

    def up(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("pos")
        n = int(g["n"].iloc[0])
        top = reduce_levels(g["digest"].tolist(), fan, local_height(n, fan, height))[-1][0]
        return pd.DataFrame({"tree": [g["tree"].iloc[0]], "pos": [g["block"].iloc[0]], "n": [-(-n // size)], "digest": [top]})

    tiers = [nodes]
    open_nodes = nodes
    while True:
        blocks = open_nodes.select("tree", "pos", "n", "digest", _block(fan, height))
        tier = materialise(blocks.groupBy("tree", "block").applyInPandas(up, NODE), label)
        tiers.append(tier)
        open_nodes = tier.where("n > 1")
        if not open_nodes.limit(1).count():
            return tiers


def descend(tier: DataFrame, outer: DataFrame, fan: int, height: int, keep_root: bool) -> DataFrame:
    """The whole path of every node of a tier as an outer row for the tier
    below. ``keep_root``: the node's digest is the subroot of what hangs below."""
    def down(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a):
            return pd.DataFrame({c.split()[0]: [] for c in OUTER.split(", ")})
        a = a.sort_values("pos")
        levels = reduce_levels(a["digest"].tolist(), fan, local_height(int(a["n"].iloc[0]), fan, height))
        inner, up = siblings(levels, fan), b.iloc[0]
        lefts, rights = [], []
        for i in range(len(a)):
            path = [row[i // fan ** k] for k, row in enumerate(inner)]
            lefts.append([x for x, _ in path] + list(up["lefts"]))
            rights.append([y for _, y in path] + list(up["rights"]))
        return pd.DataFrame({"tree": a["tree"], "block": a["pos"], "lefts": lefts, "rights": rights,
                             "subroot": a["digest"] if keep_root else up["subroot"], "root": up["root"]})

    blocks = tier.select("tree", "pos", "n", "digest", _block(fan, height))
    return blocks.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(down, OUTER)


def manifest(leaves: DataFrame, fan: int = FAN, height: int = HEIGHT, with_path: bool = False) -> DataFrame:
    """``leaves``: tree (string), id (long), leaf and found (hex digests; found
    is what is presented for verification). Gives id, leaf, subroot, root,
    proof_sha256, folded_root, verified per row, and with ``with_path`` the
    digests left and right of the row's node on every level."""
    row = leaves.select(F.coalesce(F.concat(F.lit("="), F.col("tree")), F.lit("")).alias("tree"), "id", F.col("leaf").alias("digest"), "found",
                        F.monotonically_increasing_id().alias("row"))
    first = materialise(numbered(materialise(row, "leaves"), ["id", "digest", "row"], "leaf-order"), "leaf-nodes")
    tiers = climb(first.select("tree", "pos", "n", "digest"), fan, height, "tier")
    roots = [t.where("n = 1") for t in tiers[1:]]
    all_roots = roots[0]
    for r in roots[1:]:
        all_roots = all_roots.union(r)

    # the tree over the roots of the trees
    name = F.struct(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = materialise(numbered(all_roots.select(name.alias("x")).select("x.*"), ["name"], "root-order"), "root-nodes")
    over = climb(tops.select("tree", "pos", "n", "digest"), fan, height, "root-tier")
    none = F.array().cast("array<string>")
    outer = over[-1].where("n = 1").select("tree", F.lit(0).cast("long").alias("block"), none.alias("lefts"), none.alias("rights"),
                                           F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    for tier in reversed(over[:-1]):
        outer = materialise(descend(tier, outer, fan, height, True), "root-paths")
    # a root's path is the outer row of the single superblock at the top of its tree
    of_root = materialise(tops.select("name", F.col("pos").alias("block")).join(outer.drop("tree").hint("merge"), "block")
                          .select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "lefts", "rights", "subroot", "root"), "root-outer")

    path = of_root.limit(0)
    for k in range(len(tiers) - 1, 0, -1):
        done = of_root.join(tiers[k].where("n = 1").select("tree").hint("merge"), "tree", "left_semi").select(*path.columns)
        outer = done if k == len(tiers) - 1 else path.union(done)
        if k == 1:
            break
        path = materialise(descend(tiers[k - 1].where("n > 1"), outer, fan, height, False), "paths")

    extra = ", lefts array<string>, rights array<string>" if with_path else ""
    schema = f"id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean{extra}"
    names = [c.split()[0] for c in schema.split(", ")]

    def finish(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a):
            return pd.DataFrame({c: [] for c in names})
        a = a.sort_values("pos")
        leaf_digests, up = a["digest"].tolist(), b.iloc[0]
        levels = reduce_levels(leaf_digests, fan, local_height(int(a["n"].iloc[0]), fan, height))
        inner, above = siblings(levels, fan), list(zip(up["lefts"], up["rights"]))
        tail = "".join(x + y for x, y in above)
        proofs = [tail]                     # per node of a level: the siblings from there to the root
        for row in reversed(inner):
            proofs = [x + y + proofs[i // fan] for i, (x, y) in enumerate(row)]
        folded = []
        for i, h in enumerate(a["found"]):
            for k, row in enumerate(inner):
                x, y = row[i // fan ** k]
                h = digest(x + h + y)
            for x, y in above:
                h = digest(x + h + y)
            folded.append(h)
        out = pd.DataFrame({"id": a["id"], "leaf": leaf_digests, "subroot": up["subroot"], "root": up["root"],
                            "proof_sha256": [digest(p) for p in proofs], "folded_root": folded,
                            "verified": [f == up["root"] for f in folded]})
        if with_path:
            paths = [[row[i // fan ** k] for k, row in enumerate(inner)] + above for i in range(len(a))]
            out["lefts"], out["rights"] = [[x for x, _ in p] for p in paths], [[y for _, y in p] for p in paths]
        return out

    # ids travel as text: pandas would turn a long with nulls into a double
    nodes = first.select("tree", "pos", "n", "digest", "found", F.col("id").cast("string").alias("id"), _block(fan, height))
    done = nodes.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(finish, schema)
    return done.withColumn("id", F.col("id").cast("long"))


def tampered(text: Column, key: Column) -> Column:
    """The text as presented: rows whose id has an even CRC-32 lose their line feeds."""
    even = F.crc32(key.cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.translate(text, "\n", "")).otherwise(text)


def dataset_manifest(df: DataFrame, presented: Column | None = None, id_col: str = "doc_id", tree: str = "source", text: str = "text",
                     fields: tuple[str, ...] = FIELDS, **options) -> DataFrame:
    """``manifest`` over the rows of a table. ``presented``: the text to
    verify instead of the stored one."""
    seen = F.col(text) if presented is None else presented
    return manifest(df.select(
        F.col(tree).cast("string").alias("tree"), F.col(id_col).cast("long").alias("id"), leaf(*[F.col(c) for c in fields]).alias("leaf"),
        leaf(*[seen if c == text else F.col(c) for c in fields]).alias("found")), **options)

"""Near-duplicate documents by HyperMinHash (operator 3).

Sketch: shingle hashes fall into ``M`` buckets; a bucket keeps its least hash
as a 16-bit register (leading zeros and ten mantissa bits). Empty buckets take
the register of the non-empty bucket that a fixed priority ranks first for
them, so that short texts have full sketches. Bands of registers are the
candidate keys; rows per band are the most that still find a pair at the
threshold with probability over 1 - 1e-8.

Equal sets are one node. In each key the node whose keys are the most popular
is the centre: all members are compared with the centre on full sets, so a key
costs as many comparisons as it has members. What remains are pairs of which
one is not linked with the centre. Such a pair can only be similar enough if
the two share parts of their *differences* from the centre; with differences
ordered alike (what the fewest members share first) it must share one among the first few of
each, with enough of both left after it (prefix and position filtering, exact).
Only pairs that are in different components after the comparisons with centres
are looked for, by an equi-join: members of a sub-family far from the centre have
keys of their own, with a centre among them, and are one component by then. Pairs
pass a collision-corrected sketch estimate (eight standard deviations below the
threshold, by the registers that the smaller set can fill) and are confirmed on
full sets. Links give connected components.

Defined cases: a text without words (null too) has an empty set and is linked
with nothing; fewer words than the width are one shingle; repeated rows are in
one component; a null id counts after all others (a component of null ids has
a null component_id); one very long text is one set in one task; an empty
table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .frames import components, free_name, materialise

M = 256            # registers
BUCKET_BITS = 8
MANTISSA = 10
MISS = 1e-8        # chance that a pair at the threshold shares no band
SIGMAS = 8.0       # of the estimate's error, below which a pair is not looked at
SKETCH = "struct<n:bigint,sig:binary,regs:binary>"


@lru_cache(maxsize=1)
def priorities() -> np.ndarray:
    """For every bucket, the rank of all buckets as its stand-in."""
    grid = np.arange(M * M, dtype=np.uint64).reshape(M, M)
    return np.argsort(np.argsort(T.mix(grid + np.uint64(0x51ED2701)), axis=1), axis=1).astype(np.int16)


def registers(hashes: np.ndarray) -> np.ndarray:
    """16-bit registers of a sorted set of 64-bit hashes (not empty)."""
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    low = hashes[first] & np.uint64((1 << (64 - BUCKET_BITS)) - 1)
    # bit length: exact, as 53 bits fit a double
    length = np.maximum(np.frexp((low >> np.uint64(3)).astype(np.float64))[1] + 3, MANTISSA + 1).astype(np.uint64)
    zeros = np.uint64(64 - BUCKET_BITS) - length
    mantissa = (low >> (length - np.uint64(MANTISSA + 1))) & np.uint64((1 << MANTISSA) - 1)
    have = bucket[first]
    out = np.zeros(M, np.uint16)
    out[have] = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    if len(have) < M:
        empty = np.setdiff1d(np.arange(M), have, assume_unique=True)
        out[empty] = out[have[np.argmin(priorities()[np.ix_(empty, have)], axis=1)]]
    return out


def rows_per_band(threshold: float) -> int:
    """The most registers a band may have and still miss few enough pairs."""
    return max(r for r in range(1, 9) if (1 - threshold ** r) ** (M // r) <= MISS)


def band_keys(regs: np.ndarray, rows: int) -> np.ndarray:
    bands = M // rows
    x = regs[:, :bands * rows].reshape(len(regs), bands, rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), x.shape[:2]).copy()
    for k in range(rows):
        h = T.mix(h * np.uint64(0x9FB21C651E98DF25) + x[:, :, k])
    return h


def shingles_of(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingle set of each text of an Arrow column, in order."""
    raw, offsets = T.buffers(column)
    for i, j in T.blocks(offsets):
        s, e, ptr = T.words(raw, offsets[i:j + 1])
        h = T.word_hashes(raw, s, e, lower=True)
        for k in range(j - i):
            yield T.shingle_set(h[ptr[k]:ptr[k + 1]], width)


def signature(hashes: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    a = np.add.reduce(T.mix(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A)))
    b = np.add.reduce(T.mix(hashes + np.uint64(0x632BE59BD9B4E019)))
    return a.tobytes() + b.tobytes()


def _typed(run, result):
    run.__annotations__ = {"it": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, result).asNondeterministic()


def sketch(text: Column, width: int) -> Column:
    """Set size, signature and registers of a text (null where it has no words)."""
    def run(it):
        for column in it:
            n, sig, regs = [], [], []
            for s in shingles_of(column, width):
                n.append(len(s))
                sig.append(signature(s) if len(s) else None)
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(regs, pa.binary())],
                                             ["n", "sig", "regs"])
    return _typed(run, SKETCH)(text)


def signed_set(text: Column, width: int) -> Column:
    """The full set of a text and its signature."""
    def run(it):
        for column in it:
            sets = list(shingles_of(column, width))
            sig = pa.array([signature(s) if len(s) else None for s in sets], pa.binary())
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays([sig, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["sig", "items"])
    return _typed(run, "struct<sig:binary,items:array<bigint>>")(text)


def keys_of(regs: Column, rows: int) -> Column:
    def run(it):
        for column in it:
            got = column.to_pylist()
            keys = band_keys(np.frombuffer(b"".join(got), np.uint16).reshape(len(got), M), rows).view(np.int64) if got else np.zeros((0, M // rows), np.int64)
            ends = np.arange(len(got) + 1, dtype=np.int32) * (M // rows)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))
    return _typed(run, "array<bigint>")(regs)


def estimate(matches: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Jaccard from equal registers, corrected for registers that are equal by
    chance: equal leading zeros, then equal mantissas."""
    chance = np.zeros(len(matches))
    last1 = last2 = 1.0
    for z in range(0, 40):
        p1 = 1.0 - (1.0 - 2.0 ** -(z + 1)) ** np.maximum(n1 / M, 1)
        p2 = 1.0 - (1.0 - 2.0 ** -(z + 1)) ** np.maximum(n2 / M, 1)
        chance += (last1 - p1) * (last2 - p2)
        last1, last2 = p1, p2
    chance = chance / 2.0 ** MANTISSA
    return np.clip((matches / M - chance) / (1.0 - chance), 0.0, 1.0)


def least_estimate(threshold: float, n: np.ndarray) -> np.ndarray:
    """What the estimate of a pair at the threshold does not fall below, where
    the smaller set fills ``n`` registers at most (others are stand-ins)."""
    return threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / np.clip(n, 1, M))


def _lists(column) -> list[np.ndarray]:
    """Arrow lists of longs as sorted uint64 arrays."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    at = column.offsets.to_numpy()
    return [flat[at[i]:at[i + 1]] for i in range(len(column))]


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which items of ``b`` are in the sorted ``a``."""
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return a[at] == b


def similar(inter: int, na: int, nb: int, percent: int) -> bool:
    return 100 * inter >= percent * (na + nb - inter)


def difference(c: np.ndarray, x: np.ndarray, percent: int) -> tuple[bool, int, int, np.ndarray]:
    """Whether x is linked with the centre c, how many items of its difference
    from c it is looked up by as an unlinked member, and found by (the first
    ones in an order that all members share), and the difference."""
    hit = common(c, x)
    inter = int(hit.sum())
    linked = similar(inter, len(c), len(x), percent)
    d = np.concatenate([x[~hit], c[~common(x, c)]])
    alpha = slack(percent)                               # |x ^ y| <= alpha (|x| + |y|) for a link
    # shared differences: at least |Dx| - alpha |x| (1 + 1/t) ...
    least = max(1, int(np.ceil(len(d) - alpha * len(x) * (1 + 100 / percent) - 1e-9)))
    looks = 0 if linked else max(0, len(d) - least + 1)
    # ... and, with an unlinked partner, more than half of |Dy| - alpha (|y| - |c|)
    least = max(1, int(np.floor((len(d) - alpha * (len(x) - len(c))) / 2 - 1e-9)) + 1)
    return linked, looks, max(0, len(d) - least + 1), d


def slack(percent: int) -> float:
    return (100 - percent) / (100 + percent)


def _pack(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _groups(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sketches of ``docs`` (id, text, and row where rows have a key), and
    (sig, rep, top) of every set: its least row by id, nulls last, and the
    root of its component."""
    threshold = percent / 100
    rows = rows_per_band(threshold)
    docs = docs.withColumn("mark", F.xxhash64("text"))
    by = [c for c in docs.columns if c != "text"]        # a text is looked up by its id and hash: ids may repeat or be null
    sk = materialise(docs.select(*by, sketch(F.col("text"), width).alias("s")).select(*by, "s.*"), "sketch")
    nodes = materialise(sk.where("n > 0").groupBy("sig").agg(
        F.first("n").alias("n"), F.first("regs").alias("regs"), F.min(F.struct(F.col("id").isNull().alias("no_id"), *by)).alias("rep")), "nodes")

    bands = nodes.select("sig", F.explode(keys_of(F.col("regs"), rows)).alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    members = materialise(bands.join(shared.hint("merge"), "key"), "members")
    score = members.groupBy("sig").agg(F.sum(F.log2("c")).alias("score"))
    scored = members.join(score.hint("merge"), "sig")
    centres = scored.groupBy("key").agg(F.max(F.struct("score", "sig")).alias("top")).select("key", F.col("top.sig").alias("centre"))
    edges = materialise(members.select("key", "sig").join(centres.hint("merge"), "key").where("sig != centre")
                        .select("centre", "sig").distinct(), "edges")

    # full sets of the nodes that have a candidate, from one text each
    wanted = (edges.select("sig").union(edges.select(F.col("centre").alias("sig"))).distinct()
              .join(nodes.select("sig", F.col("rep.mark").alias("mark"), F.col("rep.id").alias("at")), "sig"))
    texts = docs.join(wanted.hint("merge"), (docs["mark"] == wanted["mark"]) & F.col("id").eqNullSafe(F.col("at"))).select("sig", signed_set(F.col("text"), width).alias("s"))
    sets = materialise(texts.where(F.col("s.sig") == F.col("sig")).select("sig", F.col("s.items").alias("items"))
                       .dropDuplicates(["sig"]), "sets")

    def compare(batches):
        for b in batches:
            sets_x = _lists(b.column("x_items"))
            out = [difference(c, x, percent) for c, x in zip(_lists(b.column("c_items")), sets_x)]
            yield pa.RecordBatch.from_arrays(
                [b.column("centre"), b.column("sig"), pa.array([o[0] for o in out], pa.bool_()), pa.array([len(x) for x in sets_x], pa.int64()),
                 pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()), _pack([o[3] for o in out])],
                ["centre", "sig", "linked", "n", "looks", "shows", "items"])

    sets_of = lambda name, items: sets.select(F.col("sig").alias(name), F.col("items").alias(items)).hint("merge")
    star = materialise(edges.join(sets_of("sig", "x_items"), "sig").join(sets_of("centre", "c_items"), "centre")
                       .select("centre", "sig", "c_items", "x_items")
                       .mapInArrow(compare, "centre binary, sig binary, linked boolean, n long, looks long, shows long, items array<long>"), "star")
    label = _labels(star.where("linked").select(F.col("centre").alias("a"), F.col("sig").alias("b")))
    start = _labelled(_labelled(star, label, "sig", "root"), label, "centre", "centre_root").withColumn("out", F.col("root") != F.col("centre_root"))
    # differences around centres with an unlinked member, rare items first: those that nobody
    # shares with an unlinked member come before all others and need no row
    open_ = start.where("out").select("centre").distinct()
    spread = (start.join(open_.hint("merge"), "centre", "left_semi")
              .select("centre", "sig", "root", "n", "out", "looks", "shows", F.size("items").alias("d"), F.explode("items").alias("item")))
    often = spread.groupBy("centre", "item").agg(F.count("*").alias("c"), F.max("out").alias("any_out")).where("c > 1 and any_out").drop("any_out")
    mine = Window.partitionBy("centre", "sig")
    ranked = spread.join(often.hint("merge"), ["centre", "item"]).withColumn(
        "p", F.col("d") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("c", "item")) - 1)
    look, show = F.col("out") & (F.col("p") < F.col("looks")), F.col("p") < F.col("shows")
    ranked = ranked.select("centre", "item", "sig", "root", "n", "d", "p", look.alias("look"), show.alias("show")).where("look or show")
    found = materialise(ranked, "found")

    def linked(pairs):
        """The pairs (a, b) that are linked, confirmed on full sets."""
        return (pairs.join(sets_of("a", "a_items"), "a").join(sets_of("b", "b_items"), "b").select("a", "b", "a_items", "b_items")
                .mapInArrow(confirm, "a binary, b binary"))

    def confirm(batches):
        for b in batches:
            ok = [similar(int(common(x, y).sum()), len(x), len(y), percent)
                  for x, y in zip(_lists(b.column("a_items")), _lists(b.column("b_items")))]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    # whether two rows of an item may be linked and share it as their first: from it on enough of both differences must be left
    left = F.least(F.col("d1") - F.col("p1"), F.col("d2") - F.col("p2"))
    enough = 2 * left >= F.col("d1") + F.col("d2") - slack(percent) * (F.col("n1") + F.col("n2")) - 1e-9
    sizes = (100 * F.col("n1") >= percent * F.col("n2")) & (100 * F.col("n2") >= percent * F.col("n1"))
    part = ("sig", "root", "n", "d", "p")

    side = lambda rows, k: rows.select("centre", "item", *(F.col(c).alias(c + k) for c in part))
    x, y = side(found.where("look"), "1").alias("x"), side(found.where("show"), "2").alias("y")
    pairs = (x.join(y.hint("merge"), (F.col("x.centre") == F.col("y.centre")) & (F.col("x.item") == F.col("y.item"))
                    & (F.col("root1") != F.col("root2")) & sizes & enough)
             .select(F.least("sig1", "sig2").alias("a"), F.greatest("sig1", "sig2").alias("b")).distinct())
    regs = lambda name, n, r: nodes.select(F.col("sig").alias(name), F.col("n").alias(n), F.col("regs").alias(r)).hint("merge")

    def near(batches):
        for b in batches:
            r1, r2 = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, M) for c in ("r1", "r2"))
            n1, n2 = b.column("n1").to_numpy(), b.column("n2").to_numpy()
            est = estimate((r1 == r2).sum(axis=1), n1, n2)
            yield b.select(["a", "b"]).filter(pa.array(est >= least_estimate(threshold, np.minimum(n1, n2))))

    likely = pairs.join(regs("a", "n1", "r1"), "a").join(regs("b", "n2", "r2"), "b").mapInArrow(near, "a binary, b binary")
    label = _merged(label, linked(likely))
    grouped = _labelled(nodes.select("sig", "rep"), label, "sig", "top")
    return sk, grouped.select("sig", "rep", "top")


def _labels(links: DataFrame) -> DataFrame:
    return materialise(components(links), "labels")


def _labelled(df: DataFrame, label: DataFrame, name: str, out: str) -> DataFrame:
    """``df`` with the root of the component of the node ``name``; a node without links is its own."""
    return (df.join(label.select(F.col("node").alias(name), F.col("root").alias(out)).hint("merge"), name, "left")
            .withColumn(out, F.coalesce(out, name)))


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links (a, b): components of the roots, then of their nodes."""
    more = materialise(_labelled(_labelled(links, label, "a", "ra"), label, "b", "rb").select("ra", "rb").distinct(), "more")
    if more.isEmpty():
        return label
    tops = components(more.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    moved = label.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")).hint("merge"), "root", "left")
    lone = tops.join(label.select("node").hint("merge"), "node", "left_anti")
    return materialise(moved.select("node", F.coalesce("top", "root").alias("root")).union(lone.select("node", "root")), "labels")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``df``. Texts are
    linked when 100 * intersection >= percent * union of their shingle sets."""
    sk, grouped = _groups(df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")), width, percent)
    least = grouped.groupBy("top").agg(F.min("rep").alias("least"))
    where = grouped.join(least.hint("merge"), "top").select("sig", F.col("least.id").alias("component_id"))
    out = sk.select("id", "n", "sig").join(where.hint("merge"), "sig", "left")
    # an empty set is a component of its own
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group, that of the least id (null after all others),
    with the columns of ``df``; documents without words stay. Ids may repeat,
    so rows get a key of their own, written with them."""
    key = free_name(df, "row_key")
    rows = materialise(df.withColumn(key, F.monotonically_increasing_id()), "rows")
    sk, grouped = _groups(rows.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), F.col(key).alias("row")), width, percent)
    kept = (grouped.groupBy("top").agg(F.min("rep").alias("rep")).select(F.col("rep.row").alias(key))
            .union(sk.where("n = 0").select(F.col("row").alias(key))))
    return rows.join(kept.hint("merge"), key, "left_semi").drop(key)

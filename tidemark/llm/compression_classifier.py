"""Quality classifier by compression (operator 12).

Two zstandard dictionaries are trained, one on chunks of good and one on
chunks of bad labelled documents. A text is cut into chunks of ``CHUNK`` bytes
(so that the dictionary, not the text itself, decides) and every chunk is
compressed with both. The normalised difference of the two sizes,
(bad - good) / (bad + good), says which side a text is closer to; the log
ratio of the text to its size under the good dictionary tells text that packs
too well or hardly at all. A logistic curve over both (with their squares and
product) turns them into a probability of label 1; it is fitted on labelled
documents that the dictionaries have not seen and weighted to the class shares
of all labels.

Learning reads a bounded sample of the labelled rows: about ``PER_CLASS``
documents a class, drawn by a hash of their id, one half for the dictionaries
(about ``CHUNKS`` chunks a class of their whole texts), the other for the
curve. Labels are counted over all rows.

Defined cases: a null or empty text has no evidence, its score is the share of
label 1 among the labels; so is every score when a class has no labelled
document, and 0.5 without any label; documents with contradicting, null or
other labels teach nothing; of rows with one id the least text is learned
from; very long texts are read whole, chunk by chunk; repeated rows get equal
scores; an empty table gives an empty table; other columns pass through,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .frames import discard, materialise

PER_CLASS = 4000        # documents sampled from each class
CHUNKS = 4000           # chunks a dictionary is trained on
CHUNK = 1024            # bytes
DICTIONARY = 1 << 16    # bytes of a dictionary
LEVEL = 3
THRESHOLD = 0.3
RIDGE = 0.1
NEWTON_STEPS = 50


@dataclass(frozen=True)
class Model:
    """``share``: share of label 1; the rest is None without both classes.
    ``middle``, ``spread``, ``low``, ``high`` scale and clip the terms."""
    share: float
    good: bytes | None = None
    bad: bytes | None = None
    middle: np.ndarray | None = None
    spread: np.ndarray | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    weights: np.ndarray | None = None


def dictionary(chunks: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary, or the chunks themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, chunks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chunks)[-size:]


def compressor(content: bytes, level: int = LEVEL) -> zstandard.ZstdCompressor:
    """Bare frames: no magic number, size, checksum or dictionary id."""
    params = zstandard.ZstdCompressionParameters.from_level(
        level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False, write_checksum=False)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(content))


def sizes(raw: memoryview, good, bad, chunk: int = CHUNK) -> tuple[int, int]:
    g = b = 0
    for at in range(0, len(raw), chunk):
        part = raw[at:at + chunk]
        g += len(good.compress(part))
        b += len(bad.compress(part))
    return g, b


def terms(n: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """The two measures of texts of ``n`` bytes, their squares and their product."""
    d = (bad - good) / np.maximum(bad + good, 1)
    r = np.log(np.maximum(n, 1) / np.maximum(good, 1))
    return np.stack([d, r, d * d, r * r, d * r], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Weighted logistic regression with a small ridge (it also holds the
    weights where the classes are separable), by damped Newton steps."""
    low, high = x.min(axis=0), x.max(axis=0)
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - middle) / spread])
    w = np.zeros(z.shape[1])
    hold = np.full(len(w), RIDGE)
    hold[0] = 0.0

    def loss(w):
        m = z @ w
        return float(weight @ (np.logaddexp(0, m) - y * m) + hold @ (w * w) / 2)

    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (y - p)) - hold * w
        curve = (z * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + np.diag(hold)
        step = np.linalg.solve(curve, slope)
        at = loss(w)
        while np.abs(step).max() > 1e-10 and loss(w + step) > at:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return middle, spread, low, high, w


def probability(model: Model, x: np.ndarray) -> np.ndarray:
    z = (np.clip(x, model.low, model.high) - model.middle) / model.spread
    return 1 / (1 + np.exp(-np.clip(model.weights[0] + z @ model.weights[1:], -30, 30)))


def _measured(column: pa.Array, good, bad) -> np.ndarray:
    """(bytes, size under good, size under bad) per row."""
    raw, offsets = T.buffers(column)
    view, out = memoryview(raw), np.zeros((len(column), 3))
    for i in range(len(column)):
        part = view[offsets[i]:offsets[i + 1]]
        out[i] = len(part), *sizes(part, good, bad)
    return out


def labelled(labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> DataFrame:
    """(id, label): one row per document with one clear label."""
    return (labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("id"))
            .agg(F.min(label).alias("label"), F.max(label).alias("other")).where("label = other").select("id", "label"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
          per_class: int = PER_CLASS, chunks: int = CHUNKS) -> Model:
    """The model learned from ``labels``. What reaches the driver is bounded by
    ``chunks`` chunks and ``per_class`` rows of numbers a class."""
    known = materialise(labelled(labels, id_col, label), "labels")
    n = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    total = sum(n.values())
    if len(n) < 2:
        return Model(n.get(1, 0) / total if total else 0.5)
    share = F.when(F.col("label") == 1, min(1.0, per_class / n[1])).otherwise(min(1.0, per_class / n[0]))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    half = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("half")), F.lit(2))
    # at most about per_class ids a class: a bounded broadcast
    chosen = F.broadcast(known.where(draw < share).select("id", "label", half.alias("half")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where("text != ''")
    sample = materialise(texts.join(chosen, "id").groupBy("id", "label", "half").agg(F.min("text").alias("text")), "sample")

    seen = sample.where("half = 0")
    parts = {r[0]: r[1] for r in seen.groupBy("label").agg(F.sum(F.ceil(F.octet_length("text") / CHUNK))).collect()}
    rest = {r[0]: r[1] for r in sample.where("half = 1").groupBy("label").count().collect()}
    if len(parts) < 2 or len(rest) < 2:
        return Model(n[1] / total)
    keep = {k: min(1.0, chunks / v) for k, v in parts.items()}

    def cut(batches):
        for b in batches:
            out = []
            for i, k, t in zip(*(b.column(c).to_pylist() for c in ("id", "label", "text"))):
                raw = t.encode("utf-8", "replace")
                out += [(k, raw[at:at + CHUNK]) for at in range(0, len(raw), CHUNK)
                        if crc32(f"{i}:{at}".encode()) < keep[k] * (1 << 32)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["label", "chunk"])

    drawn = sorted((r[0], bytes(r[1])) for r in seen.select(F.col("id").cast("string"), F.col("label").cast("int"), "text").mapInArrow(cut, "label int, chunk binary").collect())
    good, bad = (dictionary([c for k, c in drawn if k == one]) for one in (1, 0))

    def measure(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        g, b = compressor(good), compressor(bad)
        for column in it:
            yield pa.array(list(_measured(column, g, b)), pa.list_(pa.float64()))
    points = sample.where("half = 1").select("label", F.arrow_udf(measure, "array<double>").asNondeterministic()(F.col("text")).alias("m")).collect()
    points = sorted((r["label"], *r["m"]) for r in points)
    y, m = np.array([p[0] for p in points], float), np.array([p[1:] for p in points])
    weight = np.where(y == 1, n[1] / rest[1], n[0] / rest[0])
    curve = fit_curve(terms(*m.T), y, weight * len(y) / weight.sum())
    discard(known)
    discard(sample)
    return Model(n[1] / total, good, bad, *curve)


def score(text: Column, model: Model) -> Column:
    """The probability of label 1. The model (two dictionaries and a dozen
    numbers) travels with the function."""
    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        g = b = None
        for column in it:
            out = np.full(len(column), model.share)
            if model.good is not None and len(column):
                g, b = g or compressor(model.good), b or compressor(model.bad)
                m = _measured(column, g, b)
                some = m[:, 0] > 0
                out[some] = probability(model, terms(*m[some].T))
            yield pa.array(out)
    run.__annotations__ = {"it": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double").asNondeterministic()(text)


def held_out(key: Column) -> Column:
    """Rows whose labels nothing is learned from (rows without an id among them)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))

import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from conftest import SF_CHECK
from tidemark.llm import compression_classifier as C


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    model = C.train(docs, labels.where(~C.held_out(F.col("doc_id"))))
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", C.score(F.col("text"), model).alias("s")).collect()}
    assert len(got) == docs.count() and all(0 <= s <= 1 for s in got.values())
    held = {r["doc_id"]: r["quality"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert np.mean([got[i] >= C.THRESHOLD for i, q in held.items() if q == 1]) >= 0.97
    assert np.mean([got[i] < C.THRESHOLD for i, q in held.items() if q == 0]) >= 0.7


def test_sizes_are_those_of_whole_texts_chunk_by_chunk(spark):
    good, bad = C.dictionary([b"fair prose and so on " * 9] * 3), C.dictionary([b"## junk %% " * 20] * 3)
    text = ("fair prose " * 500 + "## junk " * 300).encode()
    g, b = C.compressor(good), C.compressor(bad)
    want = [sum(len(c.compress(text[i:i + C.CHUNK])) for i in range(0, len(text), C.CHUNK)) for c in (g, b)]
    assert list(C.sizes(memoryview(text), g, b)) == want
    back = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(good), format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    assert back.decompress(g.compress(text[:100]), max_output_size=1000) == text[:100]


def test_curve_is_calibrated():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 2))
    p = 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))
    y = (rng.random(4000) < p).astype(float)
    middle, spread, low, high, w = C.fit_curve(x, y, np.ones(4000))
    got = C.probability(C.Model(0.5, b"", b"", middle, spread, low, high, w), x)
    assert abs(got.mean() - y.mean()) < 1e-3 and np.abs(got - p).max() < 0.08


def test_defined_cases(spark):
    words = ["plain words of a calm text", "more calm words in a row", "a text of plain words"]
    good = [(i, " ".join(words[(i + k) % 3] for k in range(30)) + str(i)) for i in range(40)]
    bad = [(100 + i, "$$ %% ## " * (20 + i)) for i in range(40)]
    schema = "doc_id long, text string, label string, score double"
    odd = [(None, None), (7, ""), (300, words[0] * 20_000), (301, "$$ %% ## " * 40_000), (5, good[5][1]), (5, good[5][1])]
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in good + bad + odd], schema)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(3, 0), (9, None), (10, 7), (None, 1), (11, 1)],
                                   "doc_id long, quality int")
    assert {r["id"] for r in C.labelled(labels).collect()} & {3, 9, 10, 11} == {9, 10, 11}
    model = C.train(docs, labels)
    rows = docs.withColumn("s", C.score(F.col("text"), model)).collect()
    assert len(rows) == docs.count() and rows[0]["score"] == 1.0
    s = {r["doc_id"]: r["s"] for r in rows}
    assert s[None] == model.share and s[300] > 0.9 and s[301] < 0.1
    assert len({r["s"] for r in rows if r["doc_id"] == 5}) == 1
    assert all(s[i] > 0.5 for i, _ in good if i != 7) and all(s[i] < 0.5 for i, _ in bad)
    # no labels, one class, empty tables
    assert C.train(docs, labels.limit(0)).share == 0.5
    assert C.train(docs, labels.where("quality = 1")).share == 1.0
    none = C.train(docs.limit(0), labels)
    assert none.good is None and docs.select(C.score(F.col("text"), none).alias("s")).distinct().count() == 1
    assert docs.limit(0).select(C.score(F.col("text"), model).alias("s")).collect() == []

"""The pipeline against a brute-force version of every stage's decision."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as C
from tidemark.llm.language import held_out, identify, train
from tidemark.llm.quality import Bands, measure

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def near_duplicate_ids(docs, width, percent):
    sets, by = {}, {}
    for d, t in docs.items():
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
        sets[d] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
        for x in sets[d]:
            by.setdefault(x, []).append(d)
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    for a, b in {(a, b) for g in by.values() for a in g for b in g if a < b}:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {d for d in docs if find(d) == d}


def mix_copies(docs):
    """{doc_id: copies} of {doc_id: (text, source)}: closed-form water level."""
    size = {d: len(WORD.findall(t or "")) for d, (t, _) in docs.items()}
    sources = sorted({s for _, s in docs.values()})
    total = {s: sum(size[d] for d in docs if docs[d][1] == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    want, open_, target = 1.5 * sum(total.values()), sum(weight.values()), {}
    for s in sorted(sources, key=lambda s: total[s] / weight[s]):
        if weight[s] * want / open_ > 2 * total[s]:
            target[s] = 2.0 * total[s]
            want, open_ = want - 2 * total[s], open_ - weight[s]
        else:
            target[s] = weight[s] * want / open_
    out = {}
    for s in sources:
        whole, at = math.floor(target[s] / total[s]) if total[s] else 0, 0
        for d in sorted((d for d in docs if docs[d][1] == s), key=lambda d: hashlib.md5(f"17:{d}".encode()).hexdigest()):
            out[d] = whole + (at + size[d] / 2 <= target[s] - whole * total[s])
            at += size[d]
    return out


def test_pipeline_matches_brute_force(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    import pyarrow as pa
    verdicts = measure(pa.array([r["text"] for r in rows]), Bands()).field("kept").to_pylist()
    rows = [r for r, k in zip(rows, verdicts) if k]
    good = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"]) for r in rows], "doc_id long, text string, lang string")
    langs, table = train(good.where(~held_out(F.col("doc_id"))))
    rows = [r for r in rows if (p := identify([r["text"]], langs, table).to_pylist()[0])["lang"] != "und" and p["score"] >= 0.4]
    keep = near_duplicate_ids({r["doc_id"]: r["text"] for r in rows}, 5, 80)
    docs = {r["doc_id"]: (r["text"], r["source"]) for r in rows if r["doc_id"] in keep}
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter()
    for d, n in mix_copies(docs).items():
        if n:
            ids = lib.encode(docs[d][0])
            want[d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += n
    got = C.run(spark, SF).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert all(r.round_trip and len(r.ids) == r.n_tokens for r in got)


def test_stages_keep_the_columns_and_bear_awkward_rows(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(None, "null id here", None, None, None), (7, None, "en", "src1", 0), (8, "", None, None, 0), (0, "dup id", "en", None, 1)], base.schema)
    docs = base.union(odd)
    for c in ("quality", "language", "mix", "copy", "row", "sig", "kept_id", "size", "n"):
        docs = docs.withColumn(c, F.lit(1))
    names = docs.columns
    for name, stage in C.STAGES:
        docs = C.materialise(stage(spark, docs, SF), "t")
        assert name == "pieces" or docs.columns == names
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0

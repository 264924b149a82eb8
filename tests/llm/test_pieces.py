"""The transducer against the sentencepiece library and brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidemark.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
SF = "/root/testdata/sf0.001"


def random_texts():
    rnd = random.Random(11)
    parts = [" ", "  ", "   ", "\n", "\t", "the", "Straße", "été", "12", "...", "▁", "日本語", "🙂", "\x00", "é", "ingly", "zxqj", " " * 35,
             "​", "<s>", "<0x41>", "aaaaaaaa", "ſ"]
    return ["", " ", "  ", "\n"] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30))) for _ in range(1500)]


def test_random_texts_match_library():
    t = P.transducer(PATH)
    for x in random_texts():
        ids = t.encode(x).tolist()
        assert ids == LIB.encode(x), repr(x)
        assert t.decode(ids) == LIB.decode(ids), repr(x)
    assert t.decode(list(range(3, 259))) == LIB.decode(list(range(3, 259)))


def test_documents_match_library(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    from tidemark.llm import queries as Q
    got = Q.REGISTRY["op4_pieces"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = LIB.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_crc32, r.round_trip) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)


def test_awkward_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "x" * 200_000, 5), (4, "a  b", 5), (4, "a  b", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in df.select("doc_id", P.digest(F.col("text"), PATH).alias("d"), P.encode(F.col("text"), PATH).alias("ids"))
           .select("*", P.decode(F.col("ids"), PATH).alias("back")).collect()}
    assert got[1].d.n_tokens == got[2].d.n_tokens == 0 and got[1].ids is None and got[2].ids == []
    assert got[3].ids == LIB.encode("x" * 200_000) and got[3].back == "x" * 200_000 and got[4].back == "a  b"
    assert df.limit(0).select(P.digest(F.col("text"), PATH)).count() == 0


def test_unigram_weights_take_the_least_path():
    texts = ["▁a", "▁ab", "b", "bc", "c", "abc", "▁", "a", "ca"]
    scores = [-2.0, -2.5, -1.5, -1.0, -2.2, -4.0, -3.0, -1.1, -0.4]
    model = [("<unk>", 0.0, 2)] + [(t, s, 1) for t, s in zip(texts, scores)]
    t = P.Transducer(model, P.UNIGRAM, byte_fallback=False)
    weight = dict(zip(texts, scores))
    for n in range(1, 7):
        for word in itertools.product("abc", repeat=n):
            s = "▁" + "".join(word)
            best = min(-sum(weight[s[i:j]] for i, j in zip((0, *cuts), (*cuts, len(s))))
                       for k in range(len(s)) for cuts in itertools.combinations(range(1, len(s)), k)
                       if all(s[i:j] in weight for i, j in zip((0, *cuts), (*cuts, len(s)))))
            assert -sum(t.scores[i] for i in t.encode("".join(word))) == pytest.approx(best)

"""Token files: exact round trips of the codec, the files and the tokenizer."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import rans
from tidemark.llm.frames import scratch
from tidemark.llm.token_files import encoder, read_token_files, token_files, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n", [1, 2, 255, 1000, 300_000])
def test_codec_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 40_000).astype(np.int64)
    table = rans.Table.of(rans.frequencies(np.bincount(ids, minlength=50_000)))
    block = rans.encode(ids, table)
    assert (rans.decode(block, table) == ids).all()
    last = len(block["word_at"]) - 1
    lo = last * rans.EVERY * block["lanes"]
    assert (rans.decode_segment(block, last, table) == ids[lo:]).all()
    if n > 1000:
        p = np.bincount(ids) / n
        bits = -(p[p > 0] * np.log2(p[p > 0])).sum() * n
        assert len(block["words"]) * 8 < 1.02 * bits + 4096
        block["words"] = block["words"][:40] + bytes([block["words"][40] ^ 1]) + block["words"][41:]
        with pytest.raises(ValueError):
            rans.decode(block, table)


def test_crc_join():
    a, b = b"hello " * 9, b"world!" * 1000
    assert rans.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def texts():
    rnd = random.Random(9)
    parts = ["Word", "the", "Ünï", "it's", "123", "...", "<|endoftext|>", "\x1c", " ", "日本", "́", "Σ", "\n", "İ"]
    return ["".join(rnd.choice(parts) + rnd.choice([" ", "", "\n", "  "]) for _ in range(rnd.randint(1, 50))) for _ in range(300)]


def test_words_match_library():
    ids = encoder(PATH, True, 1)
    for t in texts() + ["", " ", "\n"]:
        want = LIB.encode(t, add_special_tokens=False).ids + [1]
        assert np.frombuffer(ids(t), "<u2").tolist() == want, repr(t)


def test_files_round_trip(spark):
    rows = list(enumerate(texts())) + [(7, "again"), (7, "again"), (None, "no id"), (500, None), (501, ""), (502, "long text " * 900)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start int").repartition(5)
    out = scratch(spark, "t")
    write_token_files(df, PATH, out, by_words=True, block=700)
    got = read_token_files(spark, out, with_ids=True).collect()
    got.sort(key=lambda r: r.start)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    for r, (i, t) in zip(got, want, strict=True):
        ids = LIB.encode(t or "", add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_files(df.limit(0), PATH, by_words=True).count() == 0

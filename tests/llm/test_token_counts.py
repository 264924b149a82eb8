"""Token counts against the library on whole texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.token_counts import counter, cut, splice, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def lib(text):
    return len(LIB.encode(text or "", add_special_tokens=False))


def texts():
    rnd = random.Random(5)
    parts = [" ", "  ", "\n", "\n ", " \n", "\t", "word", "Wörter", "é", "123", "it's", "'ll", "...", "<|endoftext|>",
             "<|endof", "text|>", " ", "\x1c", "日本", "🙂", "a" * 40, "́", "ſ", " "]
    out = [None, "", " ", "  ", "a ", " a", "a\n b", "a \n b", "a  b", "a\n", "x<|endoftext|> y"]
    out += ["".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(1, 60))) for _ in range(400)]
    return out


def test_units_match_library():
    count = counter(PATH)
    for _ in range(2):   # second time from memory
        for t in texts():
            assert count(t) == lib(t), repr(t)


@pytest.mark.parametrize("chunk,overlap", [(200, 70), (500, 100), (90, 80)])
def test_chunks_splice_to_whole(spark, chunk, overlap):
    rnd = random.Random(chunk)
    vocab = ["the", "Übung", "naïve", "12", "...", "can't", "<|endoftext|>", "\n", "  ", "extraordinarily", "日本語"]
    rows = [(i, "".join(rnd.choice(vocab) + rnd.choice([" ", "", "\n"]) for _ in range(rnd.randint(1, 400)))) for i in range(25)]
    rows += [(100, "x" * 3000), (101, None), (102, ""), (103, "q" * 1000 + " end " + "r" * 1500), (104, "a b " * 400),
             (104, "a b " * 400), (None, "null id " * 200), (105, " " * 2500)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts(df, PATH, chunk=chunk, overlap=overlap).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), lib(t)) for i, t in rows), key=str)
    assert token_counts(df.limit(0), PATH).count() == 0


def test_cut_covers_and_widening_needed():
    assert [b for _, _, b in cut("x" * 10, 4, 2)][-1] == 10
    assert splice([{"n": 3, "start": 0, "stop": 100, "head_at": [0], "head_k": [0], "tail_at": [], "tail_k": []},
                   {"n": 3, "start": 50, "stop": 150, "head_at": [50], "head_k": [0], "tail_at": [], "tail_k": []}]) is None

"""Letter runs shared between words, against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tidemark.llm import token_files as TF

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
KIND = TF.id_type(PATH)


def random_words(n=6000):
    rnd = random.Random(12)
    parts = ["on", "Th", "ER", "ing", "é", "É", "ß", "Ü", "ÿ", "×", "÷", "µ", "ª", "İ", "ſ", "K", "ж", "日", "😀", "1", "42", "'", "'s", "'LL", "’",
             ".", ",", "...", "%%%", "_", "-", "(", ")", "<", "=", "é", "́", "̸", "J̌", "​", "\x00", "x@y.z", "Σ", "ς"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 6))) for _ in range(n)]


def library(text):
    return LIB.encode(text, add_special_tokens=False).ids


def test_random_words_match_library():
    words = random_words()
    ids = TF.encoder(PATH, True, 1)
    for a in range(0, len(words), 20):
        text = " ".join(words[a:a + 20])
        assert np.frombuffer(ids(text), KIND).tolist() == library(text) + [1], repr(text)


def test_words_share_their_letter_runs(monkeypatch):
    """Capitals and signs do not send a run of letters to the library again."""
    memo = TF.WordMemo(Tokenizer.from_file(PATH), KIND)
    runs, rest = [], []
    for name, seen in (("_runs", runs), ("_whole", rest)):
        f = getattr(memo, name)
        monkeypatch.setattr(memo, name, lambda units, f=f, seen=seen: seen.extend(units) or f(units))
    for text in ("thornder, Thornder.", "THORNDER thornder. thornder%%%", "thornder don't"):
        assert b"".join(memo.values(text.split())) == np.array(library(text), KIND).tobytes()
    assert runs == ["thornder"] and sorted(rest) == ["%%%", ",", ".", "don't"]


def test_bounded_and_long_words():
    memo = TF.WordMemo(Tokenizer.from_file(PATH), KIND, capacity=40)
    words = random_words(1500) + ["x" * 500 + ".", "x" * 500, "Y" * 300 + "..." + "z" * 300]
    for a in range(0, len(words), 10):
        some = words[a:a + 10]
        assert b"".join(memo.values(some)) == np.array(library(" ".join(some)), KIND).tobytes()
        assert len(memo.young) <= 20 and not any(len(w) > 96 for w in (*memo.young, *memo.old))


def test_other_tokenizers_get_whole_words():
    t = Tokenizer(models.BPE(vocab={"A": 0, "a": 1, ".": 2, "a.": 3}, merges=[("a", ".")]))
    t.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    memo = TF.WordMemo(t, np.dtype("<u2"))
    assert memo.plain is None
    assert np.frombuffer(b"".join(memo.values(["a.", "A", "a"])), "<u2").tolist() == [3, 0, 1]


@pytest.mark.parametrize("sizes", [[0], [3, 0, 700], [1] * 1100])
def test_counts_of_ids(spark, sizes):
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, 50, n).astype("<u2") for n in sizes]
    df = spark.createDataFrame([(bytearray(r.tobytes()),) for r in rows], "ids binary")
    assert TF.count_ids(df, np.dtype("<u2"), 60).tolist() == np.bincount(np.concatenate(rows), minlength=60).tolist()


def test_a_column_looks_each_word_up_once(monkeypatch):
    """Texts are looked up together: a word that comes again costs no lookup."""
    TF.column_encoder.cache_clear()
    seen, f = [], TF.WordMemo._values
    monkeypatch.setattr(TF.WordMemo, "_values", lambda self, units, encode: seen.extend(units) or f(self, units, encode))
    texts = ["the thornder, the THORNDER.", "thornder. the", None, "the thornder"] * 50
    ids = TF.column_encoder(PATH, True, 1)(pa.array(texts))
    assert [np.frombuffer(x, KIND).tolist() for x in ids.to_pylist()] == [library(t or "") + [1] for t in texts]
    assert sorted(seen) == ["", "", ",", ".", "the", "thornder"]   # no run, no rest


@pytest.mark.parametrize("by_words", [True, False])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_columns_match_library(by_words, kind):
    """Null, empty and blank texts, odd white space and special strings between plain texts; slices too."""
    words, rnd = random_words(2000), random.Random(3)
    texts = [None, "", " ", "\n\t", "a\x1cb", "x<|endoftext|>y", "<|STARTOFTEXT|> a", "\u00a0a\u2003b\x85c ", " lead", "trail "]
    texts += [rnd.choice(" \n").join(words[i:i + 15]) for i in range(0, 2000, 15)]
    texts += [None, "a\x1fB", "", "end"]
    ids = TF.column_encoder(PATH, by_words, 1)
    want = [library(t or "") + [1] for t in texts]
    b = pa.RecordBatch.from_arrays([pa.array(["cut", *texts], kind)], ["text"]).slice(1)
    for size in (1, 200, 1 << 23):
        parts = list(TF.slices(b, "text", size))
        got = [np.frombuffer(x, KIND).tolist() for c in parts for x in ids(c.column("text")).to_pylist()]
        assert got == want
    assert len(parts) == 1 and not list(TF.slices(b.slice(0, 0), "text"))


def test_arrow_splits_where_python_does():
    """At the library's white space and at the four signs that go to it whole."""
    signs = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    split = pc.list_value_length(pc.utf8_split_whitespace(pa.array([f"a{x}b" for x in signs]))).to_numpy()
    assert [x for x, n in zip(signs, split) if n != 1] == [x for x in signs if x.isspace()]


def test_runs_without_an_end_of_word():
    """Runs are told apart by the library's word numbers where no id marks their end."""
    t = Tokenizer(models.BPE(vocab={"a": 0, "b": 1, "ab": 2}, merges=[("a", "b")]))
    t.normalizer, t.pre_tokenizer = LIB.normalizer, LIB.pre_tokenizer
    memo = TF.WordMemo(t, np.dtype("<u2"))
    assert [np.frombuffer(x, "<u2").tolist() for x in memo.values(["AB", "ba", "abab"])] == [[2], [1, 0], [2, 2]]

"""The path of weight 0: depth first, with replayed merge histories."""

import random

import numpy as np
import public_tokenizers
import sentencepiece

from tidemark.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)


def invented(n, seed=7):
    rnd = random.Random(seed)
    parts = ["on", "th", "er", "ing", "an", "re", "ti", "he", "ou", "nd", "é", "ß", "x", ".", "%%%", "日", "🙂"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 7))) for _ in range(n)]


def test_unseen_words_need_few_merges():
    """Merging is replayed from the pieces' own histories: at most one a piece,
    however many pairs are weighed."""
    t = P.Transducer(**P.read_model(PATH))
    calls = 0
    merged = t.merged

    def counted(*a):
        nonlocal calls
        calls += 1
        return merged(*a)
    t.merged = counted
    words = invented(4000)
    for w in words:
        assert t.encode(w).tolist() == LIB.encode(w), w
    assert len(t.pairs) > calls and calls == len(t.histories)


def test_replayed_histories_give_what_merging_gives():
    t = P.Transducer(**P.read_model(PATH))
    rnd = random.Random(9)
    arcs = list(t.arcs.values())
    for w in invented(1500, 8):
        t.encode(w)
    pairs = [((k >> 32) - 1, k & 0xffffffff) for k in t.pairs if k >> 32] + [(rnd.choice(arcs), rnd.choice(arcs)) for _ in range(1500)]
    both = [t.texts[a] + t.texts[b] for a, b in pairs]
    want = [t.merged(x) == [t.texts[a], t.texts[b]] for (a, b), x in zip(pairs, both)]
    assert [t.apart(a, b) for a, b in pairs] == want and 100 < sum(want) < len(want) - 100


def brute(t, text):
    """Merges over the whole text, characters without a piece as their fallback."""
    return [x for s in t.merged(text) for x in ([t.arcs[s]] if s in t.arcs else t.fallback(s))]


def test_any_scores():
    """Equal scores, scores that do not fall with length, pieces that merging never makes."""
    rnd = random.Random(3)
    for _ in range(60):
        texts = list("abc") + list({"".join(rnd.choice("abc") for _ in range(rnd.randint(2, 4))) for _ in range(12)})
        model = [("<unk>", 0.0, 2)] + [(x, float(-rnd.randint(0, 6)), 1) for x in texts]
        t = P.Transducer(model, P.BPE, byte_fallback=False, dummy_prefix=False)
        for _ in range(60):
            x = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 12)))
            assert t.merge_path(x) == brute(t, x), (model, x)


def test_long_units():
    t = P.transducer(PATH)
    for x in ("ab" * 50_000, "q" * 30_001, "é" * 20_000, "🙂" * 5_000):
        assert t.encode(x).tolist() == LIB.encode(x)
    assert np.array_equal(t.encode(""), np.zeros(0, t.id_type))

import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import collocations as C
from tidemark.llm import quotient as Q


def brute(rows, least=10, top=2000):
    f, n = Counter(), Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            lang_ = "und" if lang is None else lang
            n[lang_] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    f[lang_, tuple(w[i:i + size])] += 1
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        cuts = [(10 ** 6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        s, k = min(cuts)
        out[lang, p] = (a, f[lang, p[:k]], f[lang, p[k:]], s)
    inside = {}
    for (lang, p), (a, *_) in out.items():
        if len(p) == 3:
            for q in (p[:2], p[1:]):
                inside[lang, q] = max(inside.get((lang, q), 0), a)
    rows = [(lang, " ".join(p), *v) for (lang, p), v in out.items() if 100 * inside.get((lang, p), 0) < 50 * v[0]]
    got = []
    for lang in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[5], -r[2], r[1].encode()))
        got += [(lang, i + 1, r[1], *r[2:5], n[lang], r[5]) for i, r in enumerate(mine[:top])]
    return sorted(got)


def corpus():
    rng = np.random.default_rng(3)
    words = ["Of", "the", "a", "Sun", "moon's", "É", "x1", "über", "new", "york", "city", "-", "#", "　", "ab c"]
    weight = 1 / np.arange(1, len(words) + 1)
    gaps = [" ", "  ", "\t", ". ", ",", "\n", " ; ", "\x0b", "\r\n", "?!"]
    rows = []
    for i in range(150):
        k = int(rng.integers(0, 60))
        picked = rng.choice(words, k, p=weight / weight.sum())
        text = "".join(w + gaps[int(rng.choice(10, p=[.7, .05, .05] + [.2 / 7] * 7))] for w in picked)
        rows.append((text + " New York City" * (i % 3 == 0), ["en", "de", None][i % 3]))
    return rows


@pytest.mark.parametrize("partitions,fan_bits", [(5, 9), (40, 2)])
def test_equals_brute_force_over_shards_and_rounds(spark, monkeypatch, partitions, fan_bits):
    monkeypatch.setattr(Q, "RANGE_BITS", fan_bits)     # 40 shards, four at a time: three rounds
    rows = corpus() + [("alpha beta gamma " * 4000, "hot"), ("rare words only", "few"), (None, "en"), ("", "de"), ("..,;", None), ("und too " * 12, "und")]
    df = spark.createDataFrame([r + (1, 2.0) for r in rows], "text string, lang string, rank int, phrase double").repartition(partitions)
    got = sorted(tuple(r) for r in C.collocations(df).collect())
    assert got == brute(rows)


def test_least_top_and_ties(spark):
    rows = [("b c. a b. d e. c d " * 3, "en"), ("zz yy xx ww. " * 5, "en")] * 2
    df = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(tuple(r) for r in C.collocations(df, least=2, top=3).collect())
    assert got == brute(rows, 2, 3) and len(got) == 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert C.collocations(none).collect() == []
    assert C.collocations(spark.createDataFrame([(None, "en"), ("once only", None)], none.schema)).collect() == []


def test_counts_beyond_64_bits(spark):
    df = spark.createDataFrame([(3_000_000_000_000, 3_000_000_000_001, 3_000_000_000_007)], "a long, l long, r long")
    a, l, r = df.first()  # noqa: E741
    assert df.select(C.score(df.a, df.l, df.r)).first()[0] == 10 ** 6 * a * a // (l * r)


def test_long_texts_are_cut_between_pieces_only():
    raw = np.frombuffer(("one two three, " * 200_000 + "x" * 3_000_000 + " end").encode() + b"short", np.uint8)
    offsets = np.array([0, len(raw) - 5, len(raw)])
    parts = list(C.pieces_of(raw, offsets))
    assert len(parts) > 2 and b"".join(p[0].tobytes() for p in parts) == raw[:-5].tobytes() + b"\nshort\n"
    assert all(C.SPLIT[p[0][-1]] for p in parts)
    assert sum(len(C.words_of(p[0])[1]) for p in parts) == 600_003


@pytest.mark.parametrize("b", [8, 16, 21, 22, 31, 42])
def test_permutation_is_inverted(b):
    rng = np.random.default_rng(b)
    w = rng.integers(0, 1 << b, (3, 5000), dtype=np.int64)
    left, right = Q.permute(*w, b)
    assert max(left.max(), right.max()) < 1 << Q.half_bits(b)
    assert all((x == y.astype(np.int64)).all() for x, y in zip(w, Q.unpermute(left, right, b)))


@pytest.mark.parametrize("b", [16, 24, 42])
def test_filters_lose_nothing(b):
    rng, h = np.random.default_rng(b), Q.half_bits(b)
    want, parts = Counter(), []
    for _ in range(7):
        w = rng.integers(0, 40, (3, 3000), dtype=np.int64) + (1 << b) - 40
        want.update(zip(*w.tolist()))
        left, right, n = Q.summed(*Q.permute(*w, b), np.full(3000, 1), h)
        parts.append(Q.split(left, right, n * 1000, h, 0))
    got = {}
    for prefix in range(1 << Q.RANGE_BITS):
        filters = [f for p in parts for r, f in p if r == prefix]
        if not filters:
            continue
        left, right, n = Q.merge(filters, h, Q.RANGE_BITS, prefix)
        again = Q.split(left, right, n, h, Q.RANGE_BITS)
        two = [np.concatenate(x) for x in zip(*(Q.decode(f, h, 2 * Q.RANGE_BITS, r) for r, f in again))]
        assert all((x == y).all() for x, y in zip(two, (left, right, n)))
        got |= dict(zip(zip(*(x.tolist() for x in Q.unpermute(left, right, b))), n.tolist()))
    assert got == {k: 1000 * c for k, c in want.items()}
    entries = sum(len(Q.decode(f, h, Q.RANGE_BITS, r)[2]) for p in parts for r, f in p)
    stored = sum(len(f) - 32 for p in parts for _, f in p)
    assert stored < entries * (2 * h / 8 + 8 + 5)      # the whole number, an 8-byte counter, and the slots

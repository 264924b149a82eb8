"""Quality rules against a plain brute force and on awkward rows."""

import random
import re

from pyspark.sql import functions as F

from tidemark.llm import queries as Q
from tidemark.llm.quality import quality, quality_filter

SF_SMALL = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    w = WORD.findall(text or "")
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    hit = {k for i, x in enumerate(win) if win.count(x) > 1 for k in range(i, i + 5)} if len(win) < 4000 else None
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(hit) if hit is not None else None)


def test_counts_match_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = Q.REGISTRY["op5_quality"](spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r.doc_id])
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got[:4] == want[:4]
        if want[4] is not None:
            assert got[4] == want[4]
            assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_bands_and_awkward_rows(spark):
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("abcdefghilmnoprstu") for _ in range(rnd.randint(2, 9))) for _ in range(4000)]
    prose = " ".join(rnd.choice(vocab) for _ in range(2500))
    noise = "".join(chr(rnd.randint(33, 126)) for _ in range(9000))
    noise = " ".join(noise[i:i + 7] for i in range(0, 9000, 7))
    cycle = " ".join(str(i % 9) + "ab" for i in range(4000))
    rows = [(1, None), (2, ""), (3, "\n \t"), (4, prose), (5, cycle), (6, noise), (7, prose), (8, "é " * 5),
            (9, "word word   x"), (10, prose + " " + "x" * 300_000)]
    df = spark.createDataFrame([(i, t, "a", i) for i, t in rows], "doc_id long, text string, quality string, N_words int")
    got = {r.doc_id: r.q for r in df.select("doc_id", quality(F.col("text")).alias("q")).collect()}
    assert got[1].n_words == got[2].n_words == got[3].n_words == 0 and got[1].base_failed and got[2].base_failed
    assert got[4].kept and got[4] == got[7]
    assert got[5].base_failed and not got[5].kept
    assert got[6].verdict == "incompressible" and not got[6].kept
    assert got[9].n_words == 3 and got[8].word_chars == 5
    assert got[10].verdict in ("repetitive", "chunks")
    kept = quality_filter(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [4, 7]
    assert quality_filter(df.limit(0)).count() == 0

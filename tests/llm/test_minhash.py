"""Near duplicates against all pairs by brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import minhash as H
from tidemark.llm import queries as Q

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, width):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(docs, width, percent):
    """{position: (set size, smallest linked id)} for (id, text) rows."""
    sets = [plain_set(t, width) for _, t in docs]
    ids = {}
    by, root = {}, list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    seen = set()
    for group in by.values():
        for a in group:
            for b in group:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    n = len(sets[a] & sets[b])
                    if 100 * n >= percent * len(sets[a] | sets[b]):
                        root[find(a)] = find(b)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return [(d, len(sets[i]), ids.get(find(i))) for i, (d, _) in enumerate(docs)]


def check(spark, docs, width, percent):
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, sig string").repartition(4)
    got = H.near_duplicates(df, width=width, percent=percent).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(brute(docs, width, percent), key=str)
    return df, got


def test_documents_match_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Q.REGISTRY["op3_minhash"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(docs, 3, 85))


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_families_of_copies(spark, width, percent):
    """A base with copies of copies around the threshold: some pairs are linked
    only through members other than the centre of their bands."""
    rnd = random.Random(width)
    vocab = [f"w{i}" for i in range(3000)]
    docs = []
    for fam in range(6):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([4, 9, 30, 150, 400]))]
        family = [base]
        for _ in range(60):
            c = list(rnd.choice(family))
            for _ in range(rnd.randint(0, max(1, len(c) // 30))):
                c[rnd.randrange(len(c))] = rnd.choice(vocab)
            if rnd.random() < 0.3 and len(c) > 8:
                del c[rnd.randrange(len(c)):][:rnd.randint(1, 3)]
            family.append(c)
        docs += [" ".join(c) for c in family]
    docs += [" ".join(rnd.choice(vocab) for _ in range(50)) for _ in range(60)]
    docs = list(enumerate(docs)) + [(9000, None), (9001, ""), (9002, " \n"), (9003, "One TWO"), (9004, "one two"), (9003, "One TWO"),
                                    (None, "one two"), (9005, "x")]
    df, got = check(spark, docs, width, percent)
    kept = H.keep_one(df, width=width, percent=percent)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}
    assert H.near_duplicates(df.limit(0)).count() == 0


def test_estimate_is_unbiased():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85):
        est = []
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2))
            k = int(len(a) * 2 * share / (1 + share))
            b = np.unique(np.concatenate([a[rng.permutation(len(a))[:k]], rng.integers(0, 1 << 63, len(a) - k, dtype=np.uint64) * np.uint64(2)]))
            n = np.array([3000.0])
            est.append(H.estimate(np.array([(H.registers(a) == H.registers(b)).sum()]), n, n)[0])
        assert abs(np.mean(est) - share) < 0.02


def test_keep_one_leaves_one_row_of_each_group(spark):
    """Repeated and null ids: rows are counted, not ids."""
    def prose(k):
        return " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(1, prose(1))] * 50                                     # identical rows
    rows += [(2, prose(2)), (2, prose(2) + " more"), (2, prose(3))]     # an id of two groups
    rows += [(None, prose(4))] + [(None, prose(1))] * 5 + [(9, prose(5)), (None, prose(5))]     # lone null id, null copies of others
    rows += [(None, prose(6))] * 7                                  # a group of null ids only
    rows += [(5, ""), (5, ""), (None, None)]                        # no words: all stay
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_key", F.lit(1)).repartition(4)
    got = H.keep_one(df)
    assert got.columns == df.columns
    left = sorted((str(r.doc_id), (r.text or "").split(" ")[0]) for r in got.collect())
    assert left == sorted([("1", "w1x0"), ("2", "w2x0"), ("2", "w3x0"), ("None", "w4x0"), ("9", "w5x0"), ("None", "w6x0"),
                           ("5", ""), ("5", ""), ("None", "")])


def test_null_ids_are_looked_up_by_their_text(spark):
    """Five thousand rows without an id: a text meets its own rows only."""
    rnd = random.Random(3)
    vocab = [f"v{i}" for i in range(400)]
    docs = []
    for k in range(2500):
        w = [rnd.choice(vocab) for _ in range(40)]
        docs += [(None, " ".join(w)), (None, " ".join(w + ["end"]))]
    docs += [(7, docs[0][1]), (7, docs[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    sk, groups = H._groups(df.withColumnRenamed("doc_id", "id"), 5, 80)
    assert groups.count() == 5000 and groups.select("top").distinct().count() == 2500
    got = H.near_duplicates(df).collect()
    assert sum(r.component_id == 7 for r in got) == 6 and len(got) == 5002


def test_members_far_from_the_centre(spark):
    """A popular base with sub-families that share edits: their members are
    linked with each other, the sub-families neither with the base nor among themselves."""
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    docs = [base] + [base[:i] + ["x%d" % i] + base[i + 1:] for i in range(0, 120, 3)]
    for fam in range(5):
        at = rnd.sample(range(120), 6)
        sub = [f"s{fam}y{i}" if i in at else w for i, w in enumerate(base)]
        for k in range(40):
            c = list(sub)
            for j in range(rnd.randint(0, 2)):
                c[rnd.randrange(120)] = f"e{fam}x{k}x{j}"
            docs.append(c)
    check(spark, list(enumerate(" ".join(d) for d in docs)), 3, 85)

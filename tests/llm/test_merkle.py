import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidemark.llm.merkle import dataset_manifest, tampered

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, root string, block long"


def H(s):
    return sha256(s.encode()).hexdigest()


def brute(rows, fan=3):
    """Whole trees in memory: (id, leaf, subroot, root, proof, folded, path) per row."""
    def leaf(values):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def seen(r):
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        return r[:4] + ((r[4].replace("\n", "") if even and r[4] is not None else r[4]),)

    def tree(nodes):
        """Root and each node's runs: (its siblings left, right) upwards."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, i in enumerate(at):
                s = i - i % fan
                paths[k].append(("".join(nodes[s:i]), "".join(nodes[i + 1:s + fan])))
            nodes, at = [H("".join(nodes[i:i + fan])) for i in range(0, len(nodes), fan)], [i // fan for i in at]
        return (nodes[0] if nodes else None), paths

    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0], leaf(r[:5]), leaf(seen(r[:5]))))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subs = {s: tree([x[1] for x in by[s]]) for s in names}
    root, over = tree([subs[s][0] for s in names])
    out = []
    for s, up in zip(names, over):
        for (i, lf, found), path in zip(by[s], subs[s][1]):
            path = path + up
            h = found
            for x, y in path:
                h = H(x + h + y)
            out.append((i, lf, subs[s][0], root, H("".join(x + y for x, y in path)), h, h == root, [x for x, _ in path], [y for _, y in path]))
    return sorted(out, key=repr)


def got(spark, rows, **options):
    df = spark.createDataFrame([r + ("clash", 1) for r in rows], SCHEMA)
    out = dataset_manifest(df, tampered(F.col("text"), F.col("doc_id")), with_path=True, **options)
    return sorted((tuple(r) for r in out.collect()), key=repr)


ROWS = [(i, f"s{i % 3}" if i % 7 else None, "en" if i % 5 else None, i, f"text {i}\nmore" if i % 4 else None) for i in range(130)]


@pytest.mark.parametrize("height", [1, 2, 7])
def test_equals_brute_force_whatever_the_superblocks(spark, height):
    rows = ROWS + [(1000 + i, "hot", "de", i, "x\ny" * i) for i in range(60)] + [(5000, "lone", None, None, None)]
    want = brute(rows)
    assert got(spark, rows, height=height) == want
    flags = {r[6] for r in want}
    assert flags == {True, False}


def test_many_trees_over_several_tiers(spark):
    rows = [(i, f"src-{i % 29:02d}", None, None, f"t{i}\n") for i in range(100)]
    assert got(spark, rows, height=1) == brute(rows)


def test_other_fan(spark):
    assert got(spark, ROWS, fan=2, height=2) == brute(ROWS, fan=2)


def test_defined_cases(spark):
    odd = [(None, None, None, None, None), (None, None, None, None, "a\nb"), (4, "s", "é", -3, ""), (4, "s", "é", -3, ""), (4, "s", "é", -3, "z"),
           (9, "", "en", 1, "ü\n" * 200_000), (2 ** 60 + 1, "s", "en", 1, "big id")]
    assert got(spark, odd, height=1) == brute(odd)
    one = [(7, "s", "en", 3, "abc")]
    (row,) = got(spark, one)
    assert row[1] == row[2] == row[3] and row[4] == H("") and row[6] is True
    assert got(spark, []) == []

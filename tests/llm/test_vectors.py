"""Near vectors against all pairs by brute force."""

import numpy as np
import pytest

from tidemark.llm.vectors import near_vectors

SF = "/root/testdata/sf0.1"


def brute(rows, threshold=0.98):
    """rows: (id, vector or None, group)."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) and g is not None for _, v, g in rows]
    n = len(rows)
    count, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if k else None for (_, v, _), k in zip(rows, ok)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                count[i] += 1
                count[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], count[i], least.get(find(i))) for i in range(n)), key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, g, 0) for i, v, g in rows], "vec_id long, embedding array<float>, label int, node int").repartition(3)
    got = near_vectors(df, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


@pytest.mark.parametrize("cell,block", [(40, 64), (2048, 4096)])
def test_chains_copies_and_awkward_rows(spark, cell, block):
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for g in (0, 1):
        for _ in range(25):
            v = rng.normal(size=16)
            for _ in range(rng.integers(1, 9)):     # a walk: neighbours linked, ends not
                rows.append((i, [float(np.float32(x)) for x in v], g))
                i += 1
                v = v / np.linalg.norm(v) + rng.normal(size=16) * 0.045
    hot = rows[5][1]
    rows += [(i + k, hot, 0) for k in range(90)]
    rows += [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, [float("nan")] * 16, 0), (9003, [float("inf")] + [1.0] * 15, 0), (9004, [None] + [1.0] * 15, 0),
             (9005, hot, None), (9006, [], 0), (9007, hot[:8], 0), (9008, hot[:8], 0), (None, hot, 1), (9009, [2 * x for x in hot], 0),
             (9010, [-0.0, 1.0, 0.0], 1), (9011, [0.0, 1.0, 0.0], 1), (9012, [1e-30] * 16, 1)]
    assert run(spark, rows, cell=cell, block=block, sample=300) == brute(rows)


def test_embeddings_match_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert run(spark, rows, cell=100) == brute(rows)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert near_vectors(df.limit(0)).count() == 0

"""Selection by brackets against a plain sort."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles as Q
from tidemark.operators.selection import GRID, Bracket, clusters, parts_of, select_positions


def order(v, tie):
    return (math.isnan(v), 0.0 if math.isnan(v) else v, tie is not None, (tie.encode() if isinstance(tie, str) else tie) if tie is not None else 0)


def check(spark, rows, schema, positions, few):
    df = spark.createDataFrame(rows, schema).repartition(5)
    n, got = select_positions(df, {"t": ("v", "id"), "v": ("v",)}, {"t": lambda n: positions, "v": lambda n: positions}, few=few)
    want = sorted(((float(v), i) for v, i in rows if v is not None), key=lambda r: order(*r))
    assert n == {"t": len(want), "v": len(want)}
    ps = [p for p in positions if 0 <= p < len(want)]
    assert sorted(got["t"]) == sorted(got["v"]) == sorted(set(ps))
    same = lambda a, b: a == b or (math.isnan(a) and math.isnan(b))
    assert all(same(got["t"][p][0], want[p][0]) and got["t"][p][1] == want[p][1] and same(got["v"][p], want[p][0]) for p in ps)


@pytest.mark.parametrize("few", [60, 3000])
def test_hot_values_and_text_ties(spark, few):
    rng = np.random.default_rng(few)
    n = 3000
    v = np.where(rng.random(n) < 0.55, 1.0, np.where(rng.random(n) < 0.9, 2.0, np.round(rng.gamma(2, 40, n), 1)))
    ids = [f"customer-with-a-long-prefix-{'é' if i % 3 else ''}{i:05d}" for i in rng.permutation(n)]
    cut = int((v == 1.0).sum())
    check(spark, list(zip(v.tolist(), ids)), "v double, id string", [7, cut - 1, cut, n - 1, n, -1], few)


def test_whole_number_ties_nulls_nan_and_infinities(spark):
    rng = np.random.default_rng(8)
    ids = [int(x) for x in rng.integers(-(1 << 62), 1 << 62, 600)] + [1, 2, 1 << 40, (1 << 40) + 1, -1, None, None]
    v = [float(x) for x in rng.integers(0, 3, len(ids))]
    v[5], v[6], v[7], v[8], v[9] = math.nan, math.inf, -math.inf, math.nan, None
    check(spark, list(zip(v, ids)), "v double, id long", [0, 1, 300, 604, 605], 60)


def test_equal_rows_and_texts_that_differ_by_trailing_zeros(spark):
    rows = [(3.0, "same")] * 500 + [(3.0, "same\0")] * 500 + [(3.0, "")] * 100 + [(3.0, None)] * 100
    check(spark, rows, "v double, id string", [99, 100, 700, 1199], 60)


def test_empty_and_single(spark):
    check(spark, [], "v double, id string", [0], 5)
    check(spark, [(None, "x"), (2.0, "y")], "v double, id string", [0, 1], 5)


def test_a_sketch_that_misleads_is_harmless():
    """Whatever the cuts, every position lands in the part that holds it."""
    values = sorted([1] * 50 + [2] * 3 + list(range(3, 90)) + [90] * 40)
    b = Bracket("k", (0, 49, 50, 52, 53, 139, 140, 179), 0, len(values), grid=[5.0] * (GRID + 1))
    for x, y in [(None, None), (2, 90), (1, 1), (5, 5), (89, None), (None, 3), (-4, 200)]:
        lo, hi = (x if x is not None else -9), (y if y is not None else 999)
        counts = [sum(v < lo for v in values) if x is not None else 0, sum(v == lo for v in values) if x is not None else 0,
                  sum(lo < v < hi for v in values), sum(v == hi for v in values) if y is not None and x != y else 0]
        parts = parts_of(b, x, y, counts, None)
        assert sorted(p for q in parts for p in q.positions) == sorted(b.positions)
        for q in parts:
            for p in q.positions:
                v = values[p]
                assert (q.point is None or v == q.point) and (q.lo is None or v > q.lo) and (q.hi is None or v < q.hi)
                assert q.before <= p < q.before + q.inside


def test_clusters():
    assert clusters([9, 3, 4, 4, 7]) == [(3, 4), (7,), (9,)]


def test_rows_are_not_shuffled(spark, tmp_path):
    """Large input: the only exchange of rows is that of the few in the brackets."""
    n = 400_000
    df = spark.range(n, numPartitions=8).select(F.xxhash64("id").cast("double").alias("v")).persist()
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("selection", "selection")
    edges = Q.quantile_edges(df, "v", 5)
    jobs = tracker.getJobIdsForGroup("selection")
    sc.setJobGroup("tests", "tests")
    assert len(jobs) <= 9
    v = np.sort(np.array([r[0] for r in df.collect()]))
    assert edges == pytest.approx([float(np.percentile(v, 20 * i)) for i in range(1, 5)], rel=1e-12)
    df.unpersist()

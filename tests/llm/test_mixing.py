"""Water-filled mixing: targets against an exact fill, samples near them."""

from fractions import Fraction

from pyspark.sql import functions as F

from tidemark.llm.mixing import mix, mixed_rows, n_words


def fill(sizes, weights, share, epochs):
    """Exact water-filling over Fractions."""
    want, target, open_ = share * sum(sizes), {}, set(range(len(sizes)))
    while open_:
        w = sum(weights[i] for i in open_)
        t = {i: Fraction(weights[i]) * want / w for i in open_}
        over = [i for i in open_ if t[i] > epochs * sizes[i]]
        if not over:
            target |= t
            break
        for i in over:
            target[i] = Fraction(epochs * sizes[i])
            want -= epochs * sizes[i]
            open_.remove(i)
    return target


def docs(spark, n=3000):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), ["a", "b", None, "c", "é", "z"][0 if i % 3 == 0 else i % 6], i)
            for i in range(n)]
    rows += [(None, "x y", "a", 1), (5, "p q r", "b", 2), (5, "p q r", "b", 2), (n, None, "c", 3), (n + 1, "", "c", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int")


def test_targets_and_samples(spark):
    df = docs(spark)
    rows = mix(df).select("doc_id", "source", "text", "mix.*").collect()
    assert len(rows) == df.count()
    order = sorted({r.source for r in rows if r.source}) + [None]
    sizes = [next(r.source_size for r in rows if r.source == s) for s in order]
    want = fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(order))], Fraction(3, 2), 2)
    for i, s in enumerate(order):
        mine = [r for r in rows if r.source == s]
        assert sum(r.size for r in mine) == sizes[i]
        assert abs(mine[0].target - float(want[i])) < 1e-6
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)
        assert all(0 <= r.taken <= 2 * r.size for r in mine)
    again = mix(df.repartition(7)).select("doc_id", "source", "text", "mix.*").collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    out = mixed_rows(df)
    assert out.columns == df.columns
    assert out.count() == sum(r.copies for r in rows)


def test_words_and_empty_input(spark):
    df = spark.createDataFrame([(" a\tb c\x1cd \n",), ("",), (None,), ("\v\f",), ("x" * 100_000,)], "t string")
    assert [r[0] for r in df.select(n_words(F.col("t"))).collect()] == [2, 0, 0, 0, 1]
    assert mix(docs(spark).limit(0)).count() == 0
    only_empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.taken for r in mix(only_empty).select("mix.taken").collect()] == [0, 0]

"""Phrase collocations by counting quotient filters (operator 11).

Pass 1 reads the texts once. Every task cuts its words into shards of about
``SHARD_WORDS`` words; a shard keeps the words as positions in its own
dictionary and writes both. Dictionaries, not occurrences, are then joined
with the corpus's words: a phrase found ``least`` times holds only words found
as often, so only those get an id, and any other word ends a phrase. Pass 2
cogroups each shard with the ids of its words, counts its pairs and triples in
a counting quotient filter (``quotient``), and splits that into ranges.
Filters of one range are merged over the shards, as
many shards at a time as there are ranges; each round splits the ranges again, so a task never holds more than about one
shard's entries whatever the size of the corpus. Ids are dense, so a phrase
packs into a few bytes; the permutation is inverted at the end, and no count
is ever approximate.

Phrases are scored and compared with the longer ones that hold them by joins
on ids. Words come back only for rows that can be among the first.

Defined cases: a null or empty text has no words; the null language is
``und``; very long texts are read whole, piece by piece; repeated rows count
as often as they occur; ties are ordered by phrase, so results do not depend
on partitions; an empty table, or one without frequent phrases, gives an
empty table; other columns do not matter. A language may have up to 2 ** 42
words of that frequency (all languages together).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quotient as Q
from . import text as T
from .frames import discard, materialise

SHARD_WORDS = 1 << 21
LEAST = 10              # occurrences of a candidate
TOP = 2000              # phrases reported per language
PARTIAL = 50            # per cent of a phrase's occurrences inside a longer one that drop it
LONGEST_BITS = 42       # of a word id
DICT_ROWS = 1 << 16     # words in one row of a shard's dictionary

SPLIT = np.zeros(256, bool)
SPLIT[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
OUTSIDE = SPLIT.copy()
OUTSIDE[[0x20, 0x09]] = True
SHARDS = "shard long, ids binary, lang string, words array<string>, places array<int>, counts array<long>"


def pieces_of(raw: np.ndarray, offsets: np.ndarray):
    """(bytes, row of each byte's text) of rows laid end to end with a line
    feed after each, in blocks that end after a split byte."""
    for i, j in T.blocks(offsets):
        part = np.insert(raw[offsets[i]:offsets[j]], offsets[i + 1:j + 1] - offsets[i], 10)
        ends = offsets[i + 1:j + 1] - offsets[i] + np.arange(1, j - i + 1)
        at = 0
        while at < len(part):
            to = min(len(part), at + T.BLOCK)
            while to < len(part) and not SPLIT[part[to - 1]]:
                ahead = np.flatnonzero(SPLIT[part[to:to + T.BLOCK]])
                to = to + int(ahead[0]) + 1 if len(ahead) else min(len(part), to + T.BLOCK)
            yield part[at:to], i, ends - at
            at = to


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all words end to end, their sizes, their starts in
    ``data``, and whether a split byte lies before each."""
    inside = ~OUTSIDE[data]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    splits = np.cumsum(SPLIT[data])[starts] if len(starts) else np.zeros(0, np.int64)
    return T.LOWER[data[inside]], ends - starts, starts, np.diff(splits, prepend=-1) != 0


def make_shard(number: int, parts: list, langs: list[str]):
    """The rows of one shard: its words as places in its dictionary (from 1;
    0 before every piece), and the dictionary."""
    data, sizes, lang, breaks = (np.concatenate(x) for x in zip(*parts))
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    coded = column.dictionary_encode()
    known = len(coded.dictionary)
    distinct, place, counts = np.unique(lang * known + coded.indices.to_numpy(), return_inverse=True, return_counts=True)
    stream = np.zeros(len(place) + int(breaks.sum()), np.int32)
    stream[np.arange(len(place)) + np.cumsum(breaks)] = place + 1
    schema = ["shard", "ids", "lang", "words", "places", "counts"]
    none = [pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.string())), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([stream.tobytes()], pa.binary()), *none], schema)
    owner = distinct // known
    for k in np.unique(owner):
        mine = np.flatnonzero(owner == k)
        for i in range(0, len(mine), DICT_ROWS):
            at = mine[i:i + DICT_ROWS]
            words = coded.dictionary.take(pa.array(distinct[at] % known)).cast(pa.large_string()).cast(pa.string())
            size = pa.array([0, len(at)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.nulls(1, pa.binary()), pa.array([langs[k]], pa.string()), pa.ListArray.from_arrays(size, words),
                 pa.ListArray.from_arrays(size, pa.array(at + 1, pa.int32())), pa.ListArray.from_arrays(size, pa.array(counts[at], pa.int64()))], schema)


def shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """SHARDS of (lang, text) rows."""
    def run(batches):
        base, made, held, parts, langs = TaskContext.get().partitionId() << 24, 0, 0, [], {}
        for b in batches:
            raw, offsets = T.buffers(b.column("text"))
            ids = np.array([langs.setdefault(x, len(langs)) for x in b.column("lang").to_pylist()], np.int64)
            for data, row, ends in pieces_of(raw, offsets):
                flat, sizes, starts, breaks = words_of(data)
                if not len(sizes):
                    continue
                parts.append((flat, sizes, ids[row + np.searchsorted(ends, starts, "right")], breaks))
                held += len(sizes)
                if held >= shard_words:
                    yield from make_shard(base + made, parts, list(langs))
                    made, held, parts = made + 1, 0, []
        if parts:
            yield from make_shard(base + made, parts, list(langs))
    return docs.select("lang", "text").mapInArrow(run, SHARDS)


def with_ids(words: DataFrame, label: str) -> DataFrame:
    """``words`` plus ``id``, distinct numbers from 1 that stay close together:
    the partition and the place in it, in as few bits as both need."""
    spot = F.col("spot")
    table = materialise(words.withColumn("spot", F.monotonically_increasing_id()), label)
    top = table.agg(F.max(spot.bitwiseAND((1 << 33) - 1)).alias("at"), F.max(F.shiftright(spot, 33)).alias("part")).first()
    bits = int(top["at"] or 0).bit_length()
    return table.withColumn("id", F.shiftleft(F.shiftright(spot, 33), bits).bitwiseOR(spot.bitwiseAND((1 << 33) - 1)) + 1).drop("spot")


def ngram_counts(parts: DataFrame, ids: DataFrame, b: int, n_shards: int, least: int) -> DataFrame:
    """(w1, w2, w3, n) of every pair (w3 = 0) and triple found ``least`` times.
    parts: (shard, ids) streams; ids: (shard, place, id) of words that count."""
    h, step = Q.half_bits(b), Q.RANGE_BITS

    def count(streams: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        place, word = known.column("place").to_numpy(), known.column("id").to_numpy()
        for raw in streams.column("ids").to_pylist():
            stream = np.frombuffer(raw, np.int32)
            to = np.zeros(int(max(stream.max(initial=0), place.max(initial=0))) + 1, np.int64)
            to[place] = word
            g = to[stream]
            two = np.flatnonzero((g[:-1] > 0) & (g[1:] > 0))
            three = two[:-1][np.diff(two) == 1]
            pairs = Q.permute(g[two], g[two + 1], np.zeros(len(two), np.int64), b)
            triples = Q.permute(g[three], g[three + 1], g[three + 2], b)
            left, right = (np.concatenate(x) for x in zip(pairs, triples))
            out += Q.split(*Q.summed(left, right, np.ones(len(left), np.int64), h), h, 0, step)
        shard = streams.column("shard").to_numpy()
        return pa.table({"shard": pa.array(np.full(len(out), shard[0] if len(shard) else 0), pa.int64()),
                         "part": pa.array([r for r, _ in out], pa.int64()), "filter": pa.array([f for _, f in out], pa.binary())})

    # one shard, or one shard's worth of entries, a task
    tasks = max(n_shards, 1)
    known = ids.withColumnRenamed("shard", "owner").repartition(tasks, "owner")
    filters = (parts.repartition(tasks, "shard").groupBy("shard").cogroup(known.groupBy("owner"))
               .applyInArrow(count, "shard long, part long, filter binary"))
    used, groups, held = step, n_shards, []
    while True:
        groups = -(-groups // (1 << step))
        last, bits = groups <= 1, used

        def join(key: tuple, rows: pa.Table) -> pa.Table:
            entries = Q.merge(rows.column("filter").to_pylist(), h, bits, key[1].as_py())  # noqa: B023
            if last:  # noqa: B023
                keep = entries[2] >= least
                w = Q.unpermute(entries[0][keep], entries[1][keep], b)
                return pa.table({"w1": w[0].astype(np.int64), "w2": w[1].astype(np.int64), "w3": w[2].astype(np.int64), "n": entries[2][keep]})
            out = Q.split(*entries, h, bits, step)  # noqa: B023
            return pa.table({"shard": pa.array([key[0].as_py()] * len(out), pa.int64()), "part": pa.array([r for r, _ in out], pa.int64()),
                             "filter": pa.array([f for _, f in out], pa.binary())})

        merged = (filters.withColumn("shard", F.pmod(F.xxhash64("shard"), F.lit(max(groups, 1)))).repartition(tasks, "shard", "part")
                  .groupBy("shard", "part").applyInArrow(join, "w1 long, w2 long, w3 long, n long" if last else "shard long, part long, filter binary"))
        done = materialise(merged, "ngrams" if last else "filters")
        for table in held:
            discard(table)
        if last:
            return done
        filters, held, used = done, [done], used + step


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 a a / (l r)), exact."""
    wide = lambda c: c.cast("decimal(18,0)")
    top = F.lit(1000000).cast("decimal(7,0)") * wide(a) * wide(a)
    return F.call_function("div", top, wide(l) * wide(r))


def scored(ngrams: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates that no longer one swallows: (w1, w2, w3, a, l, r, score)."""
    pairs, triples = ngrams.where("w3 = 0"), ngrams.where("w3 > 0")
    f = lambda key, out: words.select(F.col("id").alias(key), F.col("f").alias(out)).hint("merge")
    pair = lambda x, y, out: pairs.select(F.col("w1").alias(x), F.col("w2").alias(y), F.col("n").alias(out)).hint("merge")
    longer = (triples.select("w1", "w2", "n").union(triples.select("w2", "w3", "n")).groupBy("w1", "w2").agg(F.max("n").alias("longer")))
    two = (pairs.join(longer.hint("merge"), ["w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < PARTIAL * F.col("n")))
           .join(f("w1", "l"), "w1").join(f("w2", "r"), "w2")
           .select("w1", "w2", "w3", F.col("n").alias("a"), "l", "r", score(F.col("n"), F.col("l"), F.col("r")).alias("score")))
    cut = lambda k, l, r: F.struct(score(F.col("n"), F.col(l), F.col(r)).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))  # noqa: E731, E741
    three = (triples.join(pair("w1", "w2", "l2"), ["w1", "w2"]).join(pair("w2", "w3", "r1"), ["w2", "w3"])
             .join(f("w1", "l1"), "w1").join(f("w3", "r2"), "w3")
             .select("w1", "w2", "w3", F.col("n").alias("a"), F.least(cut(1, "l1", "r1"), cut(2, "l2", "r2")).alias("c"))
             .select("w1", "w2", "w3", "a", "c.l", "c.r", "c.score"))
    return two.union(three)


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    docs = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text != ''")
    base = materialise(shards(docs, shard_words), "shards")
    entries = base.where("words is not null").select("shard", "lang", F.explode(F.arrays_zip("words", "places", "counts")).alias("e")).select(
        "shard", "lang", F.col("e.words").alias("word"), F.col("e.places").alias("place"), F.col("e.counts").alias("n"))
    totals = base.where("words is not null").select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    totals = materialise(totals, "totals")
    words = with_ids(entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "words")
    n_shards = base.where("ids is not null").count()
    rounds = 1
    while 1 << Q.RANGE_BITS * rounds < n_shards:
        rounds += 1
    # room for the ranges of every round and some slots
    b = max(int(words.agg(F.max("id")).first()[0] or 1).bit_length(), Q.RANGE_BITS * rounds * 2 // 3 + 8)
    if b > LONGEST_BITS:
        raise ValueError("more frequent words than ids have bits")
    ids = entries.join(words.select("lang", "word", "id").hint("merge"), ["lang", "word"]).select("shard", "place", "id")
    ngrams = ngram_counts(base.where("ids is not null").select("shard", "ids"), ids, b, n_shards, least)
    found = scored(ngrams, words).join(words.select(F.col("id").alias("w1"), "lang", F.col("word").alias("t1")).hint("merge"), "w1")
    found = materialise(found, "scored")
    discard(base)
    # the score and count of the last place; rows with the same may share it
    order = [F.desc("score"), F.desc("a")]
    first = found.select("lang", "score", "a", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).alias("k")).where(F.col("k") <= top)
    last = first.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last"))
    able = found.join(last.hint("merge"), "lang").where(F.struct("score", "a") >= F.col("last")).drop("last")
    word = lambda k: words.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"t{k}")).hint("merge")
    named = able.join(word(2), "w2").join(word(3), "w3", "left").withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    out = named.select("lang", rank.alias("rank"), "phrase", "a", "l", "r", "score").where(F.col("rank") <= top)
    return out.join(totals.hint("merge"), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Token-id files: entropy-coded blocks in ascending id order (operator 9).

Files below one folder, all written and read by Spark:
  ``table``   (id, freq): the frequency table shared by all blocks
  ``blocks``  one row per block of at most ``BLOCK`` ids: part, first (ids of
              the part before it), n, lanes, states, word_at, crc, words, and
              the documents in it (ordinal, doc_id, place, length)
Parts are ranges of ids in ascending order; blocks decode independently, and
segments of a block too. A document may span blocks.

Counting the ids and coding them need the ids twice, so they are staged once
in the shared folder, deleted when the blocks are written.

Defined cases: a null or empty text has just the end id; null ids come first,
equal ids in the order of their texts, each with its own place; an empty table
gives no blocks and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from . import rans
from .frames import discard, materialise, scratch
from .memo import LONGEST, Memo
from .token_counts import load

BLOCK = 1 << 20    # ids
BLOCK_SCHEMA = ("part long, first long, n long, lanes long, states binary, word_at array<long>, crc array<long>, words binary, "
                "ordinals array<long>, doc_ids array<long>, places array<long>, lengths array<long>")
SLICE = 1 << 23    # bytes of texts whose words are looked up together
LOT = 32           # runs of letters in one text for the library
_ODD = "\x1c\x1d\x1e\x1f"
#: Of a word: Latin-1 letters up to its end or to an ASCII sign that is no apostrophe, and the rest. Others do not match.
_PARTS = "^(?P<run>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<rest>(?:[!-&(-/:-@\\[-`{-~].*)?)$"
#: Tokenizers that compose and lower-case, and take any run of letters as a pre-token unless an apostrophe starts it.
_LETTER_RUNS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "truncation": None, "padding": None}


class WordMemo(Memo):
    """Ids of words as bytes. Where the tokenizer is of ``_LETTER_RUNS``, a
    word that starts with Latin-1 letters is their run and the rest, which the
    tokenizer parts too: the run in small letters is normalised and one
    pre-token as it stands, so runs go to the library with its model alone and
    words that differ in capitals or signs share them. Runs and rests are what
    is remembered then; for other tokenizers, whole words."""

    def __init__(self, tokenizer: Tokenizer, kind: np.dtype, **options):
        super().__init__(tokenizer, bytes, **options)
        self.kind = kind
        about = json.loads(tokenizer.to_str())
        self.plain = None
        if all(about[k] == v for k, v in _LETTER_RUNS.items()):
            self.plain = Tokenizer(tokenizer.model)
            self.plain.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            suffix, vocab = about["model"].get("end_of_word_suffix"), tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocab.values()) + 1, bool)   # ids that end a run of letters
            self.ends[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True

    def values(self, units: list[str]) -> list[bytes]:
        return self.column(pa.array(units, pa.string())).to_pylist()

    def column(self, words: pa.Array) -> pa.Array:
        """The ids of each of ``words``, which are better distinct."""
        self.young[""] = b""       # words of one part, and what stands before a first or after a last space
        if self.plain is None:
            out = self._looked_up(words, self._whole)
        else:
            parts = pc.extract_regex(words, _PARTS)
            run, rest = (pc.struct_field(parts, k) for k in ("run", "rest"))
            out = pc.binary_join_element_wise(self._looked_up(pc.utf8_lower(pc.fill_null(run, "")), self._runs),
                                              self._looked_up(pc.coalesce(rest, words), self._whole), b"")
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        return out

    def _looked_up(self, units: pa.Array, encode) -> pa.Array:
        d = units.dictionary_encode()
        return pa.array(self._values(d.dictionary.to_numpy(zero_copy_only=False).tolist(), encode), pa.binary()).take(d.indices)

    def _values(self, units: list[str], encode) -> list[bytes]:
        """As in ``Memo``, for distinct units: one lookup of those in use."""
        out = list(map(self.young.get, units))
        at = [i for i, v in enumerate(out) if v is None]
        if at and self.old:
            for i in at:
                out[i] = self.old.get(units[i])
            self.young.update((units[i], out[i]) for i in at if out[i] is not None)
            at = [i for i in at if out[i] is None]
        if at:
            unseen = [units[i] for i in at]
            for i, unit, v in zip(at, unseen, encode(unseen)):
                out[i] = v
                if len(unit) <= LONGEST:
                    self.young[unit] = v
        return out

    def _runs(self, runs: list[str]) -> list[bytes]:
        lots = [" ".join(runs[i:i + LOT]) for i in range(0, len(runs), LOT)]
        ids = np.array([i for e in self.plain.encode_batch_fast(lots, add_special_tokens=False) for i in e.ids], self.kind)
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) == len(runs):     # a run has one such id at most, its last
            return self._cut(ids, np.concatenate([[0], ends[:-1] + 1]))
        e = self.plain.encode(" ".join(runs), add_special_tokens=False)
        word = np.array(e.word_ids, np.int64)
        return self._cut(np.array(e.ids, self.kind), np.searchsorted(word, np.arange(len(runs))))

    def _whole(self, units: list[str]) -> list[bytes]:
        e = self.tokenizer.encode(" ".join(units), add_special_tokens=False)
        at = np.fromiter((a for a, _ in e.offsets), np.int64, len(e.offsets))
        size = np.fromiter(map(len, units), np.int64, len(units)) + 1
        return self._cut(np.array(e.ids, self.kind), np.searchsorted(at, np.cumsum(size) - size))

    def _cut(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        flat, at = ids.tobytes(), (starts * self.kind.itemsize).tolist()
        return [flat[a:b] for a, b in zip(at, [*at[1:], len(flat)])]


@lru_cache(maxsize=2)
def column_encoder(path: str, by_words: bool, end_id: int):
    """Texts -> ids with the end id, as little-endian bytes. ``by_words`` is
    for tokenizers that drop white space: then words are encoded alike wherever
    they stand, the distinct ones of the texts are looked up, and what the
    library gives for them is remembered."""
    t = load(path)
    kind = id_type(path)
    end = np.array([end_id], kind).tobytes()
    odd = "|".join(map(re.escape, [*_ODD, *(x.content for x in t.get_added_tokens_decoder().values())]))
    memo = WordMemo(t, kind)

    def ids(texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts.cast(pa.string()), "")
        whole = pc.match_substring_regex(texts, odd) if by_words else pc.not_equal(texts, "")
        words = pc.utf8_split_whitespace(pc.if_else(whole, "", texts))
        bounds = words.offsets.to_numpy()
        d = words.values.dictionary_encode()
        # after the words of each text its end id, or its ids with the end id if it went to the library whole
        last = np.full(len(texts), len(d.dictionary))
        at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        last[at] += 1 + np.arange(len(at))
        wholes = [np.array(t.encode(x, add_special_tokens=False).ids, kind).tobytes() + end for x in texts.take(at).to_pylist()]
        values = pa.concat_arrays([memo.column(d.dictionary), pa.array([end, *wholes], pa.binary())])
        flat = values.take(pa.array(np.insert(d.indices.to_numpy(), bounds[1:], last)))
        offsets = np.frombuffer(flat.buffers()[1], np.int32)[bounds + np.arange(len(bounds))]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), flat.buffers()[2]])
    return ids


def encoder(path: str, by_words: bool, end_id: int):
    """``column_encoder`` for one text at a time."""
    ids = column_encoder(path, by_words, end_id)
    return lambda text: ids(pa.array([text], pa.string()))[0].as_py()


def slices(b: pa.RecordBatch, column: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """``b`` in pieces of about ``size`` bytes of ``column``, a row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < b.num_rows:
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + size, "right")))
        yield b.slice(i, j - i)
        i = j


def id_type(path: str) -> np.dtype:
    return np.dtype("<u2" if load(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")


def stage_ids(df: DataFrame, path: str, id_col: str, text: str, end_id: int, by_words: bool) -> DataFrame:
    """(part, ordinal, doc_id, first, n, ids): the ids of every document in
    ascending order of id within parts that ascend too."""
    kind = id_type(path)
    rows = (df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .repartitionByRange(F.col("doc_id").asc_nulls_first())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
            .withColumn("part", F.spark_partition_id().cast("long")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = column_encoder(path, by_words, end_id)
        ordinal = first = 0
        for b in batches:
            for c in slices(b, "text"):
                coded = ids(c.column("text"))
                n = pc.binary_length(coded).to_numpy().astype(np.int64) // kind.itemsize
                yield pa.RecordBatch.from_arrays(
                    [c.column("part"), pa.array(np.arange(ordinal, ordinal + len(n))), c.column("doc_id"),
                     pa.array(first + np.cumsum(n) - n), pa.array(n), coded],
                    ["part", "ordinal", "doc_id", "first", "n", "ids"])
                ordinal += len(n)
                first += int(n.sum())
    return materialise(rows.mapInArrow(run, "part long, ordinal long, doc_id long, first long, n long, ids binary"), "ids")


def count_ids(staged: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    """How often each id occurs: one array of the vocabulary's size."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for i in range(0, b.num_rows, 512):
                total += np.bincount(np.frombuffer(b"".join(b.column("ids").slice(i, 512).to_pylist()), kind), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])
    rows = staged.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def write_token_files(df: DataFrame, path: str, out: str, id_col: str = "doc_id", text: str = "text",
                      end_id: int = 1, by_words: bool = False, block: int = BLOCK) -> None:
    """Encode every text of ``df`` and write the files below ``out``."""
    spark = df.sparkSession
    kind = id_type(path)
    staged = stage_ids(df, path, id_col, text, end_id, by_words)
    freq = rans.frequencies(count_ids(staged, kind, load(path).get_vocab_size(with_added_tokens=True) + 1))
    spark.createDataFrame([(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id long, freq long").coalesce(1).write.parquet(f"{out}/table")
    shared = spark.sparkContext.broadcast(freq)   # bounded by the vocabulary

    def run(batches):
        table = rans.Table.of(shared.value)
        held: list = []      # (ordinal, doc_id, place, ids) of the open block
        size, part, first = 0, None, 0

        def flush():
            nonlocal held, size, first
            ids = np.concatenate([h[3] for h in held]).astype(np.int64)
            e = rans.encode(ids, table)
            row = {"part": part, "first": first, "n": e["n"], "lanes": e["lanes"], "states": e["states"], "word_at": e["word_at"],
                   "crc": e["crc"], "words": e["words"], "ordinals": [h[0] for h in held], "doc_ids": [h[1] for h in held],
                   "places": [h[2] for h in held], "lengths": [len(h[3]) for h in held]}
            held, first, size = [], first + size, 0
            return pa.RecordBatch.from_pylist([row], schema=_arrow_schema())
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("part", "ordinal", "doc_id", "first")]
            for p, o, d, f, x in zip(*cols, b.column("ids")):
                ids = np.frombuffer(x.as_buffer(), kind)
                if held and (p != part or f != first + size):
                    yield flush()
                if not held:
                    part, first, size = p, f, 0
                while len(ids):
                    take = ids[:block - size]
                    held.append((o, d, size, take))
                    size += len(take)
                    ids = ids[len(take):]
                    if size == block:
                        yield flush()
        if held:
            yield flush()
    staged.mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "uncompressed").parquet(f"{out}/blocks")
    discard(staged)


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in BLOCK_SCHEMA.split(", "))])


def read_token_files(spark: SparkSession, out: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) from the files. Each block
    is decoded and its checksums verified in the task that reads it; the
    CRC-32s of a document's pieces are joined in order."""
    freq = {r.id: r.freq for r in spark.read.parquet(f"{out}/table").collect()}   # bounded by the vocabulary
    dense = np.zeros(max(freq, default=0) + 1, np.int64)
    dense[list(freq)] = list(freq.values())
    shared = spark.sparkContext.broadcast(dense)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{out}/blocks")

    def run(batches):
        table = rans.Table.of(shared.value)
        for b in batches:
            for row in b.to_pylist():
                ids = rans.decode(row, table)
                pieces = [ids[a:a + n] for a, n in zip(row["places"], row["lengths"])]
                k = len(pieces)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * k, pa.int64()), pa.array(row["ordinals"], pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array([row["first"] + a for a in row["places"]], pa.int64()), pa.array(row["lengths"], pa.int64()),
                     pa.array([rans.crc(x) for x in pieces], pa.int64()),
                     pa.array([x.astype(np.int64) if with_ids else None for x in pieces], pa.list_(pa.int64()))],
                    ["part", "ordinal", "doc_id", "first", "n", "crc", "ids"])
    pieces = blocks.mapInArrow(run, "part long, ordinal long, doc_id long, first long, n long, crc long, ids array<long>")
    docs = pieces.groupBy("part", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.min("first").alias("first"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("first", "n", "crc", *(["ids"] if with_ids else [])))).alias("pieces"))
    # ids before each part: one row per file
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (blocks.groupBy("part").agg(F.sum("n").alias("ids")).withColumn("before", F.coalesce(F.sum("ids").over(upto), F.lit(0)))
             .select("part", "before"))

    def join(column):
        return pa.array([_fold(x) for x in column.to_pylist()], pa.int64())
    join.__annotations__ = {"column": pa.Array, "return": pa.Array}
    crc = F.when(F.size("pieces") == 1, F.col("pieces")[0]["crc"]).otherwise(
        F.arrow_udf(join, "bigint")(F.transform("pieces", lambda p: F.struct(p["n"], p["crc"]))))
    cols = ["doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", crc.alias("ids_crc32")]
    if with_ids:
        cols.append(F.flatten("pieces.ids").alias("ids"))
    return docs.join(parts, "part").select(*cols)


def _fold(pieces: list[dict]) -> int | None:
    out = None
    for p in pieces or []:
        n, c = p.values()
        out = c if out is None else rans.crc_join(out, c, 4 * n)
    return out


def token_files(df: DataFrame, path: str, **options) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    out = scratch(df.sparkSession, "token-files")
    write_token_files(df, path, out, **options)
    return read_token_files(df.sparkSession, out)

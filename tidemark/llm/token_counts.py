"""Token counts by overlap resynchronisation (operator 2).

A text up to ``chunk`` characters is encoded at once. A longer one is cut into
chunks that overlap; each chunk is encoded with offsets in a task of its own,
and neighbours are spliced at a boundary that both found. A boundary is stable
when a pre-token starts there in the left chunk (far enough from its end that
the look-ahead and special strings are whole) and in the right chunk: the
pre-tokenizer's scan from a position depends on the text after it only, so
from there on both scans agree with that of the whole text. If a pair has no
such boundary (one pre-token longer than the overlap, say), the text is cut
again with an overlap four times as wide, at last as one chunk.

Counts equal those of the library over the whole text, without added special
tokens; special strings inside a text count as the library's default has it.
Defined cases: null counts as empty (0 bytes, 0 tokens); repeated rows get
equal results; an empty table gives an empty table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .frames import materialise
from .memo import Memo

CHUNK = 32_768     # characters
OVERLAP = 1_024
MARGIN = 32        # characters: longer than the look-ahead and any special string
#: A space next to other white space: there the split at single spaces is not the pre-tokenizer's.
UNSAFE = re.compile(r" \s|\s $|[\x1c-\x1f]")


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def counter(path: str):
    """Token count of one whole text. A byte-level tokenizer without a
    normaliser treats `` word`` units alike wherever they stand, so their
    counts are remembered; texts with other spacing or special strings go to
    the library whole."""
    t = load(path)
    specials = [x.content for x in t.get_added_tokens_decoder().values()]
    memo = Memo(t, len)
    special = re.compile("|".join(map(re.escape, specials)) or "(?!)")

    def count(text: str) -> int:
        if not text:
            return 0
        if UNSAFE.search(text) or special.search(text):
            return len(t.encode(text, add_special_tokens=False))
        units = text.split(" ")
        units = [units[0], *map(" ".__add__, units[1:])]
        return sum(memo.values(units if units[0] else units[1:]))
    return count


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text that is encoded at once (null: 0)."""
    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(path)
        for column in it:
            yield pa.array([count(x.as_py()) for x in column], pa.int64())
    run.__annotations__ = {"it": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "bigint").asNondeterministic()(text)


def starts(encoding) -> list[tuple[int, int]]:
    """(character, tokens before it) for every pre-token of an encoding."""
    out, last = [], -1
    for k, (w, (a, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if k == 0 or w is None or w != last:
            out.append((a, k))
        last = w
    return out


def cut(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, int, int]]:
    """(number, first character, end): chunks that share ``overlap`` characters."""
    step = max(1, chunk - overlap) if chunk > overlap else len(text)
    k, at = 0, 0
    while True:
        end = len(text) if at + step + overlap >= len(text) else at + step + overlap
        yield k, at, end
        if end == len(text):
            return
        k, at = k + 1, at + step


def splice(pieces: list[dict]) -> int | None:
    """Tokens of the whole text from its chunks in order, or None when two
    neighbours share no stable boundary."""
    total, skip = 0, 0
    for p, q in zip(pieces, pieces[1:] + [None]):
        if q is None:
            total += p["n"] - skip
            break
        right = dict(zip(q["head_at"], q["head_k"]))
        common = [(a, k, right[a]) for a, k in zip(p["tail_at"], p["tail_k"])
                  if a in right and q["start"] + MARGIN <= a <= p["stop"] - MARGIN]
        if not common:
            return None
        _, k, first = common[len(common) // 2]
        total += k - skip
        skip = first
    return total


def encode_chunks(df: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens or null) for the long texts of (key, text)."""
    def cut_up(it):
        for batch in it:
            for key, text in zip(batch["key"], batch["text"]):
                for k, a, b in cut(text, chunk, overlap):
                    yield pd.DataFrame({"key": [key], "k": [k], "start": [a], "stop": [b], "piece": [text[a:b]]})

    def encode(it):
        t = load(path)
        for batch in it:
            rows = []
            for r in batch.itertuples():
                e = t.encode(r.piece, add_special_tokens=False)
                at = [(r.start + a, k) for a, k in starts(e)]
                head = [x for x in at if x[0] <= r.start + overlap]
                tail = [x for x in at if x[0] >= r.stop - overlap]
                rows.append((r.key, r.k, r.start, r.stop, len(e), [a for a, _ in head], [k for _, k in head],
                             [a for a, _ in tail], [k for _, k in tail]))
            yield pd.DataFrame(rows, columns=["key", "k", "start", "stop", "n", "head_at", "head_k", "tail_at", "tail_k"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": [pdf["key"].iloc[0]],
                             "n_tokens": pd.array([splice(pdf.sort_values("k").to_dict("records"))], dtype="Int64")})

    pieces = df.mapInPandas(cut_up, "key string, k long, start long, stop long, piece string").repartition("key", "k")
    coded = pieces.mapInPandas(encode, "key string, k long, start long, stop long, n long, head_at array<long>, "
                                       "head_k array<long>, tail_at array<long>, tail_k array<long>")
    return coded.groupBy("key").applyInPandas(join, "key string, n_tokens long")


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, n_bytes, n_tokens) for every row of ``df``."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    long_ = F.coalesce(F.char_length("text") > chunk, F.lit(False))
    short = rows.where(~long_).select("id", n_bytes.alias("n_bytes"), token_count(F.col("text"), path).alias("n_tokens"))
    # equal long texts are encoded once
    keyed = rows.where(long_).select("id", n_bytes.alias("n_bytes"), "text", F.sha2("text", 256).alias("key"))
    todo = keyed.groupBy("key").agg(F.first("text").alias("text"))
    done = None
    while True:
        got = materialise(encode_chunks(todo, path, chunk, overlap), "tokens")
        done = got.where("n_tokens is not null") if done is None else done.union(got.where("n_tokens is not null"))
        if got.where("n_tokens is null").isEmpty():
            break
        overlap *= 4
        chunk = max(chunk, 4 * overlap)
        todo = todo.join(got.where("n_tokens is null").select("key"), "key", "left_semi")
    whole = keyed.select("id", "n_bytes", "key").join(done, "key").select("id", "n_bytes", "n_tokens")
    return short.union(whole).select(F.col("id").alias(id_col), "n_bytes", "n_tokens")

"""Quality rules by compression bands (operator 5).

A text passes when its zstandard ratio (bytes / compressed bytes) over the
whole text lies in the band of its length class, and at most a given share of
its fixed chunks leave the chunk band. A ratio above a band means repetitive
text, one below it incompressible text. Texts under the least class have no
band. Two base rules come first: too few words, or too many words inside
repeated five-word windows.

Defined cases: a null or empty text has no words and fails the base rule;
very long texts are measured whole (chunks bound the work per step); repeated
rows get equal results; an empty table gives an empty table; other columns,
whatever their names, pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .frames import free_name

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WIDTH = 5
RESULT = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
          "base_failed:boolean,ratio:double,n_chunks:bigint,n_bad_chunks:bigint,verdict:string,kept:boolean>")


@dataclass(frozen=True)
class Bands:
    """Length classes as (least bytes, lowest ratio, highest ratio). The
    values leave a wide margin around prose (1.0-2.9 by class, zstd level 3);
    machine-made repetition lies far above, encoded or random data below."""
    level: int = 3
    classes: tuple = ((64, 0.70, 2.75), (256, 1.10, 3.0), (1024, 1.25, 3.5), (4096, 1.45, 4.0),
                      (16384, 1.50, 5.0), (65536, 1.50, 6.0))
    chunk: int = 4096
    chunk_band: tuple = (1.40, 3.75)
    bad_chunks: float = 0.25      # share of chunks that may leave the band
    least_words: int = 10
    most_repeated: float = 0.20   # share of words in repeated windows


def repeated_words(h: np.ndarray, width: int = WIDTH) -> int:
    """Words covered by ``width``-word windows found at least twice."""
    w = T.windows(h, width)
    if len(w) < 2:
        return 0
    _, inverse, counts = np.unique(w, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[inverse] > 1)
    if not len(at):
        return 0
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def duplicate_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def verdict(raw: memoryview, bands: Bands, packer) -> tuple[float | None, int, int, str]:
    """Whole-text ratio, chunks, chunks outside their band, and the verdict."""
    n = len(raw)
    if n == 0:
        return None, 0, 0, "ok"
    ratio = n / len(packer.compress(raw))
    found = "ok"
    for least, low, high in bands.classes:
        if n >= least:
            found = "incompressible" if ratio < low else "repetitive" if ratio > high else "ok"
    chunks = bad = 0
    if n >= 2 * bands.chunk:
        low, high = bands.chunk_band
        for at in range(0, n - bands.chunk + 1, bands.chunk):
            r = bands.chunk / len(packer.compress(raw[at:at + bands.chunk]))
            chunks += 1
            bad += not low <= r <= high
        if found == "ok" and bad > bands.bad_chunks * chunks:
            found = "chunks"
    return ratio, chunks, bad, found


def measure(column: pa.Array, bands: Bands) -> pa.StructArray:
    raw, offsets = T.buffers(column)
    packer = zstandard.ZstdCompressor(level=bands.level)
    n = len(column)
    n_words, word_chars, n_symbols, n_dup, n_rep = (np.zeros(n, np.int64) for _ in range(5))
    ratios, chunks, bad, verdicts = [], [], [], []
    for i, j in T.blocks(offsets):
        off = offsets[i:j + 1]
        s, e, ptr = T.words(raw, off)
        h = T.word_hashes(raw, s, e, lower=False)
        lo = off[0]
        part = raw[lo:off[-1]]
        letters = np.concatenate([[0], np.cumsum(((part & 0xC0) != 0x80) & ~T.WHITE[part])])
        symbols = np.concatenate([[0], np.cumsum(SYMBOLS[part])])
        word_chars[i:j] = np.diff(letters[off - lo])
        n_symbols[i:j] = np.diff(symbols[off - lo])
        n_words[i:j] = np.diff(ptr)
        for k in range(i, j):
            view = memoryview(raw[offsets[k]:offsets[k + 1]])
            n_dup[k] = duplicate_lines(view.tobytes())
            n_rep[k] = repeated_words(h[ptr[k - i]:ptr[k - i + 1]])
            for out, value in zip((ratios, chunks, bad, verdicts), verdict(view, bands, packer)):
                out.append(value)
    failed = (n_words < bands.least_words) | (100 * n_rep > round(100 * bands.most_repeated) * n_words)
    kept = ~failed & (np.array(verdicts, dtype=object) == "ok")
    names = [f.split(":")[0] for f in RESULT[7:-1].split(",")]
    return pa.StructArray.from_arrays(
        [pa.array(n_words), pa.array(word_chars), pa.array(n_symbols), pa.array(n_dup), pa.array(n_rep),
         pa.array(failed), pa.array(ratios, pa.float64()), pa.array(chunks, pa.int64()), pa.array(bad, pa.int64()),
         pa.array(verdicts, pa.string()), pa.array(kept.astype(bool))], names)


def quality(text: Column, bands: Bands = Bands()) -> Column:
    """The measures and the verdict of a text as one struct column."""
    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in it:
            yield measure(column, bands)
    run.__annotations__ = {"it": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, RESULT).asNondeterministic()(text)


def quality_filter(df: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows of ``df`` whose text passes, with the columns of ``df``."""
    probe = free_name(df, "quality")
    return df.withColumn(probe, quality(F.col(text), bands)).where(F.col(probe)["kept"]).drop(probe)

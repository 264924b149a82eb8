"""Language identification by multilingual mixture inference (operator 7).

Model: every word (a run of letters, lower-cased) is drawn from one of the
document's languages; a language gives a word the product of its smoothed
n-gram probabilities (all byte trigrams of `` word ``, hashed to a fixed
table). Expectation-maximisation over the words of a whole text estimates the
language proportions. The language set is chosen by penalised likelihood: the
languages in order of their proportions are added while the gain in log
likelihood exceeds a penalty per language. The prediction is the language with
the largest proportion in the chosen set, the score that proportion.

Training counts trigrams over labelled documents, at most about
``TRAIN_PER_LANG`` of each language (taken by hash, so the same ones in any
order). Defined cases: a null text, or one without letters, is ``und`` with
score 0; so is every text when no labelled document is left to learn from;
very long texts are read whole, in blocks; repeated rows get equal results;
ties go to the language first in code point order; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import free_name

TRAIN_PER_LANG = 20_000     # documents
TABLE = 1 << 16             # hashed trigrams
SMOOTH = 0.5
ROUNDS = 25                 # EM rounds at most
SETTLED = 1e-4              # largest change of a proportion that ends EM
LEAST_SHARE = 0.4           # of the largest language, for a document to stay in a corpus
PENALTY = 6.0               # log likelihood per added language, plus half the log of the words
BLOCK = 1 << 20             # bytes of text at a time
UNKNOWN = "und"
RESULT = "struct<lang:string,score:double,languages:array<string>,proportions:array<double>>"

LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[128:] = True
ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigram of every position of lower-cased bytes whose middle
    byte is a letter (its neighbours count as blank when they are not), and
    the position of each such trigram."""
    inside = LETTER[data]
    b = np.where(inside, data, 32).astype(np.uint32)
    padded = np.concatenate([[np.uint32(32)], b, [np.uint32(32)]])
    code = (padded[:-2] << np.uint32(16)) | (padded[1:-1] << np.uint32(8)) | padded[2:]
    at = np.flatnonzero(inside)
    return ((code[at] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), at


def lowered(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    raw = [(t or "").lower().encode("utf-8", "replace") + b" " for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          per_lang: int = TRAIN_PER_LANG) -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities (TABLE x languages) learned from
    labelled rows. The counts that reach the driver are bounded by
    the table times the languages."""
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    n = {r[0]: r[1] for r in rows.groupBy(F.col(lang)).count().collect()}
    if not n:
        return [], np.zeros((TABLE, 0), np.float32)
    share = F.element_at(F.create_map(*[F.lit(x) for k, v in sorted(n.items()) for x in (k, min(1.0, per_lang / v))]), F.col(lang))
    draw = (F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("train")), F.lit(1 << 20)) / float(1 << 20))
    part = rows.where(draw < share).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column("lang").to_pylist()
            texts = b.column("text").to_pylist()
            for i in range(0, len(texts), 64):
                for one in set(langs[i:i + 64]):
                    data, _ = lowered([t for t, k in zip(texts[i:i + 64], langs[i:i + 64]) if k == one])
                    for j in range(0, len(data), BLOCK):
                        # a step of one byte each way keeps the trigrams at the seams
                        f, at = features(data[max(0, j - 1):j + BLOCK + 1])
                        lo = 1 if j else 0
                        f = f[(at >= lo) & (at < lo + BLOCK)]
                        seen[one] = seen.get(one, 0) + np.bincount(f, minlength=TABLE)
        for one, c in seen.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([one] * len(at), pa.string()), pa.array(at), pa.array(c[at])],
                                             ["lang", "gram", "n"])

    counts = part.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    langs = sorted(n)
    table = np.full((TABLE, len(langs)), SMOOTH)
    got = counts.toPandas()
    table[got["gram"].to_numpy(), got["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy()] += got["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def em(p: np.ndarray, owner: np.ndarray, first: np.ndarray, pi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood (of the scaled ``p``) per document.
    p: words x languages; owner: document of each word; first: first word of
    each document; pi: starting proportions (0 keeps a language out)."""
    n = np.diff(np.append(first, len(p))).astype(np.float64)[:, None]
    for _ in range(ROUNDS):
        r = p * pi[owner]
        r /= r.sum(axis=1, keepdims=True)
        new = np.add.reduceat(r, first, axis=0) / n
        moved = np.abs(new - pi).max()
        pi = new
        if moved < SETTLED:
            break
    return pi, np.add.reduceat(np.log((p * pi[owner]).sum(axis=1)), first)


def choose(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Proportions over the language set with the best penalised likelihood."""
    docs, k = len(first), p.shape[1]
    n = np.diff(np.append(first, len(p)))
    owner = np.repeat(np.arange(docs), n)
    full, _ = em(p, owner, first, np.full((docs, k), 1.0 / k))
    order = np.argsort(-full, axis=1, kind="stable")
    best = np.zeros((docs, k))
    best[np.arange(docs), order[:, 0]] = 1.0
    value = np.add.reduceat(np.log(p[np.arange(len(p)), order[owner, 0]]), first)
    cost = PENALTY + 0.5 * np.log(np.maximum(n, 2))
    active = np.arange(docs)
    for size in range(2, k + 1):
        # only documents whose next language has a share of the full mixture worth a word
        active = active[full[active, order[active, size - 1]] * n[active] >= 1.0]
        if not len(active):
            break
        pick = np.concatenate([np.arange(first[d], first[d] + n[d]) for d in active])
        f = np.concatenate([[0], np.cumsum(n[active])[:-1]])
        start = np.zeros((len(active), k))
        np.put_along_axis(start, order[active, :size], np.take_along_axis(full[active], order[active, :size], 1) + 1e-6, 1)
        start /= start.sum(axis=1, keepdims=True)
        pi, ll = em(p[pick], np.repeat(np.arange(len(active)), n[active]), f, start)
        gain = ll - value[active] > cost[active]
        won = active[gain]
        best[won], value[won] = pi[gain], ll[gain]
        active = won
    return best


def word_scores(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Relative likelihood of each word under each language (the best is 1,
    none under e-30), and the start of each word."""
    out, begins = [], []
    i = 0
    while i < len(data):
        j = min(len(data), i + BLOCK)
        while j < len(data) and LETTER[data[j - 1]]:   # end a block between words
            j += 1
        f, at = features(data[i:j])
        if len(at):
            first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
            s = np.add.reduceat(table[f], first, axis=0, dtype=np.float64)
            out.append(np.exp(np.maximum(s - s.max(axis=1, keepdims=True), -30.0)))
            begins.append(at[first] + i)
        i = j
    if not out:
        return np.zeros((0, table.shape[1])), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(begins)


def identify(texts: list[str | None], langs: list[str], table: np.ndarray) -> pa.StructArray:
    picked, scores, sets, shares = ([] for _ in range(4))
    known = [bool(langs) and has_letter(t) for t in texts]
    data, offsets = lowered([t if k else None for t, k in zip(texts, known)])
    p, begins = word_scores(data, table)
    ptr = np.searchsorted(begins, offsets)
    have = np.flatnonzero(np.diff(ptr))
    best = choose(p, ptr[have]) if len(have) else None
    row = {int(d): i for i, d in enumerate(have)}
    for d, ok in enumerate(known):
        if not ok or d not in row:
            picked.append(UNKNOWN), scores.append(0.0), sets.append([]), shares.append([])
            continue
        pi = best[row[d]]
        order = [int(x) for x in np.argsort(-pi, kind="stable") if pi[x] > 0]
        picked.append(langs[order[0]])
        scores.append(min(1.0, float(pi[order[0]])))
        sets.append([langs[x] for x in order])
        shares.append([float(pi[x]) for x in order])
    return pa.StructArray.from_arrays(
        [pa.array(picked, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string())),
         pa.array(shares, pa.list_(pa.float64()))], ["lang", "score", "languages", "proportions"])


def language(text: Column, model: tuple[list[str], np.ndarray]) -> Column:
    """Predicted language, its score and the chosen set as a struct column.
    The model (at most TABLE x languages floats) travels with the function."""
    langs, table = model

    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in it:
            texts, parts, size, batch = column.to_pylist(), [], 0, []
            for t in texts:
                batch.append(t)
                size += len(t or "")
                if size >= BLOCK:
                    parts.append(identify(batch, langs, table))
                    size, batch = 0, []
            if batch or not parts:
                parts.append(identify(batch, langs, table))
            yield pa.concat_arrays(parts)
    run.__annotations__ = {"it": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, RESULT).asNondeterministic()(text)


def held_out(key: Column) -> Column:
    """Rows that nothing is learned from (rows without an id among them)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def language_filter(df: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", least: float = LEAST_SHARE) -> DataFrame:
    """The rows with a known language of at least ``least`` of the text, with
    the columns of ``df``."""
    name = free_name(df, "language")
    found = df.withColumn(name, language(F.col(text), model))
    return found.where((F.col(name)["lang"] != UNKNOWN) & (F.col(name)["score"] >= least)).drop(name)

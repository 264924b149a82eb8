"""SentencePiece encoding and decoding as a weighted transducer (operator 4).

The model file is compiled into a transducer: normaliser (dummy prefix, white
space to U+2581), one arc per piece, and byte arcs for characters without a
piece. Composed with an input it is a lattice over positions whose states are
the last arc taken; the encoding is its shortest path in the tropical semiring
(min, +).

Weights. Unigram models: minus the piece's score. BPE models have no additive
scores that give their merges, so the weight sits on pairs of neighbouring
arcs: 0 when merging the two pieces' text gives exactly those two pieces,
infinite otherwise. Merging is local (a merge depends on the symbols next to
it only), so a path is the BPE encoding exactly when all its neighbours are
such pairs; one path of weight 0 exists per input, and it equals the library's
encoding. A character without a piece never merges, so byte arcs pair freely.

Decoding runs the output side backwards: pieces and bytes are laid end to end,
U+2581 becomes a space, the dummy prefix goes, broken UTF-8 becomes U+FFFD.

The arcs out of a position come from a trie of the pieces. For BPE models the
path of weight 0 is sought depth first, longest arc first: the text before a
position has one encoding, so a position that led nowhere is not tried again.

Units that no piece can cross (a run of U+2581 and what follows, characters
without a piece) are composed once and remembered, in two bounded generations.

Defined cases: null stays null in ``encode`` and counts as empty in
``digest``; an empty text has no pieces; very long texts are read whole;
repeated rows get equal results; other columns pass through. Models with a
compiled character map or user-defined pieces are refused.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "▁"
BREAK = "\ud800"           # between units: cannot occur in a text
NORMAL, UNKNOWN, BYTE = 1, 2, 6
UNIGRAM, BPE = 1, 2
INFINITE = float("inf")
CAPACITY = 600_000         # units remembered
PAIRS = 1_000_000          # pair weights remembered
START = -1


def fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer message's fields."""
    i = 0

    def varint():
        nonlocal i
        value = shift = 0
        while True:
            c = raw[i]
            i += 1
            value |= (c & 127) << shift
            if c < 128:
                return value
            shift += 7
    while i < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, raw[i:i + size]
            i += size


def read_model(path: str) -> dict:
    """Pieces (text, score, kind) and the settings of a model file. Field
    numbers are those of the public message definition (fixed values)."""
    with open(path, "rb") as f:
        raw = f.read()
    pieces, trainer, normaliser = [], {}, {}
    for k, v in fields(raw):
        if k == 1:
            d = dict(fields(v))
            pieces.append((d[1].decode(), struct.unpack("<f", d[2])[0] if 2 in d else 0.0, d.get(3, NORMAL)))
        elif k == 2:
            trainer = dict(fields(v))
        elif k == 3:
            normaliser = dict(fields(v))
    if normaliser.get(2):
        raise ValueError("models with a compiled character map are not supported")
    if any(kind == 4 for _, _, kind in pieces):
        raise ValueError("models with user-defined pieces are not supported")
    return {"pieces": pieces, "kind": trainer.get(3, UNIGRAM), "byte_fallback": bool(trainer.get(35, 0)),
            "dummy_prefix": bool(normaliser.get(3, 1)), "trim": bool(normaliser.get(4, 1))}


class Transducer:
    def __init__(self, pieces, kind, byte_fallback=True, dummy_prefix=True, trim=False):
        self.kind, self.dummy_prefix, self.trim = kind, dummy_prefix, trim
        self.texts = [t for t, _, _ in pieces]
        self.scores = [s for _, s, _ in pieces]
        self.arcs = {t: i for i, (t, _, k) in enumerate(pieces) if k == NORMAL}
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.bytes = {int(t[3:5], 16): i for i, (t, _, k) in enumerate(pieces) if k == BYTE} if byte_fallback else {}
        self.penalty = 10.0 - min((s for s, p in zip(self.scores, pieces) if p[2] == NORMAL), default=0.0)
        self.trie: dict = {}       # character -> node; "" -> the piece that ends here
        for t, i in self.arcs.items():
            node = self.trie
            for c in t:
                node = node.setdefault(c, {})
            node[""] = i
        self.outputs = [bytes([int(t[3:5], 16)]) if k == BYTE else t.replace(SPACE, " ").encode() if k == NORMAL
                        else b" \xe2\x81\x87 " if k == UNKNOWN else b"" for t, _, k in pieces]
        self.id_type = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        self.splits = not any(SPACE in t.lstrip(SPACE) for t in self.arcs)     # no piece crosses into U+2581
        self.newline = not any("\n" in t for t in self.arcs)
        self.pairs: dict[int, float] = {}
        self.histories: dict[int, tuple] = {}      # at most one a piece
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    # weights
    def merged(self, text: str, steps: list | None = None) -> list[str]:
        """BPE merges: the best-scored pair first, the leftmost of equals.
        ``steps`` collects (score of the merge, first, last symbol after it)."""
        sym = list(text)
        while len(sym) > 1:
            best, at = None, -1
            for i in range(len(sym) - 1):
                k = self.arcs.get(sym[i] + sym[i + 1])
                if k is not None and (best is None or self.scores[k] > best):
                    best, at = self.scores[k], i
            if best is None:
                break
            sym[at:at + 2] = [sym[at] + sym[at + 1]]
            if steps is not None:
                steps.append((best, sym[0], sym[-1]))
        return sym

    def history(self, piece: int) -> tuple:
        """How merging makes a piece: whether it does, the scores of its merges
        (then -inf), its first and its last symbol before each of them."""
        h = self.histories.get(piece)
        if h is None:
            text, steps = self.texts[piece], []
            whole = self.merged(text, steps) == [text]
            h = self.histories[piece] = (whole, [s for s, _, _ in steps] + [-INFINITE],
                                         [text[0], *(a for _, a, _ in steps)], [text[-1], *(b for _, _, b in steps)])
        return h

    def apart(self, last: int, piece: int) -> bool:
        """Whether merging the text of two pieces gives just them. Until a
        merge crosses their border both sides merge as they do alone, so their
        histories are replayed together and the border is tried in between."""
        whole, left, _, ends = self.history(last)
        whole2, right, starts, _ = self.history(piece)
        if not (whole and whole2):
            return False
        arcs, scores, i, j = self.arcs, self.scores, 0, 0
        while True:
            x, y = left[i], right[j]
            k = arcs.get(ends[i] + starts[j])
            if k is not None and scores[k] > x and scores[k] >= y:
                return False
            if x == y == -INFINITE:
                return True
            if x >= y:
                i += 1
            else:
                j += 1

    def weight(self, last: int, piece: int) -> float:
        if self.kind != BPE:
            return -self.scores[piece]
        key = (last + 1) << 32 | piece
        w = self.pairs.get(key)
        if w is None:
            w = 0.0 if (self.history(piece)[0] if last == START else self.apart(last, piece)) else INFINITE
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[key] = w
        return w

    def out_of(self, unit: str, i: int) -> list[tuple[int, int]]:
        """(end, piece) of the pieces from position ``i`` on, shortest first."""
        found, node = [], self.trie
        for at in range(i, len(unit)):
            node = node.get(unit[at])
            if node is None:
                break
            if "" in node:
                found.append((at + 1, node[""]))
        return found

    def fallback(self, c: str) -> list[int]:
        """Output of the arcs of a character without a piece."""
        return [self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown]

    def merge_path(self, unit: str) -> list[int]:
        """Output of the path of weight 0 of a BPE model."""
        n, i, last = len(unit), 0, START
        arcs, pairs = self.arcs, self.pairs
        path: list[tuple] = []         # (position, last arc before it, arcs not tried, output)
        dead: set[int] = set()
        todo = self.out_of(unit, 0)
        while i < n:
            step = None
            while todo:
                end, piece = todo.pop()
                if end not in dead:
                    w = pairs.get((last + 1) << 32 | piece)
                    if w is None:
                        w = self.weight(last, piece)
                    if w == 0.0:
                        step = end, piece, (piece,)
                        break
            else:
                if unit[i] not in arcs and i + 1 not in dead:
                    step = i + 1, START, self.fallback(unit[i])
            if step is None:
                dead.add(i)
                if not path:
                    return []
                i, last, todo, _ = path.pop()
            else:
                path.append((i, last, todo, step[2]))
                i, last, _ = step
                todo = self.out_of(unit, i)
        return [x for p in path for x in p[3]]

    def shortest(self, unit: str) -> list[int]:
        """Output of the least-weight path through the lattice of ``unit``."""
        if self.kind == BPE:
            return self.merge_path(unit)
        n = len(unit)
        cost = [INFINITE] * (n + 1)
        last = [START] * (n + 1)
        back: list[tuple[int, list[int]]] = [(0, [])] * (n + 1)
        cost[0] = 0.0
        for i in range(n):
            if cost[i] == INFINITE:
                continue
            c = unit[i]
            for end, piece in self.out_of(unit, i):
                w = cost[i] + self.weight(last[i], piece)
                if w < cost[end]:
                    cost[end], last[end], back[end] = w, piece, (i, [piece])
            if c not in self.arcs:
                w = cost[i] + self.penalty
                if w < cost[i + 1]:
                    cost[i + 1], last[i + 1], back[i + 1] = w, START, (i, self.fallback(c))
        out, at = [], n
        while at:
            at, ids = back[at]
            out.append(ids)
        return [x for ids in reversed(out) for x in ids]

    # texts
    def normalised(self, text: str) -> str:
        if self.trim:
            text = re.sub(" +", " ", text).strip(" ")
        text = text.replace(" ", SPACE)
        return SPACE + text if self.dummy_prefix and text else text

    def units(self, text: str) -> list[str]:
        t = self.normalised(text)
        if not self.splits:
            return [t] if t else []
        if SPACE + SPACE in t:
            t = re.sub(f"(?<!{SPACE}){SPACE}", BREAK + SPACE, t)
        else:
            t = t.replace(SPACE, BREAK + SPACE)
        if self.newline:
            t = t.replace("\n", f"{BREAK}\n{BREAK}")
        return t.split(BREAK)

    def encode(self, text: str) -> np.ndarray:
        units = self.units(text)
        try:
            found = list(map(self.young.__getitem__, units))
        except KeyError:
            found = []
            for u in units:
                v = self.young.get(u)
                if v is None:
                    v = self.old.get(u)
                    if v is None:
                        v = np.array(self.shortest(u), self.id_type).tobytes()
                    if len(u) <= 64:
                        self.young[u] = v
                found.append(v)
            if len(self.young) > CAPACITY // 2:
                self.old, self.young = self.young, {"": b""}
        return np.frombuffer(b"".join(found), self.id_type)

    def decode(self, ids) -> str:
        out = b"".join(map(self.outputs.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)).decode("utf-8", "replace")
        return out[1:] if self.dummy_prefix and out.startswith(" ") else out


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(**read_model(path))


def _udf(run, result):
    run.__annotations__ = {"it": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, result).asNondeterministic()


def encode(text: Column, path: str) -> Column:
    """Piece ids of a text as array<int>."""
    def run(it):
        t = transducer(path)
        for column in it:
            yield pa.array([None if x is None else t.encode(x).astype(np.int32) for x in column.to_pylist()], pa.list_(pa.int32()))
    return _udf(run, "array<int>")(text)


def decode(ids: Column, path: str) -> Column:
    """Text of piece ids."""
    def run(it):
        t = transducer(path)
        for column in it:
            yield pa.array([None if x is None else t.decode(x) for x in column.to_pylist()], pa.string())
    return _udf(run, "string")(ids)


def digest(text: Column, path: str, with_ids: bool = False) -> Column:
    """Ids of a text as count and CRC-32 (little-endian unsigned 32-bit),
    whether decoding them gives the text back, and the ids if wanted."""
    def run(it):
        t = transducer(path)
        for column in it:
            n, crc, same, kept = [], [], [], []
            for x in column:
                text = x.as_py() or ""
                ids = t.encode(text)
                n.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                same.append(t.decode(ids) == text)
                if with_ids:
                    kept.append(ids.astype(np.int32))
            arrays = [pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
            names = ["n_tokens", "ids_crc32", "round_trip"]
            if with_ids:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.StructArray.from_arrays(arrays, names)
    return _udf(run, f"struct<n_tokens:bigint,ids_crc32:bigint,round_trip:boolean{',ids:array<int>' if with_ids else ''}>")(text)

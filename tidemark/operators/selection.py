"""Exact selection by brackets: the values at given positions of an order,
without shuffling or sorting the rows.

A mergeable KLL sketch of the order's first component gives a bracket around
every wanted position. One narrow aggregate (a few counters and a sketch a
bracket, no exchange of rows) counts the rows ahead of the bracket, at its two
ends and between them. The counts are exact, so they prove in which of these
parts the position lies, however good the sketch was; that part is the next
bracket. Rounds go on until at most ``few`` rows are left, or one value. Only
those rows are grouped by value and collected.

A round keeps about a hundredth of a bracket's rows, so a position among n
rows takes about log(n / few) / log(100) scans: two for ten million rows, four
for 10^11. A value held by most rows is an end of its bracket and soon a
bracket of its own. Ties are broken by a second column in the same way, digit
by digit: a text is read as numbers of six bytes, a whole number as two of 32
bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRID = 512          # fractions that a sketch is asked for
SKETCH = 4096       # KLL parameter: rank error about 0.13 %
MARGIN = 2          # grid steps on either side of a position
FEW = 8_000        # rows of a bracket that may be collected
TEXT_BYTES = 6      # bytes of a text's digit: exact as a double
FRACTIONS = np.arange(GRID + 1) / GRID


@dataclass
class Bracket:
    """Rows whose first digits equal ``prefix`` and whose next digit lies
    strictly between lo and hi (None: no bound) or is ``point``. ``before``:
    rows ahead of them, ``inside``: rows in it, ``grid``: their digits at even
    fractions (None: not known yet)."""
    key: str
    positions: tuple[int, ...]
    before: int
    inside: int
    prefix: tuple[float, ...] = ()
    lo: float | None = None
    hi: float | None = None
    point: float | None = None
    grid: list[float] | None = None

    def cut(self) -> tuple[float | None, float | None]:
        """Two digits around the wanted positions, by the sketch."""
        if self.grid is None:
            return None, None
        i = (self.positions[0] - self.before) * GRID // self.inside - MARGIN
        j = -(-(self.positions[-1] + 1 - self.before) * GRID // self.inside) + MARGIN
        return (self.grid[i] if i > 0 else None), (self.grid[j] if j < GRID else None)

    def rows(self) -> tuple:
        return self.key, self.prefix, self.lo, self.hi, self.point


def number(value: Column) -> Column:
    """A double whose order is the order of the values (NaN last)."""
    v = value.cast("double")
    return F.when(F.isnan(v), F.lit(float("inf"))).otherwise(v)


def tie_digit(tie: Column, kind: T.DataType, level: int) -> Column:
    """The ``level``-th digit (from 0) of a tie column; null ties come first."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        raw = F.hex(F.substring(tie.cast("binary"), TEXT_BYTES * level + 1, TEXT_BYTES))
        digit = F.conv(F.rpad(raw, 2 * TEXT_BYTES, "0"), 16, 10).cast("double")
    elif isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        high = F.shiftright(tie.cast("long"), 32)
        digit = (high if level == 0 else tie.cast("long").bitwiseAND(0xFFFFFFFF) if level == 1 else F.lit(0)).cast("double")
    else:
        raise TypeError(f"ties of type {kind.simpleString()} have no digits")
    return F.coalesce(digit, F.lit(float("-inf")))


def _deepest(kind: T.DataType | None, longest: int) -> int:
    """Digits of a row's order: the value and those of its tie."""
    if kind is None:
        return 1
    return 3 if not isinstance(kind, (T.StringType, T.BinaryType)) else 1 + max(1, -(-longest // TEXT_BYTES))


class _Orders:
    """The digits of the orders of one table."""

    def __init__(self, df: DataFrame, keys: Mapping[str, Sequence[str]]):
        self.keys = keys
        self.kinds = {k: df.select(c[1]).schema[0].dataType if len(c) > 1 else None for k, c in keys.items()}
        ties = [F.col(c[1]).alias(f"t_{k}") for k, c in keys.items() if len(c) > 1]
        self.df = df.select(*[F.col(c[0]).cast("double").alias(f"v_{k}") for k, c in keys.items()],
                            *[number(F.col(c[0])).alias(f"d_{k}") for k, c in keys.items()], *ties)

    def digit(self, key: str, level: int) -> Column:
        return F.col(f"d_{key}") if level == 0 else F.col(f"d_{key}_{level}")

    def table(self, brackets: Sequence[Bracket]) -> DataFrame:
        """The rows with every digit that the brackets ask for, computed once."""
        deepest: dict[str, int] = {}
        for b in brackets:
            deepest[b.key] = max(deepest.get(b.key, 0), len(b.prefix))
        more = [tie_digit(F.col(f"t_{k}"), self.kinds[k], level - 1).alias(f"d_{k}_{level}")
                for k, last in deepest.items() for level in range(1, last + 1)]
        return self.df.select("*", *more) if more else self.df

    def under(self, b: Bracket) -> Column:
        """Rows with the bracket's prefix."""
        out = F.col(f"d_{b.key}").isNotNull()
        for level, v in enumerate(b.prefix):
            out = out & (self.digit(b.key, level) == F.lit(v))
        return out

    def within(self, b: Bracket) -> tuple[Column, Column]:
        """The bracket's rows and the digit that it bounds."""
        d, out = self.digit(b.key, len(b.prefix)), self.under(b)
        if b.point is not None:
            out = out & (d == F.lit(b.point))
        if b.lo is not None:
            out = out & (d > F.lit(b.lo))
        if b.hi is not None:
            out = out & (d < F.lit(b.hi))
        return out, d



def sketched(digit: Column, at: Column) -> Column:
    """The digit at the fractions ``at`` of the rows where it is not null."""
    sketch = F.kll_sketch_agg_double(digit, SKETCH)
    return F.when(F.count(digit) > 0, F.kll_sketch_get_quantile_double(sketch, at))


def clusters(positions: Sequence[int]) -> list[tuple[int, ...]]:
    """Runs of consecutive positions."""
    out: list[list[int]] = []
    for p in sorted(set(positions)):
        if out and p == out[-1][-1] + 1:
            out[-1].append(p)
        else:
            out.append([p])
    return [tuple(c) for c in out]


def parts_of(b: Bracket, x: float | None, y: float | None, counts: Sequence[int], grid: list[float] | None) -> list[Bracket]:
    """The brackets that the positions of ``b`` fall into: below the cut x, at
    x, between, at y, above y (``counts`` of the first four)."""
    sizes = [*counts, b.inside - sum(counts)]
    spans = [dict(lo=b.lo, hi=x), dict(point=x), dict(lo=x if x is not None else b.lo, hi=y if y is not None else b.hi, grid=grid),
             dict(point=y), dict(lo=y, hi=b.hi)]
    out, ahead = [], b.before
    for size, span in zip(sizes, spans):
        mine = tuple(p for p in b.positions if ahead <= p < ahead + size)
        if mine:
            out.append(Bracket(b.key, mine, ahead, size, b.prefix, **span))
        ahead += size
    return out


def _count(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _collected(orders: _Orders, ready: list[Bracket]) -> dict[str, dict[int, Any]]:
    """The wanted rows of brackets that are small enough to collect."""
    out: dict[str, dict[int, Any]] = {k: {} for k in orders.keys}
    groups: dict[tuple, list[Bracket]] = {}
    for b in ready:
        groups.setdefault(b.rows(), []).append(b)
    if not groups:
        return out
    kind = next((t.simpleString() for t in orders.kinds.values() if t is not None), "string")
    rows = []
    for i, (rule, bs) in enumerate(groups.items()):
        k = rule[0]
        tie = (F.col(f"t_{k}") if orders.kinds[k] is not None else F.lit(None)).cast(kind)
        rows.append(F.when(orders.within(bs[0])[0], F.struct(F.lit(i).alias("i"), F.col(f"v_{k}").alias("a"), tie.alias("b"))))
    got = (orders.table(ready).select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")
           .groupBy("i", "a", "b").agg(F.count(F.lit(1)).alias("n")).collect())
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["i"], []).append(r)

    def place(r):
        b = r["b"].encode() if isinstance(r["b"], str) else r["b"]
        return math.isnan(r["a"]), 0.0 if math.isnan(r["a"]) else r["a"], b is not None, b if b is not None else 0

    for i, bs in enumerate(groups.values()):
        at = bs[0].before
        for r in sorted(by.get(i, []), key=place):
            for b in bs:
                for p in b.positions:
                    if at <= p < at + r["n"]:
                        out[b.key][p] = (r["a"], r["b"]) if orders.kinds[b.key] is not None else r["a"]
            at += r["n"]
    return out


def select_positions(df: DataFrame, keys: Mapping[str, Sequence[str]], wanted: Mapping[str, Callable[[int], Sequence[int]]],
                     few: int = FEW) -> tuple[dict[str, int], dict[str, dict[int, Any]]]:
    """Row counts and the rows at 0-based positions of several orders of one
    table. ``keys``: name -> (value column,) or (value column, tie column);
    rows with a null value are left out. ``wanted``: name -> positions for n
    rows. A row comes back as its value (double) or (value, tie)."""
    orders, at = _Orders(df, keys), F.lit(FRACTIONS)
    texts = [k for k, t in orders.kinds.items() if isinstance(t, (T.StringType, T.BinaryType))]
    row = orders.df.agg(*[F.count(f"d_{k}").alias(f"n_{k}") for k in keys], *[sketched(F.col(f"d_{k}"), at).alias(f"g_{k}") for k in keys],
                        *[F.max(F.octet_length(f"t_{k}")).alias(f"l_{k}") for k in texts]).first()
    n = {k: int(row[f"n_{k}"]) for k in keys}
    depth = {k: _deepest(orders.kinds[k], (row[f"l_{k}"] or 0) if k in texts else 0) for k in keys}
    todo = [Bracket(k, c, 0, n[k], grid=row[f"g_{k}"]) for k in keys
            for c in clusters([p for p in wanted[k](n[k]) if 0 <= p < n[k]])]
    ready: list[Bracket] = []
    while todo:
        active = []
        for b in todo:
            last = b.point is not None and len(b.prefix) + 1 >= depth[b.key]
            (ready if last or b.inside <= few else active).append(b)
        todo, aggs, cuts = [], [], []
        for i, b in enumerate(active):
            if b.point is not None:         # one value: go on with the next digit
                b = active[i] = Bracket(b.key, b.positions, b.before, b.inside, (*b.prefix, b.point))
            (rows, d), (x, y) = orders.within(b), b.cut()
            middle, none = rows, F.lit(False)
            if x is not None:
                middle = middle & (d > F.lit(x))
            if y is not None:
                middle = middle & (d < F.lit(y))
            four = [rows & (d < F.lit(x)) if x is not None else none, rows & (d == F.lit(x)) if x is not None else none,
                    middle, rows & (d == F.lit(y)) if y is not None and y != x else none]
            aggs += [*[_count(c).alias(f"c{i}_{j}") for j, c in enumerate(four)], sketched(F.when(middle, d), at).alias(f"g{i}")]
            cuts.append((x, y))
        if active:
            got = orders.table(active).agg(*aggs).first()
            for i, (b, (x, y)) in enumerate(zip(active, cuts)):
                todo += parts_of(b, x, y, [got[f"c{i}_{j}"] for j in range(4)], got[f"g{i}"])
    return n, _collected(orders, ready)

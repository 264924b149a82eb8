"""S5 at scale: the elements of a JSON array file, read by many tasks.

A list of customers may be one line of any size, so lines cannot split it.
The file is read with ``}`` as the line separator instead, which Spark splits
by byte ranges. Whether a brace counts depends on what stands before it (inside
a string or not, how deep), so a prefix scan over the ranges finds that out:

1. every range is summed up for each state it may start in (outside of a
   string, inside, inside after a backslash): the state it ends in and the
   change of depth;
2. these sums, one small row a range, are folded along each file: the state
   and the depth that every range really starts with;
3. every range is cogrouped with its start and cut into elements; an element
   that crosses ranges leaves fragments, and only those are put together.

A task holds one range (``spark.sql.files.maxPartitionBytes``) plus a record.
Anything between elements but commas and white space makes the next element
unreadable, as does the end of a file that is cut short: such elements come
back with a null value and their text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .requests import CORRUPT, CUSTOMER_TYPE

OUT, IN, ESCAPED = 0, 1, 2
_STRING = re.compile(rb'"(?:[^"\\]|\\.)*"', re.S)
_TO_QUOTE = re.compile(rb'(?:[^"\\]|\\.)*"', re.S)
_MARKS = re.compile(rb'"(?:[^"\\]|\\.)*"|["{}\[\]]', re.S)
STARTS = "file string, range long, state int, depth long"


def open_string(tail: bytes) -> int:
    """State after the unclosed string ``tail``."""
    return ESCAPED if (len(tail) - len(tail.rstrip(b"\\"))) % 2 else IN


def after_string(data: bytes, state: int) -> int | None:
    """Where ``data`` is outside of the string that it starts in (None: nowhere)."""
    if state == OUT:
        return 0
    m = _TO_QUOTE.match(data, 1 if state == ESCAPED else 0)
    return m.end() if m else None


def step(data: bytes, state: int) -> tuple[int, int]:
    """State and change of depth after ``data``."""
    if not data:
        return state, 0
    at = after_string(data, state)
    if at is None:
        return open_string(data[1 if state == ESCAPED else 0:]), 0
    plain = _STRING.sub(b"", data[at:])
    quote = plain.find(b'"')
    end = OUT
    if quote >= 0:
        end, plain = open_string(plain[quote + 1:]), plain[:quote]
    return end, plain.count(b"{") + plain.count(b"[") - plain.count(b"}") - plain.count(b"]")


def cut(data: bytes, state: int, depth: int) -> list[int]:
    """Ends of the elements in ``data``: after every ``}`` that leads back to depth 1."""
    at = after_string(data, state)
    ends: list[int] = []
    if at is None:
        return ends
    for m in _MARKS.finditer(data, at):
        c = m.group()
        if c == b'"':                       # a string that goes on in the next range
            break
        if c in (b"{", b"["):
            depth += 1
        elif c in (b"}", b"]"):
            depth -= 1
            if depth == 1 and c == b"}":
                ends.append(m.end())
    return ends


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, place, piece): the text between braces, in order of place."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("place"), F.col("value").cast("binary").alias("piece"))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range of a task: end state and change of depth by start state."""
    found: dict[tuple, list] = {}
    for b in batches:
        for file, rng, piece in zip(*(b.column(c).to_pylist() for c in ("file", "range", "piece"))):
            sums = found.setdefault((file, rng), [(s, 0) for s in (OUT, IN, ESCAPED)])
            data = piece + b"}"
            for k, (state, depth) in enumerate(sums):
                end, change = step(data, state)
                sums[k] = (end, depth + change)
    yield pa.RecordBatch.from_arrays(
        [pa.array([f for f, _ in found], pa.string()), pa.array([r for _, r in found], pa.int64()),
         pa.array([[x[0] for x in v] for v in found.values()], pa.list_(pa.int32())),
         pa.array([[x[1] for x in v] for v in found.values()], pa.list_(pa.int64()))], ["file", "range", "ends", "changes"])


def _fold(rows: pa.Table) -> pa.Table:
    """The start of every range of one file, from the sums of those before it."""
    state, depth, out = OUT, 0, []
    for r in sorted(rows.to_pylist(), key=lambda r: r["range"]):
        out.append((r["file"], r["range"], state, depth))
        state, depth = r["ends"][state], depth + r["changes"][state]
    return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int64()))],
                    names=["file", "range", "state", "depth"])


def _elements(rows: pa.Table, start: pa.Table) -> pa.Table:
    """The elements and fragments of one range; ``k`` counts the ends before."""
    if not rows.num_rows:
        return pa.table([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.binary())], names=["file", "range", "k", "text"])
    data = b"".join(p + b"}" for p in rows.sort_by("place").column("piece").to_pylist())
    begin = start.to_pylist()[0]
    ends = cut(data, begin["state"], begin["depth"])
    bounds = [0, *ends, len(data)]          # the last text may be empty: k counts the ends
    texts = [data[a:b] for a, b in zip(bounds, bounds[1:])]
    n = len(texts)
    return pa.table([pa.array([begin["file"]] * n, pa.string()), pa.array([begin["range"]] * n, pa.int64()),
                     pa.array(range(n), pa.int64()), pa.array(texts, pa.binary())], names=["file", "range", "k", "text"])


def read_json_list(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, text): the objects of the JSON arrays in ``path``, one
    row each, position from 0 within its file."""
    rows = pieces(spark, path)
    sums = rows.mapInArrow(_summaries, "file string, range long, ends array<int>, changes array<long>")
    # a range may be met by one task only, so a file has one row a range
    starts = sums.groupBy("file").applyInArrow(_fold, STARTS)
    parts = (rows.groupBy("file", "range").cogroup(starts.groupBy("file", "range"))
             .applyInArrow(_elements, "file string, range long, k long, text binary"))
    counts = parts.groupBy("file", "range").agg(F.max("k").alias("last"))
    upto = Window.partitionBy("file").orderBy("range")
    shift = counts.select("file", "range", "last", F.coalesce(F.sum("last").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"),
                          F.row_number().over(upto).alias("nth"))
    numbered = parts.join(shift, ["file", "range"]).withColumn("position", F.col("shift") + F.col("k"))
    # the first and the last text of a range may be fragments
    edge = (F.col("k") == 0) | (F.col("k") == F.col("last"))
    joined = (numbered.where(edge).groupBy("file", "position").agg(F.sort_array(F.collect_list(F.struct("range", "text"))).alias("t"))
              .select("file", "position", F.concat(F.lit(b""), F.array_join(F.transform("t", lambda x: F.hex(x["text"])), "")).cast("string").alias("hex"))
              .select("file", "position", F.unhex("hex").alias("text")))
    whole = numbered.where(~edge).select("file", "position", "text").union(joined)
    body = F.regexp_replace(F.col("text").cast("string"), r"^[\s,]*(?:\[[\s]*)?", "")
    # what follows the last element: the closing bracket and the brace that the reader's separator adds
    rest = F.regexp_replace(body, r"[\s\],}]", "") == ""
    return whole.select("file", "position", body.alias("text")).where(~rest)


def read_customer_list(spark: SparkSession, path: str) -> DataFrame:
    """Bare customer lists as requests, one row per customer: request_id
    (the file), position, customers (an array of the one), error, body. The
    rows go through ``request_defaults`` and ``flatten_requests`` like whole
    requests."""
    schema = T.StructType([*CUSTOMER_TYPE.fields, T.StructField(CORRUPT, T.StringType(), True)])
    rows = read_json_list(spark, path).withColumn(
        "c", F.from_json("text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col("c").isNull() | F.col(f"c.{CORRUPT}").isNotNull()
    customer = F.struct(*[F.col(f"c.`{f.name}`").alias(f.name) for f in CUSTOMER_TYPE.fields])
    return rows.select(F.col("file").alias("request_id"), F.lit(None).cast("string").alias("caller_id"), "position",
                       F.lit(None).cast("string").alias("snapshot_date"), F.lit(None).cast("long").alias("xdays"),
                       F.when(~bad, F.array(customer)).alias("customers"), F.when(bad, F.lit("not a customer")).alias("error"),
                       F.col("text").alias("body"))


__all__ = ["read_json_list", "read_customer_list"]

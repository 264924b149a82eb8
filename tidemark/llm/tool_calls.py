"""Chat formatting with linked tool calls (operator 10).

Input: messages (conversation, turn, role, text) and the calls and results
they carry. Steps, all DataFrame work:

1. Results are joined to calls by identifier within a conversation (an
   equi-join that adaptive execution can split). The first call of an
   identifier, by turn, is the one that is meant; later ones are flagged.
2. Arguments are validated against the tool's schema: required and unknown
   names, types, ranges, choices.
3. Events are put in topological order: a result comes after its call, a call
   after the results it refers to. Turn order already satisfies nearly all
   such edges; only events behind an edge that it violates are moved, in
   rounds (a moved event takes the place of its latest dependency and the next
   depth), until nothing moves. Conversations in which events still move after
   ``ROUNDS`` are peeled instead: events whose dependencies are all placed are
   placed, chains are shortened by pointer doubling, and what cannot be peeled
   is on a cycle or behind one, keeps its own turn and is flagged.
4. Every event becomes one line of canonical JSON: keys in code point order,
   no blanks, numbers in shortest form, characters outside of ASCII as they
   are.

Defined cases: a null identifier links with nothing; a result without a call
is an ``orphan``, a call without a result ``unanswered``; arguments that are
no JSON object are ``invalid``; null texts are JSON null; repeated rows give
repeated lines; ties in turn are ordered by kind and identifier; a
conversation of any length is never gathered in one row; an empty table gives
an empty table; other columns do not matter.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import materialise

ROUNDS = 40     # rounds before conversations that still move are peeled
FAR = 1 << 40   # longer than any path without a cycle
CALL, RESULT, MESSAGE = "call", "result", "message"
#: name -> parameters of a tool; each: type, and optionally required, choices, least, most, longest
Schemas = dict[str, dict[str, dict]]
_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def faults(tool: str | None, raw: str | None, schemas: Schemas) -> tuple[str | None, list[str]]:
    """Canonical arguments (None when they are no JSON object) and what is
    wrong with them, in code point order."""
    try:
        args = json.loads(raw) if raw is not None else None
        text = canonical(args)
    except (ValueError, RecursionError):
        return None, ["not json"]
    if not isinstance(args, dict):
        return None, ["not an object"]
    schema = schemas.get(tool)
    if schema is None:
        return text, ["unknown tool"]
    wrong = [f"{name}: unknown" for name in args if name not in schema]
    for name, rule in schema.items():
        if name not in args:
            if rule.get("required"):
                wrong.append(f"{name}: missing")
            continue
        v = args[name]
        if not isinstance(v, _TYPES[rule["type"]]) or (isinstance(v, bool) and rule["type"] != "boolean"):
            wrong.append(f"{name}: not {rule['type']}")
        elif "choices" in rule and v not in rule["choices"]:
            wrong.append(f"{name}: not a choice")
        elif ("least" in rule and v < rule["least"]) or ("most" in rule and v > rule["most"]):
            wrong.append(f"{name}: out of range")
        elif "longest" in rule and len(v) > rule["longest"]:
            wrong.append(f"{name}: too long")
    return text, sorted(wrong)


def validate(tool: Column, arguments: Column, schemas: Schemas) -> Column:
    """struct<args: canonical JSON or null, faults: array<string>>"""
    def run(it: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for tools, raws in it:
            found = [faults(t, r, schemas) for t, r in zip(tools.to_pylist(), raws.to_pylist())]
            yield pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.list_(pa.string()))],
                                             ["args", "faults"])
    run.__annotations__ = {"it": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<args:string,faults:array<string>>").asNondeterministic()(tool, arguments)


def link(events: DataFrame) -> DataFrame:
    """Adds ``call_turn`` (of the call that a result or repeated call means),
    ``result_turn`` (first result of a call) and ``status`` to events
    (conv, turn, kind, id, ...)."""
    keyed = events.where(F.col("id").isNotNull())
    calls = keyed.where(F.col("kind") == CALL).groupBy("conv", "id").agg(F.min("turn").alias("call_turn"))
    results = keyed.where(F.col("kind") == RESULT).groupBy("conv", "id").agg(F.min("turn").alias("result_turn"))
    both = calls.join(results.hint("merge"), ["conv", "id"], "full").withColumnsRenamed({"conv": "c", "id": "i"})
    out = events.join(both.hint("merge"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")), "left").drop("c", "i")
    status = (F.when(F.col("kind") == MESSAGE, "message")
              .when((F.col("kind") == CALL) & (F.col("turn") > F.col("call_turn")), "repeated")
              .when(F.col("kind") == CALL, F.when(F.col("result_turn").isNull(), "unanswered").otherwise("answered"))
              .when(F.col("call_turn").isNull(), "orphan")
              .when(F.col("turn") > F.col("result_turn"), "repeated").otherwise("linked"))
    return out.withColumn("status", status)


def peel(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places (event, turn_at, depth) of ``nodes``, whose own places are given,
    and those that are on or behind a cycle of ``edges`` (event, on). Every
    round places the events without open dependencies and leads each edge past
    a dependency that has only one itself, so a chain of n takes log n rounds."""
    edges = edges.withColumn("k", F.lit(1).cast("long"))
    while True:
        out = edges.groupBy("event").agg(F.count("*").alias("out"), F.max("on").alias("next"), F.max("k").alias("next_k"))
        state = materialise(nodes.join(out.hint("merge"), "event", "left").withColumn("out", F.coalesce("out", F.lit(0))), "peel")
        nodes = state.select("event", "turn_at", "depth")
        at_on = state.withColumnRenamed("event", "on")
        hop = materialise(edges.join(at_on.hint("merge"), "on"), "hops")
        if hop.where("out = 0").isEmpty():               # whatever is open depends on something open
            return state.where("out = 0").select(*nodes.columns), state.where("out > 0").select(*nodes.columns)
        least = hop.where("out <= 1").groupBy("event").agg(F.max(F.struct("turn_at", (F.col("depth") + F.col("k")).alias("depth"))).alias("least"))
        nodes = (nodes.join(least.hint("merge"), "event", "left")
                 .withColumn("to", F.greatest(F.struct("turn_at", "depth"), "least")).select("event", "to.turn_at", "to.depth"))
        past = F.col("out") == 1
        edges = (hop.where("out >= 1").select("event", F.when(past, F.col("next")).otherwise(F.col("on")).alias("on"),
                                              F.when(past, F.least(F.col("k") + F.col("next_k"), F.lit(FAR))).otherwise(F.col("k")).alias("k"))
                 .groupBy("event", "on").agg(F.max("k").alias("k")))
        edges = materialise(edges, "open")


def order(events: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Adds ``place`` (turn, depth): sorting a conversation by it is a
    topological order. ``cyclic`` marks events that no order can serve.
    Events need (conv, turn, kind, id, refs), refs: identifiers of results."""
    base = materialise(events.withColumn("event", F.monotonically_increasing_id()), "events")
    needs = base.where(F.col("kind") == RESULT).select("conv", "event", F.lit(CALL).alias("kind"), "id")
    needs = needs.union(base.where(F.col("kind") == CALL).select("conv", "event", F.lit(RESULT), F.explode("refs")))
    targets = base.where(F.col("id").isNotNull()).groupBy("conv", "kind", "id").agg(F.min(F.struct("turn", "event")).alias("t"))
    edges = materialise(needs.where(F.col("id").isNotNull()).withColumnsRenamed({"conv": "c", "kind": "k", "id": "i"})
                        .join(targets.hint("merge"), F.col("c").eqNullSafe(F.col("conv")) & (F.col("k") == F.col("kind")) & (F.col("i") == F.col("id")))
                        .select("event", F.col("t.event").alias("on")).where(F.col("event") != F.col("on")), "needs")
    at = base.select("event", F.col("turn").alias("turn_at"), F.lit(0).cast("long").alias("depth"))
    moved = None
    for _ in range(rounds):
        at_on = at.select(F.col("event").alias("on"), F.struct("turn_at", (F.col("depth") + 1).alias("depth")).alias("least"))
        # a call and its result may share a turn, so the depth counts too
        want = edges.join(at_on.hint("merge"), "on").groupBy("event").agg(F.max("least").alias("least"))
        moved = materialise(at.join(want.hint("merge"), "event").where(F.struct("turn_at", "depth") < F.col("least")).select("event", "least"), "moved")
        if moved.isEmpty():
            moved = None
            break
        at = materialise(at.join(moved.hint("merge"), "event", "left").select(
            "event", F.coalesce("least.turn_at", "turn_at").alias("turn_at"), F.coalesce("least.depth", "depth").alias("depth")), "places")
    if moved is not None:
        # only conversations in which events still move
        conv = base.join(moved.select("event").hint("merge"), "event", "left_semi").select(F.col("conv").alias("c")).distinct()
        open_ = materialise(base.join(conv.hint("merge"), F.col("conv").eqNullSafe(F.col("c")), "left_semi")
                            .select("event", F.col("turn").alias("turn_at"), F.lit(0).cast("long").alias("depth")), "open")
        placed, on_cycle = peel(open_, edges.join(open_.select("event").hint("merge"), "event", "left_semi"))
        at = at.join(open_.select("event").hint("merge"), "event", "left_anti").union(placed).withColumn("cyclic", F.lit(False))
        at = at.union(on_cycle.withColumn("cyclic", F.lit(True)))
    else:
        at = at.withColumn("cyclic", F.lit(False))
    out = base.join(at.hint("merge"), "event")
    return (out.withColumn("place", F.when(F.col("cyclic"), F.struct(F.col("turn").alias("turn"), F.lit(0).cast("long").alias("depth")))
                           .otherwise(F.struct(F.col("turn_at").alias("turn"), "depth"))).drop("event", "turn_at", "depth"))


def line(e: dict) -> str:
    """Canonical JSON of one event."""
    kind, role = e["kind"], e["role"]
    if kind == CALL:
        args = e["args"]
        return canonical({"arguments": None if args is None else json.loads(args), "id": e["id"], "kind": kind, "role": role, "tool": e["tool"],
                          "valid": not e["faults"]})
    if kind == RESULT:
        return canonical({"content": e["text"], "id": e["id"], "kind": kind, "role": role, "status": e["status"]})
    return canonical({"content": e["text"], "kind": kind, "role": role})


def lines(event: Column) -> Column:
    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in it:
            yield pa.array([line(e) for e in column.to_pylist()], pa.string())
    run.__annotations__ = {"it": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string").asNondeterministic()(event)


def format_chat(events: DataFrame, schemas: Schemas) -> DataFrame:
    """One line per event: (conv, turn, kind, id, status, place_turn,
    place_depth, valid, faults, line). Events: conv, turn, role, kind
    (message, call, result), id, tool, arguments (JSON text), refs
    (array<string>), text."""
    e = order(link(events)).withColumn("check", validate(F.col("tool"), F.when(F.col("kind") == CALL, F.col("arguments")), schemas))
    call = F.col("kind") == CALL
    valid = F.when(call, F.size("check.faults") == 0)
    event = F.struct("kind", "role", "id", "tool", F.col("check.args").alias("args"), F.col("check.faults").alias("faults"), "text", "status")
    return e.select("conv", "turn", "kind", "id", "status", F.col("place.turn").alias("place_turn"), F.col("place.depth").cast("long").alias("place_depth"),
                    "cyclic", valid.alias("valid"), F.when(call, F.array_join("check.faults", "; ")).alias("faults"), lines(event).alias("line"))

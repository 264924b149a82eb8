"""Linked tool calls: links, schemas, order and canonical lines."""

import json

from tidemark.llm.tool_calls import canonical, faults, format_chat, line

SCHEMA = "conv long, turn long, role string, kind string, id string, tool string, arguments string, refs array<string>, text string, line int"
TOOLS = {"find": {"q": {"type": "string", "required": True, "longest": 5}, "n": {"type": "integer", "least": 1, "most": 9},
                  "how": {"type": "string", "choices": ["a", "b"]}}}


def call(conv, turn, id, args='{"q":"x"}', refs=(), tool="find"):
    return (conv, turn, "assistant", "call", id, tool, args, list(refs), None, 0)


def result(conv, turn, id, text="r"):
    return (conv, turn, "tool", "result", id, None, None, None, text, 0)


def run(spark, rows):
    return format_chat(spark.createDataFrame(rows, SCHEMA).repartition(3), TOOLS).collect()


def test_links_and_order(spark):
    rows = [
        (1, 0, "user", "message", None, None, None, None, "hi é \"q\"", 0),
        call(1, 1, "a", '{"n": 2, "q": "x"}'), result(1, 2, "a"), result(1, 5, "a", "late"), call(1, 6, "a"),
        call(1, 7, "open"), result(1, 8, "none"), result(1, 9, None),
        result(2, 0, "b"), call(2, 3, "b"),                                        # result before its call
        call(3, 0, "x", refs=["y"]), call(3, 1, "y"), result(3, 2, "y"), result(3, 3, "x"),     # call before the result it needs
        call(4, 0, "p", refs=["q"]), result(4, 1, "p"), call(4, 2, "q", refs=["p"]), result(4, 3, "q"),     # cycle
        (None, 0, None, "message", None, None, None, None, None, 0), result(5, 1, "dup"), result(5, 1, "dup"), call(5, 1, "dup"),
    ]
    got = run(spark, rows)
    assert len(got) == len(rows)
    at = {(r.conv, r.turn, r.kind): r for r in got}
    status = {k: r.status for k, r in at.items()}
    assert status[1, 1, "call"] == "answered" and status[1, 2, "result"] == "linked" and status[1, 5, "result"] == "repeated"
    assert status[1, 6, "call"] == "repeated" and status[1, 7, "call"] == "unanswered"
    assert status[1, 8, "result"] == status[1, 9, "result"] == "orphan"
    place = {k: (r.place_turn, r.place_depth) for k, r in at.items()}
    assert place[2, 0, "result"] > place[2, 3, "call"]
    assert place[3, 1, "call"] < place[3, 2, "result"] < place[3, 0, "call"] < place[3, 3, "result"]
    assert place[5, 1, "call"] < place[5, 1, "result"]
    assert not any(r.cyclic for r in got if r.conv != 4)
    assert all(at[4, t, k].cyclic for t, k in ((0, "call"), (1, "result"), (2, "call"), (3, "result")))
    assert at[1, 1, "call"].line == '{"arguments":{"n":2,"q":"x"},"id":"a","kind":"call","role":"assistant","tool":"find","valid":true}'
    assert at[1, 0, "message"].line == '{"content":"hi é \\"q\\"","kind":"message","role":"user"}'
    assert all(canonical(json.loads(r.line)) == r.line for r in got)
    assert run(spark, rows[:0]) == []


def test_long_conversation_and_chain_against_the_turns(spark):
    n = 6
    rows = [call(1, 2 * n - i, f"c{i}", refs=[f"c{i - 1}"] if i else []) for i in range(n)]
    rows += [result(1, 3 * n - i, f"c{i}") for i in range(n)]
    rows += [call(2, 2 * i, str(i)) for i in range(3000)] + [result(2, 2 * i + 1, str(i)) for i in range(3000)]
    got = run(spark, rows)
    place = {(r.conv, r.kind, r.id): (r.place_turn, r.place_depth) for r in got}
    assert not any(r.cyclic for r in got)
    for i in range(n):
        assert place[1, "call", f"c{i}"] < place[1, "result", f"c{i}"]
        if i:
            assert place[1, "result", f"c{i - 1}"] < place[1, "call", f"c{i}"]
    assert all(r.status in ("linked", "answered") for r in got)


def test_schemas():
    assert faults("find", '{"q":"x","n":1,"how":"a"}', TOOLS) == ('{"how":"a","n":1,"q":"x"}', [])
    assert faults("find", '{"n":0,"z":1}', TOOLS)[1] == ["n: out of range", "q: missing", "z: unknown"]
    assert faults("find", '{"q":1,"n":true,"how":"c"}', TOOLS)[1] == ["how: not a choice", "n: not integer", "q: not string"]
    assert faults("find", '{"q":"toolong"}', TOOLS)[1] == ["q: too long"]
    assert faults("other", "{}", TOOLS)[1] == ["unknown tool"]
    assert faults("find", "[1]", TOOLS) == (None, ["not an object"]) and faults("find", "{", TOOLS) == (None, ["not json"])
    assert faults("find", None, TOOLS) == (None, ["not an object"]) and faults("find", '{"q":NaN}', TOOLS)[1] == ["not json"]
    assert line({"kind": "call", "role": "a", "args": None, "faults": ["not json"], "id": "1", "tool": "find"}).startswith('{"arguments":null')


def test_reversed_chain_of_hundreds_beside_cycles(spark):
    """Newest first: every dependency stands later; cycles of other
    conversations, short and long, change nothing."""
    n, m = 150, 25
    rows = [call(1, 2 * (n - i), f"c{i}", refs=[f"c{i - 1}", f"c{i - 2}"][:min(i, 1 + (i % 50 == 2))]) for i in range(n)]
    rows += [result(1, 2 * (n - i) + 1, f"c{i}") for i in range(n)]
    rows += [call(2, 0, "p", refs=["q"]), result(2, 1, "p"), call(2, 2, "q", refs=["p"]), result(2, 3, "q")]
    rows += [call(2, 4, "behind", refs=["q"]), call(2, 5, "free"), result(2, 6, "free")]
    rows += [call(3, i, f"d{i}", refs=[f"d{(i + 1) % m}"]) for i in range(m)] + [result(3, m + i, f"d{i}") for i in range(m)]
    rows += [call(4, 15 - i, f"e{i}", refs=[f"e{i - 1}"] if i else []) for i in range(15)] + [result(4, 30 - i, f"e{i}") for i in range(15)]
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert {(r.conv, r.id) for r in got if r.cyclic} == {(2, "p"), (2, "q"), (2, "behind")} | {(3, f"d{i}") for i in range(m)}
    assert all((r.place_turn, r.place_depth) == (r.turn, 0) for r in got if r.cyclic)
    # the definition, one event after the other
    want = {}
    for conv, size, k in ((1, n, "c"), (4, 15, "e")):
        turn = {(r.kind, r.id): r.turn for r in got if r.conv == conv}
        refs = {r[4]: r[7] for r in rows if r[0] == conv and r[3] == "call"}
        for i in range(size):
            c, on = ("call", f"{k}{i}"), [want[conv, "result", x] for x in refs[f"{k}{i}"]]
            want[(conv, *c)] = max([(turn[c], 0)] + [(t, d + 1) for t, d in on])
            t, d = want[(conv, *c)]
            want[conv, "result", f"{k}{i}"] = max((turn["result", f"{k}{i}"], 0), (t, d + 1))
    assert {(r.conv, r.kind, r.id): (r.place_turn, r.place_depth) for r in got if r.conv in (1, 4)} == want

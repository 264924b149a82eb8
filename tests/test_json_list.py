"""JSON array files read by byte ranges against a parse of the whole file."""

import json
import os
import random
import tempfile

import pytest

from tidemark.sources import json_list as J
from tidemark.sources.requests import flatten_requests, request_defaults


def folder():
    return tempfile.mkdtemp(prefix="tidemark-list-")


def random_value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind < 2:
        return "".join(rng.choice(['"', "\\", "}", "{", "]", "[", ",", "é", "a", "\n", " ", "\\\\", '\\"']) for _ in range(rng.randrange(12)))
    if kind == 2:
        return rng.choice([None, True, 3, -1.5])
    if kind in (3, 4):
        return {f"k{i}{rng.choice(['', '}', chr(34)])}": random_value(rng, depth + 1) for i in range(rng.randrange(4))}
    return [random_value(rng, depth + 1) for _ in range(rng.randrange(4))]


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_whole_file_parse(spark, seed):
    rng, at = random.Random(seed), folder()
    want = {}
    for name in ("a.json", "b.json", "empty.json"):
        items = [] if name == "empty.json" else [{"x": random_value(rng), "n": i} for i in range(rng.randrange(60, 120))]
        with open(os.path.join(at, name), "w") as f:
            f.write(json.dumps(items, ensure_ascii=bool(seed % 2), indent=rng.choice([None, 2])) + rng.choice(["", "\n"]))
        want[name] = items
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "257")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = J.read_json_list(spark, at).collect()
        ranges = J.pieces(spark, at).select("file", "range").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert ranges > 10
    for name, items in want.items():
        mine = sorted((r.position, r.text) for r in got if r.file.endswith(name))
        assert [p for p, _ in mine] == list(range(len(items)))
        assert [json.loads(t) for _, t in mine] == items


def test_state_does_not_depend_on_the_cuts():
    rng = random.Random(9)
    for _ in range(300):
        data = json.dumps([random_value(rng) for _ in range(6)], ensure_ascii=False).encode()
        i, j = sorted(rng.randrange(len(data) + 1) for _ in range(2))
        state, depth, ends = J.OUT, 0, 0
        for part in (data[:i], data[i:j], data[j:]):
            ends += len(J.cut(part, state, depth))
            state, change = J.step(part, state)
            depth += change
        assert (state, depth) == (J.OUT, 0) and ends == len(J.cut(data, J.OUT, 0))


def test_customers_and_damaged_elements(spark):
    at = folder()
    good = [{"CustomerID": f"C{i}", "transactions": [{"Arrival Date": "2024-01-15", "Total Revenue USD": 10 * i, "Channel": "WEB"}] * 2} for i in range(5)]
    with open(os.path.join(at, "list.json"), "w") as f:
        f.write(json.dumps(good))
    with open(os.path.join(at, "cut.json"), "w") as f:
        f.write(json.dumps(good)[:-40])
    with open(os.path.join(at, "odd.json"), "w") as f:
        f.write('[{"CustomerID": "A", "transactions": []}, junk {"CustomerID": "B"}, {"CustomerID": "D"}]')
    rows = J.read_customer_list(spark, at)
    got = {}
    for r in rows.collect():
        got.setdefault(os.path.basename(r.request_id), []).append((r.position, r.customers and r.customers[0].CustomerID, r.error))
    assert sorted(got["list.json"]) == [(i, f"C{i}", None) for i in range(5)]
    assert [x[2] for x in sorted(got["cut.json"])] == [None] * 4 + ["not a customer"]
    assert sorted(got["odd.json"]) == [(0, "A", None), (1, None, "not a customer"), (2, "D", None)]
    visits = flatten_requests(request_defaults(rows)).where("request_id like '%/list.json'")
    assert visits.count() == 10

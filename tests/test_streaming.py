"""Request files scored by a Structured Streaming job (availableNow)."""

import json
import os
import tempfile

from conftest import FIVE_ROWS, SMALL_ROWS, SNAP
from tidemark.plans.models import ModelBundle
from tidemark.streaming import start_scoring_stream


def _write(path, rid, rows):
    cust = {}
    for c, d, r, ch in rows:
        cust.setdefault(c, []).append({"Arrival Date": d, "Total Revenue USD": r, "Channel": ch})
    with open(path, "w") as f:
        f.write(json.dumps({"request_id": rid, "snapshot_date": SNAP, "xdays": 365,
                            "customers": [{"CustomerID": k, "transactions": v} for k, v in cust.items()]}) + "\n")


def test_stream_scores_each_request(spark):
    base = tempfile.mkdtemp(prefix="tidemark-stream-")
    inbox, out, ckpt = (os.path.join(base, d) for d in ("in", "out", "ckpt"))
    os.makedirs(inbox)
    _write(os.path.join(inbox, "r1.json"), "r1", SMALL_ROWS)
    _write(os.path.join(inbox, "r2.json"), "r2", FIVE_ROWS)
    _write(os.path.join(inbox, "r1-again.json"), "r3", [])
    with open(os.path.join(inbox, "broken.json"), "w") as f:
        f.write('{"customers": [\n')
    q = start_scoring_stream(spark, inbox, out, ckpt, ModelBundle())
    q.awaitTermination(120)
    got = spark.read.parquet(out).collect()
    clv = {(r["caller_id"], r["customer_id"]): r["clv"] for r in got}
    assert clv[("r1", "K1")] == 463.85 and clv[("r2", "P5")] == 888.74
    assert len(got) == 8
    bodies = [json.loads(r["body"]) for r in spark.read.json(os.path.join(out, "_responses", "*")).collect()]
    assert sorted(b["count"] for b in bodies) == [0, 0, 3, 5] and sum("error" in b for b in bodies) == 1
    # a second run with no new files adds nothing (progress is checkpointed)
    q2 = start_scoring_stream(spark, inbox, out, ckpt, ModelBundle())
    q2.awaitTermination(120)
    assert spark.read.parquet(out).count() == 8


def test_request_keys_do_not_depend_on_batches_or_ranges(spark):
    """One file or all files a batch, small or large ranges: the key of a
    record is its file and the byte where its line starts."""
    from tidemark.sources.requests import read_requests
    base = tempfile.mkdtemp(prefix="tidemark-keys-")
    inbox = os.path.join(base, "in")
    os.makedirs(inbox)
    want = set()
    for k in range(4):
        path, at = os.path.join(inbox, f"f{k}.json"), 0
        with open(path, "wb") as f:
            for i in range(12):
                line = json.dumps({"request_id": f"é{k}-{i}", "snapshot_date": SNAP, "customers": [{"CustomerID": f"C{i}", "transactions": [
                    {"Arrival Date": "2024-02-10", "Total Revenue USD": 10.0 * (i + 1), "Channel": "WEB"}] * (1 + i % 3)}]}, ensure_ascii=False).encode()
                line += b"\r\n" if i % 4 == 1 else b"\n"
                want.add((f"é{k}-{i}", f"f{k}.json#{at}"))
                f.write(line + (b"\n" if i % 5 == 2 else b""))
                at += len(line) + (i % 5 == 2)
    short = lambda rows: {(r["caller_id"], os.path.basename(r["request_id"])) for r in rows}
    for max_files in (1, 1000):
        out, ckpt = (os.path.join(base, f"{d}{max_files}") for d in ("out", "ckpt"))
        start_scoring_stream(spark, inbox, out, ckpt, ModelBundle(), max_files=max_files).awaitTermination(180)
        assert short(spark.read.parquet(out).collect()) == want
        assert spark.read.parquet(out).select("batch_id").distinct().count() == (4 if max_files == 1 else 1)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    try:
        rows = read_requests(spark, inbox).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert short(rows) == want and all(r["error"] is None for r in rows)

"""Sources and sinks: CSV extract, lenient CSV, file discovery, JSON
requests, CSV/JSON exports and the model store round trip."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_ROWS, SNAP, by_id
from tidemark import sinks
from tidemark.plans.models import fixed_models
from tidemark.sources import read_lenient, read_transactions, training_paths
from tidemark.sources.requests import flatten_requests, read_requests, request_defaults


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="tidemark-io-")


def _write_extract(path, rows, header="CustomerID,Arrival Date,Total Revenue USD,Channel"):
    with open(path, "w") as f:
        f.write(header + "\n")
        for c, d, r, ch in rows:
            f.write(f"{c},{d},{r},{ch or ''}\n")


def test_read_csv_extract(spark, tmp):
    p = os.path.join(tmp, "transactions.csv")
    _write_extract(p, SMALL_ROWS)
    df = read_transactions(spark, p)
    assert df.columns == ["txn_id", "customer_id", "arrival_ts", "revenue", "channel"]
    assert df.count() == 6 and df.where(F.col("arrival_ts").isNull()).count() == 0
    assert df.select("txn_id").distinct().count() == 6


def test_read_lenient_untidy_headers(spark, tmp):
    p = os.path.join(tmp, "x.csv")
    _write_extract(p, [("A", "2024-01-01", "12.5", "WEB"), ("B", "garbage", "3", "GDS"),
                       ("C", "2024-02-01", "n/a", None)],
                   header=" CustomerID , Arrival Date ,Booking Amount, Channel ")
    df = read_lenient(spark, p).collect()
    by = {r["customer_id"]: r for r in df}
    assert by["A"]["revenue"] == 12.5 and by["B"]["arrival_ts"] is None and by["C"]["revenue"] == 0.0


def test_columns_are_taken_by_name(spark, tmp):
    """Reordered, extra and missing columns; two files in different order."""
    with open(os.path.join(tmp, "a.csv"), "w") as f:
        f.write("Channel,Market Seg,Arrival Date,Total Revenue USD,CustomerID\nWEB,m,2024-01-01,10,C1\nGDS,m,2024-01-02,NaN,C2\n")
    with open(os.path.join(tmp, "b.csv"), "w") as f:
        f.write("CustomerID,Arrival Date,Total Revenue USD\nC3,2024-02-01,30\n")
    got = by_id(read_transactions(spark, tmp))
    assert got["C1"]["channel"] == "WEB" and got["C1"]["revenue"] == 10.0
    assert got["C2"]["revenue"] is None and got["C3"]["revenue"] == 30.0 and got["C3"]["channel"] is None
    got = by_id(read_lenient(spark, tmp))
    assert got["C3"]["revenue"] == 30.0 and got["C2"]["revenue"] == 0.0
    with open(os.path.join(tmp, "c.csv"), "w") as f:
        f.write("CustomerID,Total Revenue USD\nC9,1\n")
    with pytest.raises(ValueError, match="Arrival Date"):
        read_transactions(spark, tmp)


def test_lenient_keeps_its_date_columns(spark, tmp):
    p = os.path.join(tmp, "x.csv")
    with open(p, "w") as f:
        f.write("CustomerID,Arrival Date,Departure Date,Booked Date,Amount\nA,2024-01-01,2024-01-03,bad,5\n")
    r = read_lenient(spark, p).collect()[0]
    assert str(r["Departure Date"]).startswith("2024-01-03") and r["Booked Date"] is None and r["revenue"] == 5.0


@pytest.mark.parametrize("clean", ["clean_strict", "clean_lenient"])
def test_nan_revenue_is_missing(spark, clean):
    from tidemark.operators import cleaning
    df = spark.createDataFrame([("A", "2024-01-01", float("nan")), ("A", "2024-01-02", 5.0)], "customer_id string, d string, revenue double")
    df = df.withColumn("arrival_ts", F.col("d").cast("timestamp_ntz"))
    assert [r["revenue"] for r in getattr(cleaning, clean)(df, SNAP).collect()] == [5.0]


def test_training_file_discovery(spark, tmp):
    with pytest.raises(FileNotFoundError):
        training_paths(tmp)
    for n in ("b.csv", "a.csv", "notes.txt"):
        open(os.path.join(tmp, n), "w").close()
    assert [os.path.basename(p) for p in training_paths(tmp)] == ["a.csv", "b.csv"]
    open(os.path.join(tmp, "data.csv"), "w").close()
    assert [os.path.basename(p) for p in training_paths(tmp)] == ["data.csv"]


def test_request_file_multiline(spark, tmp):
    body = {"snapshot_date": SNAP, "xdays": 365, "customers": [
        {"CustomerID": "C001", "transactions": [{"Arrival Date": "2024-01-15", "Total Revenue USD": 500,
                                                 "Channel": "WEB"}]}]}
    p = os.path.join(tmp, "req.json")
    with open(p, "w") as f:
        json.dump(body, f, indent=2)
    rows = flatten_requests(request_defaults(read_requests(spark, p, multiline=True))).collect()
    assert len(rows) == 1 and rows[0]["customer_id"] == "C001" and rows[0]["revenue"] == 500.0


def test_csv_export_round_trip(spark, tmp, small):
    out = os.path.join(tmp, "clv")
    sinks.write_csv(small, out)
    back = sinks.read_csv_back(spark, out)
    assert back.count() == 6 and set(back.columns) == set(small.columns)


def test_model_store_round_trip(spark, tmp):
    b = fixed_models(per_channel=True)
    sinks.save_models(spark, b, os.path.join(tmp, "models"))
    got = sinks.load_models(spark, os.path.join(tmp, "models"))
    assert got.bgnbd == b.bgnbd and got.gamma_gamma == b.gamma_gamma
    assert got.cox.coef == b.cox.coef and got.cox.baseline == b.cox.baseline
    assert set(got.cox_by_channel) == set(b.cox_by_channel)


def test_missing_model_store_falls_back(spark, tmp):
    got = sinks.load_models(spark, os.path.join(tmp, "nothing-here"))
    assert got.cox is None and got.bgnbd is None and got.gamma_gamma is None


def test_model_config_and_damaged_store(spark, tmp):
    from dataclasses import replace
    b = replace(fixed_models(), config={"snapshot_date": "2024-05-05", "xdays": 90, "penalizer": 0.5})
    path = os.path.join(tmp, "models")
    sinks.save_models(spark, b, path)
    assert sinks.load_models(spark, path).config == b.config
    for name in os.listdir(os.path.join(path, "params")):
        if name.startswith("part-"):
            with open(os.path.join(path, "params", name), "w") as f:
                f.write("not json\n")
        elif name.endswith(".crc"):
            os.remove(os.path.join(path, "params", name))
    with pytest.raises(Exception):
        sinks.load_models(spark, path)


def test_cox_without_baseline_is_an_error(spark, tmp):
    from dataclasses import replace
    b = fixed_models()
    b.cox = replace(b.cox, baseline=())
    sinks.save_models(spark, b, os.path.join(tmp, "m"))
    with pytest.raises(ValueError, match="baseline"):
        sinks.load_models(spark, os.path.join(tmp, "m"))


def test_jobs_train_score_analyze(spark, tmp):
    """The spark-submit entry points end to end on a small CSV extract."""
    import random
    from tidemark import jobs
    rnd = random.Random(3)
    rows = []
    for c in range(60):
        for _ in range(rnd.randint(1, 4)):
            rows.append((f"C{c:03d}", f"2024-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}",
                         round(rnd.uniform(50, 900), 2), rnd.choice(["WEB", "GDS", "RL", "CHOPRA"])))
    inp = os.path.join(tmp, "in")
    os.makedirs(inp)
    _write_extract(os.path.join(inp, "transactions.csv"), rows)
    md = os.path.join(tmp, "models")
    assert jobs.main(["train", "--input", inp, "--snapshot", SNAP, "--model-dir", md,
                      "--bgnbd-penalizer", "0.001"]) == 0
    req = os.path.join(tmp, "req.json")
    with open(req, "w") as f:
        f.write(json.dumps({"request_id": "r", "snapshot_date": SNAP, "customers": [
            {"CustomerID": "C001", "transactions": [{"Arrival Date": "2024-03-01", "Total Revenue USD": 100.0}]}]}) + "\n")
    out = os.path.join(tmp, "scored")
    assert jobs.main(["score", "--requests", req, "--model-dir", md, "--out", out]) == 0
    body = json.loads(spark.read.text(os.path.join(out, "responses")).collect()[0][0])
    assert body["count"] == 1
    out2 = os.path.join(tmp, "analysis")
    assert jobs.main(["analyze", "--input", inp, "--snapshot", SNAP, "--model-dir", md, "--out", out2]) == 0
    assert spark.read.option("header", True).csv(os.path.join(out2, "customer_clv")).count() == 60

"""Scoring requests (main, lenient, no-model), request parsing edge cases."""

import json

from conftest import FIVE_ROWS, SMALL_ROWS, SNAP
from tidemark import config as C
from tidemark.plans.models import ModelBundle, fixed_models
from tidemark.plans.scoring import response_json, score_customers
from tidemark.sources import requests as RQ


def _request(rows, rid="r1", snapshot=SNAP, xdays=365, drop_channel=False):
    cust = {}
    for c, d, r, ch in rows:
        t = {"Arrival Date": d, "Total Revenue USD": r}
        if not drop_channel:
            t["Channel"] = ch
        cust.setdefault(c, []).append(t)
    body = {"request_id": rid, "snapshot_date": snapshot, "xdays": xdays,
            "customers": [{"CustomerID": k, "transactions": v} for k, v in cust.items()]}
    return json.dumps(body)


def _rows(spark, *bodies):
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    return RQ.flatten_requests(RQ.request_defaults(RQ.parse_requests(df)))


def test_fallback_clv_small(spark):
    got = {r["customer_id"]: r for r in score_customers(_rows(spark, _request(SMALL_ROWS)), ModelBundle()).collect()}
    assert got["K1"]["clv"] == 463.85 and got["K3"]["clv"] == 1425.78 and got["K2"]["clv"] == 26.0
    assert got["K2"]["group"] == C.GROUP_ONETIMER and got["K2"]["p_return"] == 0.1
    assert got["K1"]["p_alive"] == 0.5 and got["K1"]["frequency"] == 1 and got["K1"]["recency"] == 142.0
    assert got["K3"]["segment"] == "Champions"


def test_fallback_clv_five(spark):
    got = {r["customer_id"]: r["clv"] for r in
           score_customers(_rows(spark, _request(FIVE_ROWS)), ModelBundle()).collect()}
    assert got == {"P1": 463.85, "P2": 26.0, "P3": 1425.78, "P4": 210.0, "P5": 888.74}


def test_requests_are_independent(spark):
    a = _request(SMALL_ROWS, rid="a")
    b = _request(FIVE_ROWS, rid="b")
    both = {(r["caller_id"], r["customer_id"]): r["rfm_score"]
            for r in score_customers(_rows(spark, a, b), fixed_models()).collect()}
    alone = {("a", r["customer_id"]): r["rfm_score"] for r in score_customers(_rows(spark, a), fixed_models()).collect()}
    assert all(both[k] == v for k, v in alone.items())


def test_missing_channel_is_unknown(spark):
    rows = _rows(spark, _request([("C9", "2024-01-01", 100, None)], drop_channel=True))
    assert rows.collect()[0]["channel"] == "Unknown"
    p = score_customers(rows, ModelBundle()).collect()
    assert len(p) == 1 and p[0]["group"] == C.GROUP_ONETIMER


def test_empty_customer_list(spark):
    body = json.dumps({"snapshot_date": SNAP, "customers": []})
    rows = _rows(spark, body)
    assert rows.count() == 0
    assert score_customers(rows, ModelBundle()).count() == 0


def test_defaults_and_zero_xdays(spark):
    body = json.dumps({"xdays": 0, "customers": [{"CustomerID": "A", "transactions": [
        {"Arrival Date": "2024-01-01", "Total Revenue USD": 5.0}]}]})
    r = RQ.request_defaults(RQ.parse_requests(spark.createDataFrame([(body,)], "body string"))).collect()[0]
    assert r["xdays"] == C.DEFAULT_XDAYS and str(r["snapshot_ts"]).startswith(C.DEFAULT_SNAPSHOT)
    r2 = RQ.request_defaults(RQ.parse_requests(spark.createDataFrame([(body,)], "body string")),
                             zero_is_missing=False).collect()[0]
    assert r2["xdays"] == 0


def test_lenient_constants(spark):
    got = score_customers(_rows(spark, _request(FIVE_ROWS)), ModelBundle(), lenient=True).collect()
    assert {r["rfm_score"] for r in got} == {9} and {r["mismatch"] for r in got} == {"Aligned"}
    assert all(r["p_alive"] is None for r in got)


def test_response_body(spark):
    p = score_customers(_rows(spark, _request(SMALL_ROWS)), ModelBundle())
    body = json.loads(response_json(p).collect()[0]["body"])
    assert body["count"] == 3 and len(body["predictions"]) == 3
    one = [x for x in body["predictions"] if x["group"] == "onetimer"][0]
    assert set(one) == {"CustomerID", "CLV", "group", "P_return", "avg_spend", "RFM_Score", "Segment", "CLV_Level", "Mismatch"}


def test_score_single(spark):
    from tidemark.plans.scoring import score_single
    r = score_single(spark, "K1", [{"Arrival Date": d, "Total Revenue USD": v, "Channel": ch}
                                     for c, d, v, ch in SMALL_ROWS if c == "K1"], ModelBundle(), SNAP)
    assert r["clv"] == 463.85
    assert score_single(spark, "C404", [], ModelBundle(), SNAP) is None


def test_lenient_training_then_scoring(spark):
    """Lenient pipeline end to end on the smallest test tables: train with
    the ridge penalizer (separation), then score lenient requests."""
    from tidemark.plans.catalog import request_rows
    from tidemark.plans.training import train_lenient
    from tidemark.sources import testdata_transactions
    sf = "/root/testdata/sf0.001"
    models, table = train_lenient(testdata_transactions(spark, sf), "1996-01-01", penalizer=0.1,
                                  bgnbd_penalizer=0.001)
    assert models.cox.features == ("avg_revenue", "tx_count") and all(map(lambda c: c == c, models.cox.coef))
    preds = score_customers(request_rows(spark, sf), models, lenient=True).collect()
    assert preds and all(r["clv"] is not None and r["clv"] >= 0 for r in preds)
    assert {r["mismatch"] for r in preds} == {"Aligned"}


def _answers(spark, bodies):
    reqs = RQ.request_defaults(RQ.parse_requests(spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "k string, body string"), "body", "k"))
    preds = score_customers(RQ.flatten_requests(reqs), ModelBundle())
    out = {r["request_id"]: json.loads(r["body"]) for r in response_json(preds, reqs).collect()}
    return out, reqs


def test_equal_bodies_empty_and_broken_requests_each_get_an_answer(spark):
    good = _request(SMALL_ROWS)
    out, reqs = _answers(spark, [good, good, '{"customers": []}', '{"customers": [{"Cust', good.replace("2025-06-04", "someday"),
                                 json.dumps(json.loads(good)["customers"]), "  "])
    assert set(out) == {"0", "1", "2", "3", "4", "5"}
    assert out["0"] == out["1"] and out["0"]["count"] == 3
    assert out["2"] == {"predictions": [], "count": 0}
    assert out["3"]["error"] == "not a request" and out["4"]["error"] == "unreadable snapshot_date" and out["4"]["count"] == 0
    assert {p["CustomerID"] for p in out["5"]["predictions"]} == {"K1", "K2", "K3"}
    assert {r["request_id"] for r in RQ.rejected_requests(reqs).collect()} == {"3", "4"}


def test_unreadable_visit_date_is_rejected_not_scored(spark):
    body = json.dumps({"customers": [{"CustomerID": "A", "transactions": [
        {"Arrival Date": "2024-01-01", "Total Revenue USD": 5.0}, {"Arrival Date": "no day", "Total Revenue USD": 9.0}]},
        {"CustomerID": "B", "transactions": [{"Arrival Date": None, "Total Revenue USD": 9.0}]}]})
    out, reqs = _answers(spark, [body])
    assert [p["CustomerID"] for p in out["0"]["predictions"]] == ["A"]
    assert sorted(r["customer_id"] for r in RQ.rejected_visits(reqs).collect()) == ["A", "B"]


def test_many_horizons(spark):
    """Every customer of 1,500 requests has a horizon of its own."""
    from tidemark.plans.models import fixed_models
    bodies = [json.dumps({"xdays": i + 1, "customers": [{"CustomerID": "A", "transactions": [{"Arrival Date": "2024-01-01", "Total Revenue USD": 5.0}]}]})
              for i in range(1500)]
    reqs = RQ.request_defaults(RQ.parse_requests(spark.createDataFrame([(b,) for b in bodies], "body string")))
    m = fixed_models()
    got = score_customers(RQ.flatten_requests(reqs), m).select("p_return").collect()
    assert len(got) == 1500 and len({r[0] for r in got}) > 500


def test_defaults_come_from_the_models_config(spark):
    r = RQ.request_defaults(RQ.parse_requests(spark.createDataFrame([('{"customers": []}',)], "body string")),
                            config={"snapshot_date": "2020-02-02", "xdays": 77}).collect()[0]
    assert r["xdays"] == 77 and str(r["snapshot_ts"]).startswith("2020-02-02")

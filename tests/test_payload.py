"""Payload validation and summary (rules in order, first failure wins)."""

import json

import pytest

from pulseframe.operators.payload import classify_payloads, summarize_payloads

VALID = {
    "data": {
        "metrics": [
            {"name": "step_count", "units": "count",
             "data": [{"date": "2026-07-20 08:00:00 +0200", "qty": 120}]},
            {"name": "heart_rate", "units": "count/min",
             "data": [{"date": "2026-07-20 08:00:00 +0200", "Avg": 70, "Min": 60, "Max": 90}]},
        ],
        "workouts": [{"name": "walk"}],
    }
}


def body(obj):
    return json.dumps(obj)


def with_data(**kw):
    d = json.loads(json.dumps(VALID))
    d["data"].update(kw)
    return body(d)


CASES = [
    ("valid", body(VALID), 0),
    ("empty body", "", 1),
    ("invalid json", "{not json", 2),
    ("array at top level", body([VALID]), 3),
    ("json null", "null", 3),
    ("no data", body({"other": 1}), 4),
    ("data a string", body({"data": "x"}), 4),
    ("data null", body({"data": None}), 4),
    ("no metrics", body({"data": {"workouts": []}}), 5),
    ("empty metrics", with_data(metrics=[]), 5),
    ("metrics a string", with_data(metrics="m"), 5),
    ("metric a string", with_data(metrics=["junk"]), 6),
    ("metric without name", with_data(metrics=[{"units": "x", "data": []}]), 7),
    ("metric name empty", with_data(metrics=[{"name": "", "data": []}]), 7),
    ("metric without data array", with_data(metrics=[{"name": "a", "data": {}}]), 8),
    ("rule order pair", with_data(metrics=[{"name": "a"}, "junk"]), 8),
    ("no workouts", body({"data": {"metrics": VALID["data"]["metrics"]}}), 0),
    ("workouts null", with_data(workouts=None), 0),
    ("workouts an object", with_data(workouts={}), 9),
    ("inner-only shape", body({"metrics": VALID["data"]["metrics"]}), 4),
    ("trailing text", body(VALID) + " x", 2),
    ("two documents", body(VALID) + body(VALID), 2),
    ("closing bracket after the document", body(VALID) + "]", 2),
    ("closing bracket and text", body(VALID) + "] x", 2),
    ("spoofed second element", body(VALID) + ',"x"', 2),
    ("single quotes", body(VALID).replace('"', "'"), 2),
    ("cut off", body(VALID)[:-3], 2),
    ("duplicate keys", '{"data":"first",' + body(VALID)[1:], 0),
    ("bare NaN", body(VALID).replace("120", "NaN"), 0),
    ("white space around", " \n" + body(VALID) + "\t", 0),
    ("data as text of an object", body({"data": json.dumps(VALID["data"])}), 4),
    ("metric null", with_data(metrics=[None]), 6),
    ("workouts as text of an array", with_data(workouts="[1]"), 9),
    ("string of over 20 million characters", with_data(note="x" * 20_500_000), 0),
]


@pytest.fixture(scope="module")
def classified(spark):
    df = spark.createDataFrame([(n, b) for n, b, _ in CASES], "name string, body string")
    return {r["name"]: r for r in classify_payloads(df).collect()}


@pytest.mark.parametrize("name,raw,rule", CASES, ids=[c[0] for c in CASES])
def test_rule(classified, name, raw, rule):
    r = classified[name]
    assert r["rule"] == rule
    assert r["is_valid"] == (rule == 0)
    assert (r["reason"] is None) == (rule == 0)


def test_metric_index_points_at_first_bad_metric(spark):
    b = with_data(metrics=[VALID["data"]["metrics"][0], {"name": "x", "data": 1}, "junk"])
    r = classify_payloads(spark.createDataFrame([(b,)], "body string")).first()
    assert (r["rule"], r["metric_index"]) == (8, 1)


def test_null_body_is_empty(spark):
    r = classify_payloads(spark.createDataFrame([(None,)], "body string")).first()
    assert r["rule"] == 1


def test_summaries_of_many_bodies_count_each_on_its_own(spark):
    names = ["vo2_max", "height", "height", "sleep_analysis", "blood_pressure"]
    docs = [{"data": {"metrics": [{"name": n, "data": [{}] * k} for n in names[k:]], "workouts": [{}] * (3 * k)}} for k in range(4)]
    df = spark.createDataFrame([(k, body(d)) for k, d in enumerate(docs)], "k int, body string")
    got = {r["k"]: (r["metric_count"], r["workout_count"], r["metric_names"]) for r in summarize_payloads(df).collect()}
    assert got == {k: (5 - k, 3 * k, sorted(set(names[k:]))) for k in range(4)}


def test_summary_without_workouts_and_falsy_names(spark):
    b = body({"data": {"metrics": [{"name": "b", "data": []}, {"name": "", "data": []},
                                   {"name": "a", "data": []}, {"name": "b", "data": []}]}})
    r = summarize_payloads(spark.createDataFrame([(b,)], "body string")).first()
    assert r["workout_count"] == 0
    assert r["metric_count"] == 4
    assert r["metric_names"] == ["a", "b"]


def test_quarantine_one_pass(spark):
    from pulseframe.operators.payload import landable, quarantine, quarantined
    df = spark.createDataFrame([("ok.json", body(VALID)), ("bad.json", "{x")], "f string, body string")
    q = quarantine(df)
    ok = landable(q).collect()
    assert [r["f"] for r in ok] == ["ok.json"] and json.loads(ok[0]["data"]) == VALID["data"]
    bad = quarantined(q).collect()
    assert [(r["f"], r["_rescued_data"], r["reason"]) for r in bad] == [("bad.json", "{x", "invalid_json")]

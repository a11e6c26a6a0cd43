"""Flatten, latest-wins dedup and the staging projection (traps T1-T4, T15-T20)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from pulseframe.operators.flatten import explode_readings
from pulseframe.operators.latest import latest_readings, stage_readings


def bronze(spark, docs):
    """docs: list of (file, ingested_at, doc-dict-or-text)."""
    rows = [(d if isinstance(d, str) else json.dumps(d), None, dt.datetime.fromisoformat(t), f)
            for f, t, d in docs]
    return spark.createDataFrame(rows, "data string, _rescued_data string, _ingested_at timestamp, _source_file string")


def doc(*metrics):
    return {"metrics": [{"name": n, "units": u, "data": rs} for n, u, rs in metrics]}


def test_reading_shapes(spark):
    d = doc(("step_count", "Count", [
        {"date": "2026-07-20 08:00:00 +0200", "qty": 10},
        {"date": "2026-07-20 09:00:00 +0200", "qty": "1.5"},
        {"date": "2026-07-20 10:00:00 +0200", "qty": "x"},
        {"date": "2026-07-20 11:00:00 +0200", "qty": True},
        {"date": "bad", "qty": 3},
        {"date": "2026-07-20 12:00:00 Z", "qty": 4},
    ]), ("heart_rate", "count/min", [
        {"date": "2026-07-20 08:00:00 +0200", "Avg": 70.5, "Min": 60, "Max": 90},
        {"date": "2026-07-20 09:00:00 +0200", "avg": 71, "min": 61, "max": 91},
    ]), ("sleep_analysis", "hr", [
        {"date": "2026-07-20 00:00:00 +0200", "core": 3.5, "rem": 1.2, "totalSleep": 6},
    ]))
    rows = explode_readings(bronze(spark, [("f1.json", "2026-07-21 05:00:00", d)])).collect()
    assert len(rows) == 9
    q = {r["date"]: r["value_qty"] for r in rows if r["metric_name"] == "step_count"}
    assert q[dt.datetime(2026, 7, 20, 6)] == 10.0
    assert q[dt.datetime(2026, 7, 20, 7)] == 1.5
    assert q[dt.datetime(2026, 7, 20, 8)] is None      # "x"
    assert q[dt.datetime(2026, 7, 20, 9)] is None      # true goes through text -> NULL
    assert q[None] == 3.0                              # unparseable date
    assert q[dt.datetime(2026, 7, 20, 12)] == 4.0      # 'Z' offset accepted
    hr = sorted((r["value_avg"], r["value_min"], r["value_max"]) for r in rows if r["metric_name"] == "heart_rate")
    assert hr == [(70.5, 60.0, 90.0), (71.0, 61.0, 91.0)]
    sleep = [r for r in rows if r["metric_name"] == "sleep_analysis"][0]
    assert sleep["value_qty"] is None and sleep["value_avg"] is None
    assert json.loads(sleep["value_raw"])["core"] == 3.5


def test_wrapped_and_unparseable_documents(spark):
    d = doc(("step_count", "Count", [{"date": "2026-07-20 08:00:00 +0200", "qty": 1}]))
    b = bronze(spark, [("a.json", "2026-07-21 05:00:00", d),
                       ("b.json", "2026-07-21 05:00:00", {"data": d}),
                       ("c.json", "2026-07-21 05:00:00", "{broken"),
                       ("d.json", "2026-07-21 05:00:00", {"data": {"payload": d}})])
    files = sorted(r["source_file"] for r in explode_readings(b).collect())
    assert files == ["a.json", "b.json"]


def test_latest_wins_and_ties(spark):
    t = "2026-07-20 08:00:00 +0200"
    b = bronze(spark, [
        ("old.json", "2026-07-21 05:00:00", doc(("step_count", "Count", [{"date": t, "qty": 50}]))),
        ("new.json", "2026-07-22 05:00:00", doc(("step_count", "Count", [{"date": t, "qty": 40}]))),
        # same file twice the same key: the larger value wins the tie
        ("tie.json", "2026-07-23 05:00:00", doc(("heart_rate", "bpm", [
            {"date": t, "Avg": 60}, {"date": t, "Avg": 65}]))),
    ])
    base = {r["metric_name"]: r for r in latest_readings(explode_readings(b)).collect()}
    assert base["step_count"]["value_qty"] == 40.0
    assert base["step_count"]["source_file"] == "new.json"
    assert base["heart_rate"]["value_avg"] == 65.0


def test_dedup_is_order_independent(spark):
    t = "2026-07-20 08:00:00 +0200"
    docs = [(f"f{i}.json", f"2026-07-2{i} 05:00:00", doc(("step_count", "Count", [{"date": t, "qty": i}])))
            for i in range(1, 6)]
    a = latest_readings(explode_readings(bronze(spark, docs))).first()
    b = latest_readings(explode_readings(bronze(spark, list(reversed(docs))).repartition(3))).first()
    assert a["value_qty"] == b["value_qty"] == 5.0


def test_staging_local_date_and_rollup(spark):
    b = bronze(spark, [("f.json", "2026-07-21 05:00:00", doc(("step_count", "COUNT", [
        {"date": "2026-07-20 00:00:00 +0200", "qty": 1000},   # rollup; UTC day is 07-19
        {"date": "2026-07-20 01:30:00 +0200", "qty": 10},
        {"date": "bad", "qty": 3},
    ]), (None, "x", [{"date": "2026-07-20 02:00:00 +0200", "qty": 1}])))])
    stg = stage_readings(latest_readings(explode_readings(b))).orderBy("metric_timestamp").collect()
    assert len(stg) == 2
    assert all(r["metric_date"] == dt.date(2026, 7, 20) for r in stg)
    assert [r["is_daily_rollup"] for r in stg] == [True, False]
    assert stg[0]["units"] == "count"
    assert stg[0]["metric_timestamp"] == dt.datetime(2026, 7, 19, 22)


def test_spread_gives_same_rows(spark):
    d = doc(("step_count", "Count", [{"date": f"2026-07-20 {h:02d}:00:00 +0200", "qty": h} for h in range(24)]))
    b = bronze(spark, [("big.json", "2026-07-21 05:00:00", d)])
    plain = sorted(map(tuple, explode_readings(b).collect()), key=repr)
    spread = explode_readings(b, spread=4)
    assert sorted(map(tuple, spread.collect()), key=repr) == plain

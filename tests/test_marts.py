"""Marts: rollup preference, weekly lag, weight seeds and ISO weeks, freshness."""

import datetime as dt

import pytest

from pulseframe.functions.columns import change_display, iso_year_week
from pulseframe.plans import marts

STG = ("metric_name string, metric_date date, value double, is_daily_rollup boolean, "
       "ingested_at timestamp")


def stg(spark, rows):
    ts = dt.datetime(2026, 7, 21)
    return spark.createDataFrame([(m, d, v, r, ts) for m, d, v, r in rows], STG)


D = dt.date


def test_daily_values_prefer_rollup(spark):
    rows = [
        ("step_count", D(2026, 7, 20), 1000.0, True), ("step_count", D(2026, 7, 20), 400.0, False),
        ("step_count", D(2026, 7, 21), 100.0, False), ("step_count", D(2026, 7, 21), 50.0, False),
        ("heart_rate", D(2026, 7, 21), 60.0, False), ("heart_rate", D(2026, 7, 21), 80.0, False),
        ("sleep_analysis", D(2026, 7, 21), None, True), ("sleep_analysis", D(2026, 7, 21), 5.0, False),
        ("step_count", D(2026, 7, 22), 900.0, True), ("step_count", D(2026, 7, 22), 1200.0, True),
    ]
    got = {(r["metric_name"], r["metric_date"]): r["daily_value"]
           for r in marts.daily_values(stg(spark, rows)).collect()}
    assert got[("step_count", D(2026, 7, 20))] == 1000.0          # rollup, not 1400
    assert got[("step_count", D(2026, 7, 21))] == 150.0           # cumulative: sum
    assert got[("heart_rate", D(2026, 7, 21))] == 70.0            # others: average
    assert got[("sleep_analysis", D(2026, 7, 21))] is None        # null rollup, no fallback
    assert got[("step_count", D(2026, 7, 22))] == 1200.0          # two rollups: max


def test_daily_summary_counts_metrics_with_null_values(spark):
    rows = [("step_count", D(2026, 7, 20), 10.0, False), ("sleep_analysis", D(2026, 7, 20), None, True)]
    r = marts.daily_summary(stg(spark, rows)).first()
    assert r["total_steps"] == 10.0 and r["metrics_present"] == 2


def test_weekly_trends_lag_takes_previous_present_week(spark):
    daily = spark.createDataFrame([
        (D(2026, 7, 6), 100.0, 10.0, 50.0),
        (D(2026, 7, 13), 0.0, 0.0, 55.0),      # zero previous week next
        (D(2026, 7, 27), 300.0, 30.0, 53.0),   # week of 07-20 missing
    ], "metric_date date, total_steps double, active_energy_kcal double, resting_heart_rate_bpm double")
    for c in ("exercise_minutes", "avg_heart_rate_bpm"):
        daily = daily.withColumn(c, daily.total_steps * 0)
    rows = marts.weekly_trends(daily).orderBy("week_start").collect()
    assert [r["week_start"] for r in rows] == [dt.datetime(2026, 7, 6), dt.datetime(2026, 7, 13),
                                               dt.datetime(2026, 7, 27)]
    assert rows[0]["steps_change_vs_prev_week"] is None
    assert rows[1]["steps_pct_change_vs_prev_week"] == -100.0
    assert rows[2]["steps_change_vs_prev_week"] == 300.0
    assert rows[2]["steps_pct_change_vs_prev_week"] is None      # previous week was zero
    assert rows[2]["resting_hr_change_vs_prev_week"] == -2.0


def test_weekly_weight_seeds_and_iso_weeks(spark):
    rows = [("weight_body_mass", D(2027, 1, 4), 90.0, False),
            ("weight_body_mass", D(2027, 1, 5), 89.0, False),
            ("weight_body_mass", D(2027, 1, 5), 89.5, False),       # max of the day
            ("body_fat_percentage", D(2027, 1, 5), 20.0, False),
            ("weight_body_mass", D(2027, 1, 11), 89.25, False)]
    out = marts.weekly_weight(stg(spark, rows)).orderBy("week_end_date").collect()
    # seeds on 2027-01-01..03 (ISO 2026-W53), then two real weeks
    assert [r["year_week"] for r in out] == ["2026-W53", "2027-W01", "2027-W02"]
    assert out[0]["weight_kg"] == pytest.approx((90.70 + 90.30 + 89.70) / 3, abs=0.005)
    assert out[1]["weight_kg"] == 89.75
    assert out[2]["weekly_weight_change_kg"] == -0.5
    assert out[1]["body_fat_pct"] == 20.0 and out[2]["weekly_body_fat_change_pp"] is None


def test_weekly_weight_without_weight_has_no_seed_rows(spark):
    rows = [("body_fat_percentage", D(2027, 1, 5), 20.0, False)]
    out = marts.weekly_weight(stg(spark, rows)).collect()
    assert len(out) == 1 and out[0]["weight_kg"] is None


def test_change_display(spark):
    df = spark.createDataFrame([(-0.5,), (0.25,), (0.0,), (-0.001,), (None,)], "x double")
    got = [r[0] for r in df.select(change_display("x")).collect()]
    assert got[0].startswith("-0.5 ") and "color:red" in got[0]
    assert got[1].startswith("0.25 ") and "color:green" in got[1]
    assert "color:orange" in got[2]
    assert "color:red" in got[3]          # sign from the unrounded value
    assert got[4] is None


def test_iso_year_week(spark):
    df = spark.createDataFrame([(D(2027, 1, 1),), (D(2024, 12, 30),), (D(2026, 1, 19),)], "d date")
    assert [r[0] for r in df.select(iso_year_week("d")).collect()] == ["2026-W53", "2025-W01", "2026-W04"]


def test_metric_freshness(spark):
    rows = [("step_count", D(2026, 7, 1), 1.0, False), ("step_count", D(2026, 7, 10), 1.0, False),
            ("step_count", D(2026, 7, 10), 2.0, False), ("vo2_max", D(2026, 7, 5), 40.0, False)]
    got = {r["metric_name"]: r for r in marts.metric_freshness(stg(spark, rows), as_of="2026-07-15").collect()}
    s = got["step_count"]
    assert (s["datapoint_count"], s["days_with_data"], s["calendar_days_span"]) == (3, 2, 10)
    assert s["coverage_pct"] == 20.0 and s["days_since_last_data"] == 5
    assert got["vo2_max"]["coverage_pct"] == 100.0

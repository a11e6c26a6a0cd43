"""The weekly marts kept up to date week by week equal a full build."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pulseframe.plans import marts, weekly

MONDAY = dt.date(2024, 1, 1)
DAILY = ("subject long, metric_date date, total_steps double, active_energy_kcal double, exercise_minutes double, "
         "avg_heart_rate_bpm double, resting_heart_rate_bpm double")
WEIGHT = "subject long, metric_date date, weight_kg double, body_fat_pct double"


def rows_of(df):
    names = sorted(df.columns)
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(names).collect()), key=repr)


class Days:
    """Per-day rows of some subjects that change step by step."""

    def __init__(self, spark, schema, by):
        self.spark, self.schema, self.by, self.rows = spark, schema, by, {}

    def put(self, *changes):
        for day, subject, *values in changes:
            self.rows[subject, day] = (subject, MONDAY + dt.timedelta(days=day), *values)
        return self.spark.createDataFrame([(MONDAY + dt.timedelta(days=c[0]),) for c in changes], "metric_date date")

    def frame(self):
        df = self.spark.createDataFrame(list(self.rows.values()), self.schema)
        return df if self.by else df.drop("subject")


def steps(day, subject, n, rest=55.0):
    return day, subject, float(n), 1.0, 2.0, 60.0, rest


@pytest.mark.parametrize("by", [(), ("subject",)])
def test_trends_follow_the_next_present_week(spark, tmpdir_path, by):
    days = Days(spark, DAILY, by)
    other = 2 if by else 1
    days.put(*[steps(7 * k, s, 10 + k) for k in (0, 1, 4, 9) for s in {1, other}])
    path = os.path.join(tmpdir_path, "w")
    weekly.write_trends(days.frame(), path, by)
    before = os.stat(os.path.join(path, "week=2024-03-04")).st_mtime_ns
    cases = [([steps(15, 1, 3)], {"2024-01-15", "2024-01-29"}),       # a week between two others
             ([steps(8, 1, 4)], {"2024-01-08", "2024-01-15"} | ({"2024-01-29"} if by else set())),
             ([steps(-3, None if by else 1, 5)], {"2023-12-25"} | (set() if by else {"2024-01-01"})),  # before all
             ([steps(300, 1, 6)], {"2024-10-21"})]                     # after all
    for changes, weeks in cases:
        touched = days.put(*changes)
        written = weekly.merge_trends(spark, path, days.frame(), touched, by)
        assert {str(w) for w in written} == weeks
        assert rows_of(weekly.read_weeks(spark, path)) == rows_of(marts.weekly_trends(days.frame(), by))
    assert os.stat(os.path.join(path, "week=2024-03-04")).st_mtime_ns == before


@pytest.mark.parametrize("by", [(), ("subject",)])
def test_weight_moves_its_seeds(spark, tmpdir_path, by):
    days = Days(spark, WEIGHT, by)
    other = 2 if by else 1
    days.put(*[(40 + 7 * k, s, 80.0 + k, 20.0) for k in (0, 1, 4) for s in {1, other}])
    path = os.path.join(tmpdir_path, "w")
    weekly.write_weight(days.frame(), path, by=by)
    for changes in ([(60, 1, 79.0, 20.0)],
                    [(2, 1, None, 21.0)],                 # a day without a weight moves no seed
                    [(14, 1, 90.0, 20.0)],                # an earlier first weight: old seeds go
                    [(0, None if by else 1, 91.0, 20.0)],  # seeds in the year before; a subject without id
                    [(14, 1, None, 20.0), (0, 1, None, 22.0)]):  # the first weight goes again
        touched = days.put(*changes)
        written = weekly.merge_weight(spark, path, days.frame(), touched, by=by)
        assert written
        assert rows_of(weekly.read_weeks(spark, path)) == rows_of(marts.weekly_weight_from_daily(days.frame(), by=by)), changes


def test_a_week_of_seeds_alone_leaves_no_rows(spark, tmpdir_path):
    days = Days(spark, WEIGHT, ())
    days.put((35, 1, 80.0, None))  # a Monday: its seeds fall in the week before
    path = os.path.join(tmpdir_path, "w")
    weekly.write_weight(days.frame(), path)
    assert weekly.read_weeks(spark, path).count() == 2
    touched = days.put((14, 1, 81.0, None))
    weekly.merge_weight(spark, path, days.frame(), touched)
    got = weekly.read_weeks(spark, path)
    assert rows_of(got) == rows_of(marts.weekly_weight_from_daily(days.frame()))
    assert got.filter("year_week = '2024-W05'").count() == 0


def test_a_subject_key_leaves_no_global_window(spark):
    days = Days(spark, DAILY, ("subject",))
    days.put(*[steps(7 * k, s, k) for k in range(3) for s in (1, 2, None)])
    trends = marts.weekly_trends(days.frame(), ("subject",))
    plan = trends._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert sorted(r.subject or 0 for r in trends.filter("steps_change_vs_prev_week IS NULL").collect()) == [0, 1, 2]
    for s in (1, 2):
        alone = marts.weekly_trends(days.frame().filter(F.col("subject") == s).drop("subject"))
        assert rows_of(alone) == rows_of(trends.filter(F.col("subject") == s).drop("subject"))

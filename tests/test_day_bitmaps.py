"""Freshness from bitmaps of days equals the mart over all readings, run after run."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from pulseframe.operators.latest import latest_readings, stage_readings
from pulseframe.plans import day_bitmaps, marts, silver


def readings(spark, rows):
    """(metric, UTC instant, offset hours, value, load hour)."""
    out = []
    for metric, at, offset, value, loaded in rows:
        local = at + dt.timedelta(hours=offset)
        raw = json.dumps({"date": f"{local:%Y-%m-%d %H:%M:%S} +{offset:02d}00", "qty": value})
        out.append((metric, "u", at, float(value), None, None, None, raw, f"f{loaded}", dt.datetime(2026, 8, 1) + dt.timedelta(hours=loaded)))
    return spark.createDataFrame(out, "metric_name string, units string, date timestamp, value_qty double, value_avg double, value_min double, "
                                      "value_max double, value_raw string, source_file string, ingested_at timestamp")


def test_runs_equal_the_mart_over_all_readings(spark, tmpdir_path):
    day = lambda d, h=12: dt.datetime(2026, 7, 1) + dt.timedelta(days=d, hours=h)
    runs = [
        [("a", day(k), 2, k, 1) for k in (0, 1, 5)] + [("b", day(40000 // 2), 0, 1, 1), ("b", day(3), 0, 1, 1)],
        [("a", day(1), 2, 9, 2), ("a", day(2), 2, 1, 2), ("c", day(-20000), 0, 1, 2)],  # a replaced reading, a new day, a new metric
        [("a", day(5), 2, 9, 0)],                                                        # an older file: nothing changes
        [("a", day(8, 23), 2, 1, 3)],                                                    # 01:00 of day 9
        [("a", day(8, 23), 0, 2, 4)],                                                    # the same instant is 23:00 of day 8: day 9 is lost
        [("a", day(9), 0, 1, 5), ("b", day(3), 0, 2, 5)],
    ]
    spath, bpath = os.path.join(tmpdir_path, "s"), os.path.join(tmpdir_path, "b")
    silver.write_silver_by_day(latest_readings(readings(spark, runs[0])), spath)
    day_bitmaps.write(day_bitmaps.build(stage_readings(spark.read.parquet(spath).drop("reading_day"))), bpath)
    done = list(runs[0])
    for run in runs[1:]:
        day_bitmaps.merge(spark, bpath, spath, readings(spark, run))
        done += run
        exp = marts.metric_freshness(stage_readings(latest_readings(readings(spark, done))), "2026-09-01")
        state, _ = day_bitmaps.read(spark, bpath)
        got = day_bitmaps.freshness(state, "2026-09-01").select(*exp.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect())), run
    assert day_bitmaps.read(spark, bpath)[1] == len(runs) - 1
    assert state.filter(F.length("days") != 4096).count() == 0

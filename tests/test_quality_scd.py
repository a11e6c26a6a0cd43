"""Quality checks and change history."""

import datetime as dt

import pytest

from pulseframe.operators import quality as Q
from pulseframe.operators.expectations import expect, expectation_events, expectation_latest, expectation_totals
from pulseframe.operators.scd import scd1, scd2
from pyspark.sql import functions as F


def test_within_range(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (None,), (0.0,), (10.0,), (11.0,)], "v double")
    assert sorted(r[0] for r in Q.within_range(df, "v", 0, 10).collect()) == [11.0]
    assert sorted(r[0] for r in Q.within_range(df, "v", min_value=2).collect()) == [0.0, 1.0]
    with pytest.raises(ValueError):
        Q.within_range(df, "v")


def test_not_null_unique_accepted(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("zz",)], "m string")
    assert Q.not_null(df, "m").count() == 1
    assert [tuple(r) for r in Q.unique(df, "m").collect()] == [("a", 2)]
    assert [tuple(r) for r in Q.accepted_values(df, "m", ["a"]).collect()] == [("zz", 1)]


def test_files_without_rows_and_freshness(spark):
    b = spark.createDataFrame([("f1", dt.datetime(2026, 7, 20, 5)), ("f2", dt.datetime(2026, 7, 21, 5))],
                              "_source_file string, _ingested_at timestamp")
    s = spark.createDataFrame([("f1",)], "source_file string")
    assert [r[0] for r in Q.files_without_rows(b, s).collect()] == ["f2"]
    status = lambda as_of: Q.source_freshness(b, as_of).first()["status"]
    assert status("2026-07-22 06:00:00") == "pass"
    assert status("2026-07-22 08:00:00") == "warn"
    assert status("2026-07-23 08:00:00") == "error"


def test_run_suite(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    out = {r["check_name"]: r for r in Q.run_suite({
        "nn": ("error", Q.not_null(df, "x")), "rng": ("warn", Q.within_range(df, "x", 0, 0)),
        "ok": ("error", Q.within_range(df, "x", 0, 5))}).collect()}
    assert (out["nn"]["failures"], out["nn"]["status"]) == (1, "fail")
    assert out["rng"]["status"] == "warn" and out["ok"]["status"] == "pass"


def test_expectations_and_log(spark):
    df = spark.createDataFrame([("a", 1, "b1"), (None, 2, "b1"), ("c", None, "b2")],
                               "metric_name string, date int, batch string")
    df = df.withColumn("ingested_at", F.when(F.col("batch") == "b1", F.lit("2026-07-20").cast("timestamp"))
                       .otherwise(F.lit("2026-07-21").cast("timestamp")))
    exp = {"valid_metric_name": "metric_name IS NOT NULL", "valid_date": "date IS NOT NULL"}
    kept, counts = expect(df, exp)
    assert kept.count() == 1
    c = {r["name"]: (r["passed_records"], r["failed_records"]) for r in counts.collect()}
    assert c == {"valid_metric_name": (2, 1), "valid_date": (2, 1)}
    log = expectation_events(df, exp, "batch", "ds")
    tot = {r["expectation"]: tuple(r)[1:] for r in expectation_totals(log).collect()}
    assert tot == {"valid_metric_name": (2, 2, 1), "valid_date": (2, 2, 1)}
    latest = {r["expectation"]: r["dropped_records"] for r in expectation_latest(log).collect()}
    assert latest == {"valid_metric_name": 0, "valid_date": 1}


EV = "metric_name string, date int, value_qty double, value_avg double, source_file string, file_modification_time int"


def test_scd1_out_of_order(spark):
    rows = [("s", 1, 10.0, None, "a", 1), ("s", 1, 12.0, None, "b", 2), ("s", 1, 11.0, None, "c", 2)]
    for order in (rows, rows[::-1]):
        r = scd1(spark.createDataFrame(order, EV), ["metric_name", "date"], [F.col("file_modification_time")]).first()
        assert (r["value_qty"], r["source_file"]) == (12.0, "b")


def test_scd2_versions(spark):
    rows = [("s", 1, 10.0, None, "a", 1),
            ("s", 1, 10.0, None, "b", 2),    # unchanged re-send: no new version
            ("s", 1, 12.0, None, "c", 3),    # change
            ("s", 1, 10.0, None, "d", 4),    # change back
            ("s", 1, None, None, "e", 6),    # change to null
            ("s", 1, None, None, "f", 7),    # repeated null: no new version
            ("s", 1, 11.0, None, "late", 5)]  # late file between two versions
    df = spark.createDataFrame(rows, EV)
    for kw in ({}, {"chunks": 1}, {"chunks": 5}):
        h = scd2(df, ["metric_name", "date"], "file_modification_time", ["value_qty"], **kw)
        got = [(r["value_qty"], r["__START_AT"], r["__END_AT"], r["source_file"])
               for r in h.orderBy("__START_AT").collect()]
        assert got == [(10.0, 1, 3, "b"), (12.0, 3, 4, "c"), (10.0, 4, 5, "d"),
                   (11.0, 5, 6, "late"), (None, 6, None, "f")], kw


def test_scd2_hot_key_split_across_chunks(spark):
    # one key holds every event: the result must not depend on the chunking
    vals = [1.0, 1.0, 2.0, 2.0, 2.0, None, None, 3.0, 1.0, 1.0] * 4
    rows = [("s", 1, v, None, f"f{i}", i) for i, v in enumerate(vals)]
    rows += [("t", 2, 5.0, None, "g", 3)]
    df = spark.createDataFrame(rows, EV)

    def hist(chunks):
        h = scd2(df, ["metric_name", "date"], "file_modification_time", ["value_qty"], chunks=chunks)
        return sorted(map(tuple, h.collect()), key=repr)

    one = hist(None)   # every key within bound: per-key window
    assert hist(1) == one
    # versions of "s": 1, 2, None, 3, 1 in the first block, then 2, None, 3, 1
    # in each later block (it starts with 1 after a 1); plus one for "t"
    assert len(one) == 5 + 3 * 4 + 1
    for n in (3, 7, 16):
        assert hist(n) == one


def test_within_ranges_one_pass(spark):
    df = spark.createDataFrame([(1.0, 500.0), (-1.0, None), (7.0, 10.0)], "a double, b double")
    got = sorted(map(tuple, Q.within_ranges(df, {"a": (0, 5), "b": (None, 100)}).collect()))
    assert got == [("a", -1.0), ("a", 7.0), ("b", 500.0)]


def test_expectation_log_without_batches(spark):
    log = spark.createDataFrame([], "batch_id string, timestamp timestamp, expectations string")
    assert expectation_latest(log).count() == 0
    assert expectation_totals(log).count() == 0


def test_scd2_null_keys_are_keys(spark):
    rows = [(k, d, v, None, f"f{i}", i) for i, (k, d, v) in enumerate(
        [(None, 1, 1.0), (None, 1, 1.0), (None, 1, 2.0), (None, None, 2.0), (None, None, 2.0), ("s", None, 5.0), (None, 1, 2.0), (None, 1, 2.0)])]
    df = spark.createDataFrame(rows, EV)
    for chunks in (1, 3, 8):
        h = scd2(df, ["metric_name", "date"], "file_modification_time", ["value_qty"], chunks=chunks)
        got = sorted((tuple(r) for r in h.select("metric_name", "date", "value_qty", "__START_AT", "__END_AT").collect()), key=repr)
        assert got == sorted([(None, 1, 1.0, 0, 2), (None, 1, 2.0, 2, None), (None, None, 2.0, 3, None), ("s", None, 5.0, 5, None)], key=repr)


def test_expectation_counts_beyond_32_bits(spark):
    import json
    from pulseframe.operators import expectations as X
    events = [(k, json.dumps([{"name": "e", "dataset": "d", "passed_records": 3_000_000_000, "failed_records": k}])) for k in (1, 2)]
    log = spark.createDataFrame(events, "timestamp long, expectations string")
    assert tuple(X.expectation_totals(log).first()) == ("e", 2, 6_000_000_000, 3)
    assert X.expectation_latest(log).first()["passed_records"] == 3_000_000_000


def test_unique_over_several_columns(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, n int")
    assert [tuple(r) for r in Q.unique(df, ["k", "n"]).collect()] == [("a", 1, 2)]

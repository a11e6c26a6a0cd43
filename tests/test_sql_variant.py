"""Macros as SQL functions, VARIANT at rest, lateral explodes, pruned freshness."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pulseframe.functions.columns import change_display
from pulseframe.functions.sql_functions import range_violations, register_macros, register_range_check
from pulseframe.operators import quality as Q
from pulseframe.operators.flatten import lateral_fields, lateral_readings
from pulseframe.plans import silver
from pulseframe.sources import exports as S


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_macros_equal_the_column_functions_and_are_inlined(spark):
    register_macros(spark)
    df = spark.createDataFrame([(-1.005,), (2.344,), (0.0,), (-0.001,), (None,), (1e9,)], "x double")
    df.createOrReplaceTempView("macro_values")
    got = spark.sql("SELECT x, color_change(x) AS two, color_change(x, 0) AS none FROM macro_values")
    exp = df.select("x", change_display("x").alias("two"), change_display("x", 0).alias("none"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, exp.collect()), key=repr)
    assert "Python" not in plan_of(got) and "color_change" not in plan_of(got)
    with pytest.raises(Exception, match="decimals"):
        spark.sql("SELECT color_change(x, 9) FROM macro_values").collect()


def test_range_function_equals_the_check(spark):
    register_macros(spark)
    spark.createDataFrame([(-1.0, 0.0), (5.0, None), (99.0, 10.0), (None, 11.0)], "a double, b double").createOrReplaceTempView("ranged_values")
    bounds = {"a": (0, 50), "b": (None, 10)}
    got = range_violations(spark, "ranged_values", bounds)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, Q.within_ranges(spark.table("ranged_values"), bounds).collect()))
    assert "Join" not in plan_of(got) and plan_of(got).count("Scan") == 1
    register_range_check(spark, "a_out_of_range", "ranged_values", "a")
    table = spark.sql("SELECT * FROM a_out_of_range(0, 50)")
    assert sorted(r[0] for r in table.collect()) == [-1.0, 99.0] and "Join" not in plan_of(table)
    assert [r[0] for r in spark.sql("SELECT * FROM a_out_of_range(highest => 50)").collect()] == [99.0]
    with pytest.raises(ValueError):
        range_violations(spark, "ranged_values", {"a": (None, None)})


def test_stored_variant_reads_only_the_paths_used(spark, tmpdir_path):
    base = spark.createDataFrame([("m", "u", dt.datetime(2026, 1, 1), '{"date":"d","qty":1.5,"Avg":2,"source":"w"}', "f", dt.datetime(2026, 1, 2)),
                                  ("m", "u", dt.datetime(2026, 1, 1), '{"date":"e","qty":"7","avg":true}', "f", dt.datetime(2026, 1, 2)),
                                  ("n", "u", None, "no json", "f", None)],
                                 "metric_name string, units string, date timestamp, value_raw string, source_file string, ingested_at timestamp")
    path = os.path.join(tmpdir_path, "v")
    silver.write_silver_variant(base, path)
    rows = silver.read_silver_variant(spark, path)
    assert sorted(((r.value_qty, r.value_avg, r.date_text) for r in rows.collect()), key=repr) == [(1.5, 2.0, "d"), (7.0, None, "e"), (None, None, None)]
    plan = plan_of(rows.select("value_qty").filter("metric_name = 'm'"))
    scan = plan[plan.index("ReadSchema"):]
    assert "struct<reading:struct<0:string>>" in scan and "PartitionFilters: [isnotnull(metric_name" in plan


def test_lateral_joins_give_elements_fields_and_nothing(spark):
    docs = [('{"metrics":[{"name":"a","data":[{"q":1},{"q":2,"z":null}]},{"name":"b"},{"name":"c","data":{"x":{"q":3}}}]}', "one"),
            ('{"data":{"metrics":[{"name":"d","data":[5]}]}}', "deep"), ("{", "bad"), (None, "none")]
    bronze = spark.createDataFrame(docs, "data string, _source_file string")
    readings = lateral_readings(bronze)
    assert sorted((r.source_file, r.metric_name, r.n) for r in readings.groupBy("source_file", "metric_name").agg(F.count("*").alias("n")).collect()) == [
        ("deep", "d", 1), ("one", "a", 2), ("one", "c", 1)]
    fields = lateral_fields(readings, F.col("reading"))
    assert sorted((r.metric_name, r.key) for r in fields.collect()) == [("a", "q"), ("a", "q"), ("a", "z"), ("c", "q")]
    missing = F.try_variant_get("reading", "$.none", "variant")
    assert lateral_fields(readings, missing).count() == 0 and lateral_fields(readings, missing, outer=True).count() == readings.count()


def test_freshness_reads_the_newest_day_alone(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "landed")
    rows = [("{}", dt.datetime(2026, 7, d, 5), f"f{d}") for d in (1, 2, 9)]
    S.land(spark.createDataFrame(rows, "data string, _ingested_at timestamp, _source_file string"), path)
    bad = os.path.join(path, "ingest_date=2026-07-01", "part-0-broken.parquet")
    with open(bad, "w") as f:
        f.write("not parquet")  # a scan of an older day would fail here
    got = Q.source_freshness_pruned(spark, path, "2026-07-09 08:00:00").first()
    assert (got["max_loaded_at"], got["age_hours"], got["status"]) == (dt.datetime(2026, 7, 9, 5), 3.0, "pass")
    assert Q.source_freshness_pruned(spark, path, "2026-07-20 08:00:00", error_hours=1).first()["status"] == "error"

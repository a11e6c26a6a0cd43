"""Metric freshness from exact bitmaps of days, merged run by run.

The state has one row per metric (and subject) and span of 32,768 days, about ninety years: a
bitmap with a bit for every local day that has a reading, the number of readings, the first and
last day and the newest load time.  Two bitmaps merge by OR, so distinct days are counted
exactly without keeping or reading days that are already counted.

A run folds new readings into Silver and then looks at the Silver partitions it touched,
and no others: how many readings they hold more than before, and which local days have
readings.  Latest-wins can also take the last reading of a day away: a later reading of the
same instant may be written with another offset and belong to the day before or after.  Such
a day is seen among the touched ones, by its bit, and its metric alone is built anew from
Silver.  The result equals the mart over all readings.

The state is tiny; each run writes it whole under a new version, so readers of the one
before are not disturbed and a run repeated after a failure replaces its own version.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import stage_readings
from ..session import read_if_there, scratch
from . import marts
from .silver import SILVER_PARTS, merge_silver

_DAY = "unix_date(metric_date) + 1000000"  # positive for every calendar day


def _around(days: DataFrame, column: str, name: str) -> DataFrame:
    """Each metric's days and the days beside them."""
    near = F.array(*[F.date_add(column, k) for k in (-1, 0, 1)])
    return days.select("metric_name", F.explode(near).alias(name)).distinct()


def _bits(day: str = _DAY) -> Column:
    return F.bitmap_construct_agg(F.expr(f"bitmap_bit_position({day})"))


def build(stg: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The state of staged readings: ``metric_name, span, days, n, first_date, last_date, last_ingested_at``."""
    return (stg.groupBy(*by, "metric_name", F.expr(f"bitmap_bucket_number({_DAY})").alias("span"))
            .agg(_bits().alias("days"), F.count(F.lit(1)).alias("n"), F.min("metric_date").alias("first_date"),
                 F.max("metric_date").alias("last_date"), F.max("ingested_at").alias("last_ingested_at")))


def merged(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return states.groupBy(*by, "metric_name", "span").agg(
        F.bitmap_or_agg("days").alias("days"), F.sum("n").alias("n"), F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"), F.max("last_ingested_at").alias("last_ingested_at"))


def freshness(state: DataFrame, as_of: dt.date | str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The freshness mart from the state."""
    per = state.groupBy(*by, "metric_name").agg(
        F.sum("n").alias("datapoint_count"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.max("last_ingested_at").alias("last_ingested_at"), F.sum(F.bitmap_count("days")).alias("days_with_data"))
    return marts.freshness_of(per, as_of, by)


def write(state: DataFrame, path: str, version: int = 0) -> None:
    state.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")


def read(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """(the newest state, its version)."""
    rows = read_if_there(spark, path)
    if rows is None:
        raise FileNotFoundError(f"no state at {path}: build and write one first")
    version = rows.agg(F.max("version")).first()[0]
    return rows.filter(F.col("version") == version).drop("version"), version


def merge(spark: SparkSession, path: str, silver_path: str, new_rows: DataFrame) -> DataFrame:
    """Fold new readings into Silver (``merge_silver``) and the state; returns the touched
    Silver partitions."""
    with scratch(spark) as keep:
        new_rows = keep(new_rows, "bitmap-readings")
        parts = keep(new_rows.select("metric_name", F.to_date("date").alias("reading_day")).distinct(), "bitmap-parts")

        def sizes(where: DataFrame) -> DataFrame:  # partition columns alone
            return spark.read.parquet(silver_path).select(*SILVER_PARTS).join(where, list(SILVER_PARTS), "left_semi").groupBy("metric_name").agg(F.count(F.lit(1)).alias("n"))

        before = keep(sizes(parts), "bitmap-before")
        touched = merge_silver(spark, silver_path, new_rows)
        grown = (sizes(touched).join(before.withColumnRenamed("n", "old"), "metric_name", "left")
                 .select("metric_name", (F.col("n") - F.coalesce("old", F.lit(0))).alias("more")))
        # the local days that the touched partitions feed, with what Silver holds for them now
        days = _around(touched, "reading_day", "metric_date")
        scanned = _around(days, "metric_date", "reading_day")
        silver = spark.read.parquet(silver_path)
        stg = stage_readings(silver.join(scanned, list(SILVER_PARTS), "left_semi").drop("reading_day"))
        key = ["metric_name", "metric_date"]
        seen = keep(stg.join(days, key, "left_semi").groupBy(*key).agg(F.max("ingested_at").alias("ingested_at")), "bitmap-days")
        old, version = read(spark, path)
        # a touched day without readings whose bit is set has lost them
        absent = days.join(seen.select(*key), key, "left_anti")
        single = absent.groupBy("metric_name", "metric_date", F.expr(f"bitmap_bucket_number({_DAY})").alias("span")).agg(_bits().alias("days"))
        known = old.select(F.col("metric_name").alias("m"), F.col("span").alias("s"), F.col("days").alias("old_days"))
        probe = single.join(known, (F.col("metric_name") == F.col("m")) & (F.col("span") == F.col("s")))
        both = probe.select("metric_name", "metric_date", F.explode(F.array("days", "old_days")).alias("d"), F.bitmap_count("old_days").alias("c"))
        lost = (both.groupBy("metric_name", "metric_date").agg(F.bitmap_count(F.bitmap_or_agg("d")).alias("n"), F.max("c").alias("c"))
                .filter("n = c").select("metric_name").distinct())
        lost = keep(lost, "bitmap-lost")
        increments = build(seen).drop("n").withColumn("n", F.lit(0).cast("long"))
        # the number of readings is added once, in the metric's first span
        first = increments.groupBy("metric_name").agg(F.min("span").alias("span")).join(grown, "metric_name")
        counted = increments.join(first, ["metric_name", "span"], "left").select(
            "metric_name", "span", "days", F.coalesce("more", F.lit(0)).cast("long").alias("n"), "first_date", "last_date", "last_ingested_at")
        state = merged(old.unionByName(counted)).join(lost, "metric_name", "left_anti")
        if not lost.isEmpty():
            state = state.unionByName(build(stage_readings(silver.join(lost, "metric_name", "left_semi").drop("reading_day"))))
        write(keep(state, "bitmap-state"), path, version + 1)
    return touched

"""The daily job: Bronze -> Silver (written once) -> four marts -> checks.

Equivalent of the reference's model build followed by its tests: Silver is
written partitioned by metric (the JSON flatten and dedup run once), each
mart is rebuilt with ``overwrite`` from the written Silver, and the 26 data
tests plus the source-freshness check run over the written tables.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ACCEPTED_METRICS, DAILY_RANGES, SILVER_EXPECTATIONS
from ..operators.expectations import expect_observed, observed_counts, write_event
from ..operators import quality as Q
from ..operators.flatten import explode_readings
from ..operators.latest import latest_readings, stage_readings, staging_sql
from ..session import read_if_there, scratch
from . import marts, weekly
from .silver import merge_silver, read_silver, write_silver_by_day

MARTS = ("fct_daily_activity_summary", "fct_weekly_trends", "fct_weekly_weight_trends",
         "fct_metric_freshness")


def layer_paths(out_dir: str) -> dict[str, str]:
    names = ("silver", "expectation_log", *MARTS, "daily_weight_readings", "metric_day_counts")
    return {n: os.path.join(out_dir, n) for n in names}


def _log_expectations(spark: SparkSession, obs, path: str, at: str | None = None) -> None:
    """Append the run's event: the observed counts, under the next batch number."""
    log = read_if_there(spark, path)
    last = log.agg(F.max("batch_id")).first()[0] if log is not None else None
    write_event(spark, path, 0 if last is None else last + 1, observed_counts(obs, SILVER_EXPECTATIONS),
                "silver_readings_staging", at)


def build_layers(spark: SparkSession, bronze: DataFrame, out_dir: str,
                 as_of: dt.date | str | None = None) -> dict[str, str]:
    """Full build: Silver (by metric and day), the per-day tables and the four
    marts under ``out_dir``; returns their paths.  The expectation counts are
    observed by the Silver write itself and appended to the expectation log."""
    paths = layer_paths(out_dir)
    kept, obs = expect_observed(explode_readings(bronze), SILVER_EXPECTATIONS)
    write_silver_by_day(latest_readings(kept), paths["silver"])
    _log_expectations(spark, obs, paths["expectation_log"])
    stg = stage_readings(read_silver(spark, paths["silver"]).drop("reading_day"))
    write_days(marts.daily_summary(stg), paths[MARTS[0]])
    for name, fn in DAY_TABLES.items():
        write_days(fn(stg), paths[name])
    weekly.write_trends(read_days(spark, paths[MARTS[0]]), paths[MARTS[1]])
    weekly.write_weight(read_days(spark, paths["daily_weight_readings"]), paths[MARTS[2]])
    _write_freshness(spark, paths, as_of)
    return paths


def update_layers(spark: SparkSession, new_bronze: DataFrame, out_dir: str,
                  as_of: dt.date | str | None = None) -> dict[str, str]:
    """Incremental run after :func:`build_layers`: fold only the new Bronze
    files into Silver (touched metric-day partitions), refresh the daily mart
    and the per-day tables for the touched local days, the weekly marts for the
    touched weeks and those that refer to them, and derive freshness from its
    small per-day table.  Results equal a full build."""
    paths = layer_paths(out_dir)
    kept, obs = expect_observed(explode_readings(new_bronze), SILVER_EXPECTATIONS)
    touched = merge_silver(spark, paths["silver"], kept)
    _log_expectations(spark, obs, paths["expectation_log"])
    merge_daily(spark, paths[MARTS[0]], paths["silver"], touched)
    merge_day_tables(spark, paths, paths["silver"], touched)
    merge_weeks(spark, paths, touched)
    _write_freshness(spark, paths, as_of)
    return paths


def _write_freshness(spark: SparkSession, paths: dict[str, str], as_of) -> None:
    dc = read_days(spark, paths["metric_day_counts"])
    marts.freshness_from_day_counts(dc, as_of).write.mode("overwrite").parquet(paths[MARTS[3]])


def merge_weeks(spark: SparkSession, paths: dict[str, str], touched: DataFrame) -> None:
    """Refresh the weekly marts after their per-day tables."""
    days = local_days(touched)
    weekly.merge_trends(spark, paths[MARTS[1]], read_days(spark, paths[MARTS[0]]), days)
    weekly.merge_weight(spark, paths[MARTS[2]], read_days(spark, paths["daily_weight_readings"]), days)


def read_mart(spark: SparkSession, paths: dict[str, str], mart: str) -> DataFrame:
    """A stored mart, its own columns only."""
    if mart == MARTS[0]:
        return read_days(spark, paths[mart])
    if mart in MARTS[1:3]:
        return weekly.read_weeks(spark, paths[mart])
    return spark.read.parquet(paths[mart])


def suite_specs() -> dict[str, list[dict]]:
    """The row-level data tests of each table."""
    def nn(t, c):
        return {"name": f"{t}.{c}.not_null", "kind": "not_null", "column": c}

    def uq(t, c):
        return {"name": f"{t}.{c}.unique", "kind": "unique", "column": c}

    return {
        "stg": [nn("stg", "metric_name"), nn("stg", "metric_date"),
                {"name": "stg.metric_name.accepted_values", "kind": "accepted_values",
                 "column": "metric_name", "values": ACCEPTED_METRICS}],
        "daily": [nn("daily", "metric_date"), uq("daily", "metric_date"), nn("daily", "metrics_present"),
                  *({"name": f"daily.{c}.within_range", "kind": "within_range", "column": c, "min": lo, "max": hi}
                    for c, (lo, hi) in DAILY_RANGES.items())],
        "weekly": [nn("weekly", "week_start"), uq("weekly", "week_start")],
        "weight": [nn("weight", "year_week"), uq("weight", "year_week"), nn("weight", "week_end_date")],
        "freshness": [nn("freshness", "metric_name"), uq("freshness", "metric_name"), nn("freshness", "days_since_last_data")],
    }


def suite_counts(tables: dict[str, DataFrame], bronze: DataFrame, base: DataFrame) -> list[DataFrame]:
    """Failure counts of all 26 tests: one pass per table, and the two tests across tables."""
    counts = [Q.count_checks(tables[t], specs) for t, specs in suite_specs().items()]
    across = {"rollup_match": Q.rollup_matches(tables["stg"], tables["daily"]),
              "file_completeness": Q.files_without_rows(bronze, base)}
    return counts + [v.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(k).alias("check_name"), F.lit("error").alias("severity"), "failures") for k, v in across.items()]


def check_layers(spark: SparkSession, bronze: DataFrame, paths: dict[str, str],
                freshness_as_of: dt.datetime | str) -> DataFrame:
    """The reference's data tests over the written tables, one pass per table."""
    stg = stage_readings(read_silver(spark, paths["silver"]).drop("reading_day"))
    d, wk, ww, fr = (read_mart(spark, paths, m) for m in MARTS)

    counts = suite_counts({"stg": stg, "daily": d, "weekly": wk, "weight": ww, "freshness": fr},
                          bronze, read_silver(spark, paths["silver"]))
    fresh = Q.source_freshness(bronze, freshness_as_of).select(
        F.lit("source_freshness").alias("check_name"),
        F.when(F.col("status") == "warn", F.lit("warn")).otherwise(F.lit("error")).alias("severity"),
        F.when(F.col("status") == "pass", F.lit(0)).otherwise(F.lit(1)).cast("long").alias("failures"))
    return Q.suite_result(counts + [fresh])


def _around(days: DataFrame, column: str, name: str) -> DataFrame:
    shifts = F.array(F.lit(-1), F.lit(0), F.lit(1))
    return days.select(F.explode(F.transform(shifts, lambda k: F.date_add(column, k))).alias(name)).distinct()


def local_days(touched: DataFrame) -> DataFrame:
    """Local days (``metric_date``) that the touched Silver partitions can feed."""
    return _around(touched, "reading_day", "metric_date")


def recompute_days(spark: SparkSession, table_path: str, silver_path: str, touched: DataFrame,
                   build) -> None:
    """Refresh a per-local-day table only for the days a Silver merge touched.

    ``touched`` holds the (metric, reading_day) partitions ``merge_silver``
    rewrote.  A local calendar day can take readings from the UTC days
    before and after it (offsets), so the candidate local days are the
    touched days +/- 1, and Silver is read only for those days +/- 1 (the
    semi-join on the partition column is pruned at the scan).  ``build``
    maps the staged readings of those days to rows keyed by ``metric_date``.
    The table is partitioned by month: only the months of those days are read
    back, joined with the fresh days, stored (they are read from the
    partitions they replace) and overwritten; other months are not touched.
    """
    days = local_days(touched)
    scan_days = _around(days, "metric_date", "reading_day")
    silver_rows = spark.read.parquet(silver_path).join(scan_days, "reading_day", "left_semi")
    stg = stage_readings(silver_rows.drop("reading_day")).join(days, "metric_date", "left_semi")
    fresh = _with_month(build(stg))
    months = _with_month(days).select("month").distinct()
    kept = (read_days(spark, table_path, keep_month=True).join(months, "month", "left_semi")
            .join(days, "metric_date", "left_anti"))
    with scratch(spark) as keep:
        write_days(keep(kept.unionByName(fresh.select(*kept.columns)), "refreshed-days"), table_path, "dynamic")


def _with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("month", F.date_format("metric_date", "yyyy-MM"))


def write_days(rows: DataFrame, path: str, overwrite: str = "static") -> None:
    """A per-day table, partitioned by month."""
    (_with_month(rows).hint("rebalance", "month").write.mode("overwrite")
     .option("partitionOverwriteMode", overwrite).partitionBy("month").parquet(path))


def read_days(spark: SparkSession, path: str, keep_month: bool = False) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.withColumn("month", F.col("month").cast("string")) if keep_month else rows.drop("month")


def merge_daily(spark: SparkSession, daily_path: str, silver_path: str,
                touched: DataFrame) -> None:
    """Recompute the daily mart only for local days touched by a Silver merge."""
    recompute_days(spark, daily_path, silver_path, touched, marts.daily_summary)


# Per-day tables behind the other marts: weekly trends come from the daily
# mart, the weight mart from daily weight readings, freshness from counts
# per (metric, day).  Each is refreshed with ``recompute_days``.
DAY_TABLES = {
    "daily_weight_readings": marts.daily_weight_readings,
    "metric_day_counts": marts.metric_day_counts,
}


def merge_day_tables(spark: SparkSession, paths: dict[str, str], silver_path: str,
                     touched: DataFrame) -> None:
    for name, fn in DAY_TABLES.items():
        recompute_days(spark, paths[name], silver_path, touched, fn)


def publish_layers(spark: SparkSession, paths: dict[str, str], bronze_path: str | None = None, prefix: str = "pulse") -> dict[str, str]:
    """Name the written layers: schemas ``<prefix>_bronze``, ``<prefix>_silver`` and
    ``<prefix>_gold`` with a view per stored layer over its files, and the staging view
    over Silver's.

    Returns layer -> qualified name.  A name that exists is replaced in one step, so that
    readers find either the old or the new files under it; data stay where they are, and
    a run that writes to a new folder and publishes it never shows a half-written layer.
    """
    def name(schema: str, table: str) -> str:
        return f"`{prefix}_{schema}`.`{table}`"

    def publish(qualified: str, path: str, columns: list[str], where: str = "") -> str:
        shown = ", ".join(f"`{c}`" for c in columns)
        place = path.replace("`", "``")
        spark.sql(f"CREATE OR REPLACE VIEW {qualified} AS SELECT {shown} FROM parquet.`{place}`{where}")
        return qualified

    for schema in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{prefix}_{schema}`")
    out = {}
    if bronze_path is not None:
        out["bronze"] = publish(name("bronze", "health_export"), bronze_path, spark.read.parquet(bronze_path).columns)
    out["silver"] = publish(name("silver", "base_readings"), paths["silver"], read_silver(spark, paths["silver"]).columns)
    for mart in MARTS:
        out[mart] = publish(name("gold", mart), paths[mart], read_mart(spark, paths, mart).columns,
                            " WHERE NOT _gone" if mart in MARTS[1:3] else "")
    # the staging layer is a view in the catalog as well: the projection in SQL
    out["staging"] = name("silver", "stg_readings")
    spark.sql(f"CREATE OR REPLACE VIEW {out['staging']} AS {staging_sql(out['silver'])}")
    return out

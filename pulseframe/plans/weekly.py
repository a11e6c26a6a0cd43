"""The weekly marts kept up to date week by week.

Both marts are stored with a folder per week and compare each week with the previous
*present* week of its subject.  A run that changed some days rewrites

* the weeks of those days,
* the next present week after each of them (its change refers to them): a week that
  comes in between two others, or goes, moves the reference of the one after it,
* for the weight mart, when a subject's first real weight moves, the weeks that its
  old and its new seed days fall in,

and no other week; the result equals a full build.  A week without rows any more (only
seeds were in it) leaves one row marked as gone, since a folder that gets no rows would
keep its old ones; :func:`read_weeks` leaves it out.

The windows that find neighbours run over one stored row per subject and week, never
over days or readings; days are read only for the weeks that are computed anew.  Lists of
weeks, at most one entry per week of the calendar, pass through the driver and prune the
folders that are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import WEIGHT_SEEDS
from ..functions.columns import week_start
from ..session import scratch
from . import marts

# Stored beside a mart's own columns: what a later run needs, unrounded.
_BASE = {
    "trends": ("week_start", *marts.TOTALS),
    "weight": ("week_end_date", "iso_year", "iso_week", "kg", "fat", "seed_first"),
}
Derive = Callable[..., DataFrame]


def _monday(day: str | Column) -> Column:
    return F.to_date(week_start(day))


def read_weeks(spark: SparkSession, path: str) -> DataFrame:
    """A stored weekly mart, its own columns only."""
    rows = spark.read.parquet(path).filter("NOT _gone")
    return rows.drop("week", *[c for c in rows.columns if c.startswith("_")])


def _base(spark: SparkSession, path: str, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    rows = spark.read.parquet(path).filter("NOT _gone")
    return rows.select(*by, "week", *[F.col(f"_{c}").alias(c) for c in columns])


def _derived(derive: Derive, base: DataFrame, columns: Sequence[str], by: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    return derive(base, by, [*[F.col(c).alias(f"_{c}") for c in columns], F.lit(False).alias("_gone"), "week", *keep])


def _write(rows: DataFrame, path: str, overwrite: str) -> None:
    (rows.hint("rebalance", "week").write.mode("overwrite").option("partitionOverwriteMode", overwrite)
     .partitionBy("week").parquet(path))


def _weeks(rows: DataFrame) -> list[dt.date]:
    """The distinct weeks of ``rows``: at most one per week of the calendar."""
    return [r["week"] for r in rows.select("week").distinct().collect()]


def _in_weeks(weeks: Collection[dt.date], column: Column | str = "week") -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.isin(sorted(weeks)) if weeks else F.lit(False)


def _merge(spark: SparkSession, path: str, fresh: DataFrame, touched: Collection[dt.date], derive: Derive,
           columns: Sequence[str], by: Sequence[str]) -> list[dt.date]:
    """Put the ``fresh`` base rows of the ``touched`` weeks into a stored mart; returns the
    weeks written."""
    with scratch(spark) as keep:
        old = _base(spark, path, columns, by).filter(~_in_weeks(touched))
        base = old.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True)))
        # neighbours within a subject
        before = F.lag("week").over(Window.partitionBy(*by).orderBy("week"))
        rows = keep(_derived(derive, base.withColumn("_before", before), columns, by, ["_new", "_before"]), "weekly-rows")
        # what the stored table had for predecessor: another one where a week came or went
        stored = spark.read.parquet(path).filter("NOT _gone").select(*by, "week")
        stored = stored.withColumn("_was", F.lag("week").over(Window.partitionBy(*by).orderBy("week"))).withColumnsRenamed({c: f"_b_{c}" for c in (*by, "week")})
        same = F.col("week") == F.col("_b_week")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
        moved = F.col("_new") | F.coalesce(_in_weeks(touched, "_before"), F.lit(False)) | ~F.col("_before").eqNullSafe(F.col("_was"))
        # one row per week of the calendar
        there = {r["week"]: r["moved"] for r in rows.join(stored, same, "left").groupBy("week").agg(F.max(moved).alias("moved")).collect()}
        changed = {*touched, *(w for w, m in there.items() if m)}
        out = rows.drop("_new", "_before").filter(_in_weeks(changed))
        # a week that is stored and has no rows any more
        gone = set(touched) - set(there)
        gone = gone and gone & set(_weeks(spark.read.parquet(path).filter(_in_weeks(gone))))
        if gone:
            empty = spark.createDataFrame([(w,) for w in sorted(gone)], "week date")
            out = out.unionByName(empty.withColumn("_gone", F.lit(True)), allowMissingColumns=True)
        if changed:
            _write(out, path, "dynamic")
    return sorted(changed)


# --- weekly trends ------------------------------------------------------------------------
def _totals(daily: DataFrame, by: Sequence[str]) -> DataFrame:
    totals = marts.weekly_totals(daily, by)
    return totals.select(*by, F.to_date("week_start").alias("week"), *_BASE["trends"])


def write_trends(daily: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Full build of the weekly trends from the daily mart."""
    _write(_derived(marts.trends_of, _totals(daily, by), _BASE["trends"], by), path, "static")


def merge_trends(spark: SparkSession, path: str, daily: DataFrame, days: DataFrame, by: Sequence[str] = ()) -> list[dt.date]:
    """Bring stored weekly trends up to date after the daily mart changed on ``days``
    (``metric_date``); returns the weeks written, by their Mondays."""
    touched = _weeks(days.select(_monday("metric_date").alias("week")))
    fresh = daily.filter(_in_weeks(touched, _monday("metric_date")))
    return _merge(spark, path, _totals(fresh, by), touched, marts.trends_of, _BASE["trends"], by)


# --- weekly weight ------------------------------------------------------------------------
def _body(daily: DataFrame, seeded: DataFrame, by: Sequence[str]) -> DataFrame:
    return marts.weekly_body(daily, seeded, by).select(*by, _monday("week_end_date").alias("week"), *_BASE["weight"])


def write_weight(daily: DataFrame, path: str, seeds: Mapping[int, float] = WEIGHT_SEEDS, by: Sequence[str] = ()) -> None:
    """Full build of the weekly weight mart from the daily weight readings."""
    _write(_derived(marts.weight_of, _body(daily, marts.seed_days(daily, seeds, by), by), _BASE["weight"], by), path, "static")


def merge_weight(spark: SparkSession, path: str, daily: DataFrame, days: DataFrame,
                 seeds: Mapping[int, float] = WEIGHT_SEEDS, by: Sequence[str] = ()) -> list[dt.date]:
    """Bring the stored weight mart up to date after the daily weight readings changed on
    ``days`` (``metric_date``); returns the weeks written, by their Mondays."""
    with scratch(spark) as keep:
        seeded = keep(marts.seed_days(daily, seeds, by), "seed-days")
        now = seeded.select(*by, _monday("metric_date").alias("week"), "seed_first").distinct()
        was = _base(spark, path, ["seed_first"], by).filter("seed_first IS NOT NULL").select(*now.columns)
        # weeks that hold seeds of a first day that came or went
        moved = now.exceptAll(was).unionByName(was.exceptAll(now)).select("week")
        touched = _weeks(days.select(_monday("metric_date").alias("week")).unionByName(moved))
        of_weeks = lambda rows: rows.filter(_in_weeks(touched, _monday("metric_date")))
        return _merge(spark, path, _body(of_weeks(daily), of_weeks(seeded), by), touched, marts.weight_of, _BASE["weight"], by)

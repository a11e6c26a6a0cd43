"""Data-quality checks: each returns the violating rows as a DataFrame.

A check passes when its DataFrame is empty.  ``run_suite`` turns a set of
checks into one small result table (name, severity, failures, status) in a
single job: the per-check counts are partial aggregates, unioned.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CUMULATIVE_METRICS, DAILY_COLUMNS, FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS
from ..plans.marts import unpivot_daily


def not_null(df: DataFrame, column: str, show: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``column`` is NULL; ``show`` names the columns to report instead of it."""
    return df.filter(F.col(column).isNull()).select(*(show or (column,)))


def unique(df: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """Values that occur more than once (NULLs are not compared).  Several columns
    are grouped on their own types and reported under their own names."""
    if not isinstance(column, str):
        return (df.dropna(subset=list(column)).groupBy(*column).agg(F.count(F.lit(1)).alias("n_records"))
                .filter(F.col("n_records") > 1))
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1)
            .select(F.col(column).alias("unique_field"), "n_records"))


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the accepted list; NULL passes (``not_null`` covers it)."""
    vals = list(values)
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(vals))
            .groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def within_range(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    """Non-NULL values below ``min_value`` or above ``max_value`` (inclusive
    bounds, either optional; at least one is required)."""
    if min_value is None and max_value is None:
        raise ValueError("within_range needs min_value, max_value or both")
    v = F.col(column)
    cond = None
    if min_value is not None:
        cond = v < F.lit(min_value)
    if max_value is not None:
        hi = v > F.lit(max_value)
        cond = hi if cond is None else cond | hi
    return df.filter(v.isNotNull()).filter(cond).select(v.alias("value_to_check"))


def rollup_matches(stg: DataFrame, daily: DataFrame, tolerance: float = 0.01,
                   columns: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Daily rollup readings whose mart value differs by more than ``tolerance``.

    The join is on (metric_name, metric_date); the mart side has one row per
    (day, metric), so the join never multiplies rows.
    """
    cols = list(columns if columns is not None else
                [(c, m) for c, m in DAILY_COLUMNS if m in CUMULATIVE_METRICS])
    rollups = (stg.filter(F.col("is_daily_rollup"))
               .select("metric_name", "metric_date", F.col("value").alias("rollup_value")))
    u = unpivot_daily(daily, cols)
    return (rollups.join(u, ["metric_name", "metric_date"])
            .filter(F.abs(F.col("rollup_value") - F.col("mart_value")) > tolerance)
            .select("metric_name", "metric_date", "rollup_value", "mart_value"))


def files_without_rows(bronze: DataFrame, silver: DataFrame,
                       bronze_file: str = "_source_file", silver_file: str = "source_file") -> DataFrame:
    """Bronze files that produced no Silver row (anti-join on the file name;
    both sides are reduced to distinct names before the shuffle)."""
    b = bronze.select(F.col(bronze_file).alias("_source_file")).distinct()
    s = silver.select(F.col(silver_file).alias("_source_file")).distinct()
    return b.join(s, "_source_file", "left_anti")


def source_freshness(bronze: DataFrame, as_of: dt.datetime | str,
                     loaded_at: str = "_ingested_at",
                     warn_hours: float = FRESHNESS_WARN_HOURS,
                     error_hours: float = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """One row: newest load time, age in hours at ``as_of``, pass/warn/error."""
    ref = F.lit(str(as_of)).cast("timestamp")
    newest = bronze.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = (F.unix_micros(ref) - F.unix_micros(F.col("max_loaded_at"))) / 3.6e9
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(F.col("age_hours") > error_hours, F.lit("error"))
              .when(F.col("age_hours") > warn_hours, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return (newest.select("max_loaded_at", F.round(age, 6).alias("age_hours"))
            .select("max_loaded_at", "age_hours", status.alias("status")))


def source_freshness_pruned(spark: SparkSession, table: str, as_of: dt.datetime | str, loaded_at: str = "_ingested_at",
                            day: str = "ingest_date", **limits) -> DataFrame:
    """:func:`source_freshness` of a landed table partitioned by load day, from the newest
    day's files alone.

    The newest day is a scalar subquery over the file listing (no file is opened for it);
    it prunes the partitions of the scan, which reads one column of one day.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(table)
    newest = listing.agg(F.max(F.col(day).cast("string")).alias("day")).scalar()
    landed = spark.read.schema(f"`{loaded_at}` timestamp, `{day}` string").parquet(table)  # a given schema: no footer is read for it
    return source_freshness(landed.filter(F.col(day) == newest).select(loaded_at), as_of, loaded_at, **limits)


def run_suite(checks: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """name -> (severity, violations) into ``check_name, severity, failures, status``."""
    parts = []
    for name, (severity, df) in checks.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
              .when(F.col("severity") == "warn", F.lit("warn"))
              .otherwise(F.lit("fail")))
    return out.select("check_name", "severity", "failures", status.alias("status"))


def count_checks(df: DataFrame, specs: Sequence[Mapping]) -> DataFrame:
    """Failure counts of many row-level checks of one table in one pass.

    ``specs``: dicts with ``name``, ``severity``, ``kind`` (``not_null``,
    ``within_range``, ``accepted_values``, ``unique``), ``column`` and, per
    kind, ``min``/``max`` or ``values``.  Row-level kinds become one
    ``count_if`` (``accepted_values``: distinct bad values, one per violating
    row of :func:`accepted_values`) inside a single aggregate; each ``unique``
    needs its own grouped pass.  Output: ``check_name, severity, failures``.
    """
    exprs, parts = [], []
    for i, s in enumerate(specs):
        c = F.col(s["column"])
        kind = s["kind"]
        if kind == "not_null":
            exprs.append((s, F.count_if(c.isNull())))
        elif kind == "within_range":
            lo, hi = s.get("min"), s.get("max")
            if lo is None and hi is None:
                raise ValueError("within_range needs min_value, max_value or both")
            bad = None
            if lo is not None:
                bad = c < F.lit(lo)
            if hi is not None:
                bad = (c > F.lit(hi)) if bad is None else bad | (c > F.lit(hi))
            exprs.append((s, F.count_if(c.isNotNull() & bad)))
        elif kind == "accepted_values":
            bad = c.isNotNull() & ~c.isin(list(s["values"]))
            exprs.append((s, F.count_distinct(F.when(bad, c))))
        elif kind == "unique":
            parts.append(unique(df, s["column"]).agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(s["name"]).alias("check_name"),
                                 F.lit(s.get("severity", "error")).alias("severity"), "failures"))
        else:
            raise ValueError(f"unknown check kind {kind!r}")
    if exprs:
        agg = df.agg(*[e.cast("long").alias(f"_c{i}") for i, (_, e) in enumerate(exprs)])
        rows = F.explode(F.array(*[
            F.struct(F.lit(s["name"]).alias("check_name"),
                     F.lit(s.get("severity", "error")).alias("severity"),
                     F.col(f"_c{i}").alias("failures"))
            for i, (s, _) in enumerate(exprs)]))
        parts.insert(0, agg.select(rows.alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def suite_result(counts: Sequence[DataFrame], order: Sequence[str] | None = None) -> DataFrame:
    """Union per-table counts into ``check_name, severity, failures, status``."""
    out = counts[0]
    for p in counts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
              .when(F.col("severity") == "warn", F.lit("warn"))
              .otherwise(F.lit("fail")))
    return out.select("check_name", "severity", F.col("failures").cast("long").alias("failures"),
                      status.alias("status"))


def within_ranges(df: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """``within_range`` for many columns in one pass: ``column_name,
    value_to_check`` for every non-NULL value outside its inclusive bounds
    (``None`` = open).  One scan and one generator instead of a union of
    one scan per column."""
    items = []
    for c, (lo, hi) in ranges.items():
        if lo is None and hi is None:
            raise ValueError(f"within_range on {c} needs min_value, max_value or both")
        items.append(F.struct(F.lit(c).alias("column_name"),
                              F.col(c).cast("double").alias("value_to_check"),
                              F.lit(lo).cast("double").alias("lo"),
                              F.lit(hi).cast("double").alias("hi")))
    v = F.col("r.value_to_check")
    bad = v.isNotNull() & ((F.col("r.lo").isNotNull() & (v < F.col("r.lo")))
                           | (F.col("r.hi").isNotNull() & (v > F.col("r.hi"))))
    return (df.select(F.explode(F.array(*items)).alias("r")).filter(bad)
            .select("r.column_name", "r.value_to_check"))

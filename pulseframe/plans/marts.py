"""Gold marts: daily summary, weekly trends, weekly weight, metric freshness.

Each mart is a DataFrame -> DataFrame function over the staging readings.
Marts are stored unsorted; ``order_columns`` is the final sort that a reader applies.  Global (unpartitioned) windows appear only after
aggregation to one row per week, where the input is a few rows per year.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (BODY_FAT_METRIC, CUMULATIVE_METRICS, DAILY_COLUMNS,
                      WEIGHT_METRIC, WEIGHT_SEEDS)
from ..functions.columns import change_display, iso_year, week_start


def daily_values(stg: DataFrame, cumulative: Sequence[str] = CUMULATIVE_METRICS, by: Sequence[str] = ()) -> DataFrame:
    """One value per (metric, day): the rollup's max when the day has a rollup,
    else the sum (cumulative metrics) or the average of intraday readings.
    A rollup whose value is NULL makes the day NULL (no fallback)."""
    roll = F.col("is_daily_rollup")
    agg = stg.groupBy(*by, "metric_name", "metric_date").agg(
        F.max(F.when(roll, 1).otherwise(0)).alias("_has_rollup"),
        F.max(F.when(roll, F.col("value"))).alias("_rollup"),
        F.sum(F.when(~roll, F.col("value"))).alias("_sum"),
        F.avg(F.when(~roll, F.col("value"))).alias("_avg"))
    value = (F.when(F.col("_has_rollup") == 1, F.col("_rollup"))
             .when(F.col("metric_name").isin(list(cumulative)), F.col("_sum"))
             .otherwise(F.col("_avg")))
    return agg.select(*by, "metric_name", "metric_date", value.alias("daily_value"))


def daily_summary(stg: DataFrame, columns: Sequence[tuple[str, str]] = DAILY_COLUMNS,
                  cumulative: Sequence[str] = CUMULATIVE_METRICS, by: Sequence[str] = ()) -> DataFrame:
    """Pivot of day values into fixed columns, one row per day (and subject).

    Conditional ``max`` keeps a fixed schema and one pass (no ``.pivot``).
    ``metrics_present`` counts every metric with a row that day, including
    metrics whose day value is NULL; rows are already unique per
    (day, metric), so ``count(*)`` equals ``count(distinct metric_name)``
    without the distinct-aggregate expansion.
    """
    dv = daily_values(stg, cumulative, by)
    aggs = [F.max(F.when(F.col("metric_name") == m, F.col("daily_value"))).alias(out)
            for out, m in columns]
    return dv.groupBy(*by, "metric_date").agg(*aggs, F.count(F.lit(1)).alias("metrics_present"))


def unpivot_daily(daily: DataFrame, columns: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Wide -> long (``UNION ALL`` of projections); keeps NULL values."""
    cols = list(columns if columns is not None else DAILY_COLUMNS[:6])
    long = daily.select("metric_date", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric_name"), F.col(c).cast("double").alias("mart_value"))
        for c, m in cols])).alias("u"))
    return long.select("metric_date", "u.metric_name", "u.mart_value")


def weekly_totals(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weekly sums and averages of the daily mart."""
    return daily.groupBy(*by, week_start("metric_date").alias("week_start")).agg(
        F.sum("total_steps").alias("total_steps"),
        F.sum("active_energy_kcal").alias("active_energy_kcal"),
        F.sum("exercise_minutes").alias("exercise_minutes"),
        F.avg("avg_heart_rate_bpm").alias("avg_heart_rate_bpm"),
        F.avg("resting_heart_rate_bpm").alias("avg_resting_heart_rate_bpm"),
        F.count(F.lit(1)).alias("days_with_data"))


#: Columns of :func:`weekly_totals` beside its keys, in output order.
TOTALS = ("total_steps", "active_energy_kcal", "exercise_minutes", "avg_heart_rate_bpm",
          "avg_resting_heart_rate_bpm", "days_with_data")


def trends_of(totals: DataFrame, by: Sequence[str] = (), keep: Sequence[str | Column] = ()) -> DataFrame:
    """Change of each week against the previous *present* one of its subject."""
    w = Window.partitionBy(*by).orderBy("week_start")
    prev_steps = F.lag("total_steps").over(w)
    prev_energy = F.lag("active_energy_kcal").over(w)
    prev_rhr = F.lag("avg_resting_heart_rate_bpm").over(w)
    return totals.select(
        *by, "week_start", *TOTALS,
        (F.col("total_steps") - prev_steps).alias("steps_change_vs_prev_week"),
        F.round(F.try_divide(F.col("total_steps") - prev_steps, prev_steps) * 100, 1)
        .alias("steps_pct_change_vs_prev_week"),
        F.round(F.try_divide(F.col("active_energy_kcal") - prev_energy, prev_energy) * 100, 1)
        .alias("active_energy_pct_change_vs_prev_week"),
        F.round(F.col("avg_resting_heart_rate_bpm") - prev_rhr, 1)
        .alias("resting_hr_change_vs_prev_week"), *keep)


def weekly_trends(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weekly sums/averages with change vs. the previous *present* week.

    With ``by`` (a subject key) weeks follow each other within a subject, and no
    window is global."""
    return trends_of(weekly_totals(daily, by), by)


def daily_weight_readings(stg: DataFrame, weight: str = WEIGHT_METRIC,
                          body_fat: str = BODY_FAT_METRIC, by: Sequence[str] = ()) -> DataFrame:
    """Max weight and max body fat per day over *all* readings of the day."""
    return (stg.filter(F.col("metric_name").isin(weight, body_fat))
            .groupBy(*by, "metric_date").agg(
                F.max(F.when(F.col("metric_name") == weight, F.col("value"))).alias("weight_kg"),
                F.max(F.when(F.col("metric_name") == body_fat, F.col("value"))).alias("body_fat_pct")))


def weekly_weight(stg: DataFrame, seeds: Mapping[int, float] = WEIGHT_SEEDS,
                  weight: str = WEIGHT_METRIC, body_fat: str = BODY_FAT_METRIC, by: Sequence[str] = ()) -> DataFrame:
    """Weekly average weight and body fat per ISO year-week, change in kg and
    in percentage points, and display strings.

    The days before the first real weight get the fixed ``seeds`` (days
    before -> kg); with no weight at all no seed row is emitted.  The seed
    rows are generated from the one-row scalar aggregate (no cross join);
    the full join is between one row per day and ``len(seeds)`` rows.
    """
    return weekly_weight_from_daily(daily_weight_readings(stg, weight, body_fat, by), seeds, by)


def seed_days(daily: DataFrame, seeds: Mapping[int, float] = WEIGHT_SEEDS, by: Sequence[str] = ()) -> DataFrame:
    """The days before the first real weight (of each subject) with their seeds
    (``metric_date, weight_kg, seed_first``); none without a weight."""
    first = (daily.filter(F.col("weight_kg").isNotNull()).groupBy(*by).agg(F.min("metric_date").alias("seed_first"))
             .filter(F.col("seed_first").isNotNull()))
    seed_arr = F.array(*[F.struct(F.lit(int(n)).alias("n"), F.lit(float(kg)).alias("kg"))
                         for n, kg in seeds.items()])
    return (first.select(*by, "seed_first", F.explode(seed_arr).alias("s"))
            .select(*by, F.date_add("seed_first", -F.col("s.n")).alias("metric_date"),
                    F.col("s.kg").alias("weight_kg"), "seed_first"))


def weekly_body(daily: DataFrame, seeded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weekly averages over days with readings and seeded days, unrounded; ``seed_first``:
    the first real weight's day, in weeks that hold a seed."""
    both = [*by, "metric_date"]
    d, s = daily.alias("d"), seeded.alias("s")
    same = F.lit(True)
    for c in both:
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) if c in by else same & (F.col(f"d.{c}") == F.col(f"s.{c}"))
    combined = d.join(s, same, "full").select(
        *[F.coalesce(f"d.{c}", f"s.{c}").alias(c) for c in both],
        F.coalesce("d.weight_kg", "s.weight_kg").alias("weight_kg"), "d.body_fat_pct", "s.seed_first")
    return combined.groupBy(
        *by, iso_year("metric_date").alias("iso_year"),
        F.weekofyear("metric_date").alias("iso_week")).agg(
        F.max("metric_date").alias("week_end_date"),
        F.avg("weight_kg").alias("kg"),
        F.avg("body_fat_pct").alias("fat"),
        F.max("seed_first").alias("seed_first"))


def weight_of(weeks: DataFrame, by: Sequence[str] = (), keep: Sequence[str | Column] = ()) -> DataFrame:
    """The weight mart from :func:`weekly_body`: change against the previous present week."""
    w = Window.partitionBy(*by).orderBy("week_end_date")
    trend = weeks.select(
        "*",
        (F.col("kg") - F.lag("kg").over(w)).alias("wchg"),
        (F.col("fat") - F.lag("fat").over(w)).alias("bchg"))
    return trend.select(
        *by, "week_end_date",
        F.concat(F.lpad(F.col("iso_year").cast("string"), 4, "0"), F.lit("-W"),
                 F.lpad(F.col("iso_week").cast("string"), 2, "0")).alias("year_week"),
        F.round("kg", 2).alias("weight_kg"),
        F.round("wchg", 2).alias("weekly_weight_change_kg"),
        F.round("fat", 2).alias("body_fat_pct"),
        F.round("bchg", 2).alias("weekly_body_fat_change_pp"),
        change_display("wchg").alias("weekly_weight_change_display"),
        change_display("bchg").alias("weekly_body_fat_change_display"), *keep)


def weekly_weight_from_daily(daily: DataFrame, seeds: Mapping[int, float] = WEIGHT_SEEDS, by: Sequence[str] = ()) -> DataFrame:
    """The weight mart from its per-day table (``metric_date, weight_kg,
    body_fat_pct``), so an incremental run only refreshes touched days."""
    return weight_of(weekly_body(daily, seed_days(daily, seeds, by), by), by)


def metric_freshness(stg: DataFrame, as_of: dt.date | str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per-metric counts, first/last day, coverage % and staleness.

    ``as_of`` replaces ``current_date()`` so results are reproducible.
    """
    per = stg.groupBy(*by, "metric_name").agg(
        F.count(F.lit(1)).alias("datapoint_count"),
        F.min("metric_date").alias("first_date"),
        F.max("metric_date").alias("last_date"),
        F.max("ingested_at").alias("last_ingested_at"),
        F.count_distinct("metric_date").alias("days_with_data"))
    return freshness_of(per, as_of, by)


def freshness_of(per: DataFrame, as_of: dt.date | str | None, by: Sequence[str] = ()) -> DataFrame:
    """The freshness mart from counts, first and last day, and days with data per metric."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    span = (F.datediff("last_date", "first_date") + 1).cast("long")
    return per.select(
        *by, "metric_name", "datapoint_count", "first_date", "last_date", "last_ingested_at",
        "days_with_data",
        span.alias("calendar_days_span"),
        F.round(F.col("days_with_data") / F.nullif(span, F.lit(0)) * 100, 1).alias("coverage_pct"),
        F.datediff(today, "last_date").cast("long").alias("days_since_last_data"))


def metric_day_counts(stg: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per (metric, local day): readings and newest load time -- the small
    table the freshness mart is derived from."""
    return stg.groupBy(*by, "metric_name", "metric_date").agg(
        F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("last_ingested_at"))


def freshness_from_day_counts(dc: DataFrame, as_of: dt.date | str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``metric_freshness`` from :func:`metric_day_counts` (same output)."""
    per = dc.groupBy(*by, "metric_name").agg(
        F.sum("n").alias("datapoint_count"),
        F.min("metric_date").alias("first_date"),
        F.max("metric_date").alias("last_date"),
        F.max("last_ingested_at").alias("last_ingested_at"),
        F.count(F.lit(1)).alias("days_with_data"))
    return freshness_of(per, as_of, by)


# Final sort of each mart, applied when it is read (not paid for when stored):
# mart -> [(column, descending)].
MART_ORDER: dict[str, list[tuple[str, bool]]] = {
    "fct_daily_activity_summary": [("metric_date", False)],
    "fct_weekly_trends": [("week_start", False)],
    "fct_weekly_weight_trends": [("week_end_date", False)],
    "fct_metric_freshness": [("days_since_last_data", True), ("metric_name", False)],
}


def order_columns(name: str) -> list[Column]:
    return [F.col(c).desc() if d else F.col(c).asc() for c, d in MART_ORDER[name]]


def numbered(name: str, mart: DataFrame) -> DataFrame:
    """``mart`` with ``row_no``, its row's place in the final sort.  The window is
    global, over one row per day, week or metric."""
    return mart.withColumn("row_no", F.row_number().over(Window.orderBy(*order_columns(name))))

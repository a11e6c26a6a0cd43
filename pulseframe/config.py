"""Domain constants of the wearable-health pipeline.

Everything here is configuration, not code: metric lists, the cumulative
set, mart pivot columns, range-check bounds, weight seeds and freshness
limits.  Functions take these as default arguments so a caller can pass
their own.
"""

from __future__ import annotations

# --- fixed values (must equal the reference's for identical results) -------
# Accepted metric names, in the reference's order.
ACCEPTED_METRICS = (
    "heart_rate",
    "resting_heart_rate",
    "heart_rate_variability",
    "step_count",
    "active_energy",
    "apple_exercise_time",
    "apple_stand_time",
    "walking_running_distance",
    "walking_speed",
    "flights_climbed",
    "vo2_max",
    "sleep_analysis",
    "weight_body_mass",
    "body_mass_index",
    "body_fat_percentage",
    "lean_body_mass",
    "time_in_daylight",
    "cardio_recovery",
    "six_minute_walking_test_distance",
    "running_power",
    "running_speed",
    "blood_pressure",
    "waist_circumference",
    "height",
)

# Metrics whose day value is a sum of intraday readings; all others average.
CUMULATIVE_METRICS = (
    "step_count",
    "active_energy",
    "apple_exercise_time",
    "apple_stand_time",
    "flights_climbed",
    "walking_running_distance",
)

# Daily mart pivot: (output column, metric name), in output order.
DAILY_COLUMNS = (
    ("total_steps", "step_count"),
    ("active_energy_kcal", "active_energy"),
    ("exercise_minutes", "apple_exercise_time"),
    ("stand_minutes", "apple_stand_time"),
    ("flights_climbed", "flights_climbed"),
    ("distance_km", "walking_running_distance"),
    ("avg_heart_rate_bpm", "heart_rate"),
    ("resting_heart_rate_bpm", "resting_heart_rate"),
    ("avg_hrv_ms", "heart_rate_variability"),
    ("weight_kg", "weight_body_mass"),
)

# Inclusive bounds of the daily mart's range checks: column -> (min, max).
DAILY_RANGES = {
    "total_steps": (0, 60000),
    "active_energy_kcal": (0, 6000),
    "exercise_minutes": (0, 600),
    "stand_minutes": (0, 1440),
    "flights_climbed": (0, 300),
    "distance_km": (0, 200),
    "avg_heart_rate_bpm": (30, 220),
    "resting_heart_rate_bpm": (30, 120),
    "avg_hrv_ms": (0, 300),
    "weight_kg": (20, 300),
}

# Weight seeds for the days before the first real weight reading:
# days-before-first-reading -> kg.
WEIGHT_SEEDS = {3: 90.70, 2: 90.30, 1: 89.70}

WEIGHT_METRIC = "weight_body_mass"
BODY_FAT_METRIC = "body_fat_percentage"

# Source freshness limits on Bronze `_ingested_at`, in hours.
FRESHNESS_WARN_HOURS = 26
FRESHNESS_ERROR_HOURS = 50

# Local time text of the daily rollup reading.
ROLLUP_TIME_TEXT = "00:00:00"

# Reading date text pattern (local time and offset).
READING_TS_PATTERN = "yyyy-MM-dd HH:mm:ss XX"

# Display arrows for week-over-week changes.
DISPLAY_DOWN = '<span style="color:red;">&#x25BC;</span>'
DISPLAY_UP = '<span style="color:green;">&#x25B2;</span>'
DISPLAY_FLAT = '<span style="color:orange;">&#x2014;</span>'

# Mart name -> column its tail is ordered by (unknown marts are rejected).
TAIL_ORDER = {
    "fct_weekly_trends": "week_start",
    "fct_daily_activity_summary": "metric_date",
    "fct_metric_freshness": "days_since_last_data",
}
# --- end of fixed values ----------------------------------------------------

# Options of every parse of a whole document: strings of any length, strict quotes.
DOCUMENT_JSON = {"maxStringLen": "2147483647", "allowSingleQuotes": "false"}

# Expectations applied between the flatten and Silver (name -> SQL predicate).
SILVER_EXPECTATIONS = {
    "valid_metric_name": "metric_name IS NOT NULL",
    "valid_date": "date IS NOT NULL",
}

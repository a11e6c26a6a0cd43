"""Silver base (latest reading wins) and the typed staging projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ROLLUP_TIME_TEXT

SILVER_KEYS = ("metric_name", "date")


def default_recency(df: DataFrame) -> list[Column]:
    """Recency order, most significant first, all descending.

    ``ingested_at`` decides; ties go to the larger value (nulls last), then
    to the larger file name and reading text, so the pick is deterministic
    in batch, stream and SQL alike.
    """
    return [F.col("ingested_at"), F.coalesce("value_qty", "value_avg"),
            F.col("source_file"), F.col("value_raw")]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per key: the greatest ``order`` (all descending).

    Written as ``max(struct(order..., row...))`` so it runs as a partial
    (map-side) aggregate followed by a final one: each map task ships at most
    one row per key, so a hot key holding a third of the data costs no more
    shuffle than a cold one, and no key group is ever gathered in one task.
    Struct comparison sorts NULL first, i.e. ``desc nulls last`` under max.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordered = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                       *[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(F.max(ordered).alias("_w"))
            .select(*keys, *[F.col("_w")[c].alias(c) for c in rest]))


def latest_readings(df: DataFrame, keys: Sequence[str] = SILVER_KEYS,
                    order: Sequence[Column] | None = None) -> DataFrame:
    """Silver base: newest reading per (metric_name, date)."""
    return latest_by(df, keys, order if order is not None else default_recency(df))


def reading_date_text(value_raw: Column) -> Column:
    return F.get_json_object(value_raw, "$.date")


# The staging projection, one SQL expression per output column.
_DATE_TEXT = "get_json_object(value_raw, '$.date')"
_STAGED = {
    "metric_name": "metric_name",
    "units": "lower(units)",
    "metric_date": f"to_date(try_to_timestamp(substring({_DATE_TEXT}, 1, 10), 'yyyy-MM-dd'))",
    "metric_timestamp": "date",
    "value_qty": "value_qty", "value_avg": "value_avg", "value_min": "value_min", "value_max": "value_max",
    "value": "coalesce(value_qty, value_avg)",
    "is_daily_rollup": f"substring({_DATE_TEXT}, 12, 8) = '{ROLLUP_TIME_TEXT}'",
    "source_file": "source_file", "ingested_at": "ingested_at",
}
_STAGED_ROWS = "metric_name IS NOT NULL AND date IS NOT NULL"


def stage_readings(base: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Typed staging projection over Silver base.

    The local calendar day and the rollup flag come from the original
    reading text (first 10 characters / characters 12-19), never from the
    UTC instant.  Rows without a metric name or a parsed date are dropped.
    ``by`` names subject columns to keep.
    """
    return base.filter(_STAGED_ROWS).select(*by, *[F.expr(e).alias(c) for c, e in _STAGED.items()])


def staging_sql(base: str) -> str:
    """The same projection as the text of a view over the named Silver base."""
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in _STAGED.items())} FROM {base} WHERE {_STAGED_ROWS}"

"""The macros as SQL functions, for use from ``spark.sql``.

``color_change(value[, decimals])`` and ``out_of_range(value, lowest, highest)`` are scalar
functions; the second gives the value where it is outside its inclusive bounds (null:
open), else null.  ``register_range_check`` makes the range test of one column of a named
table a table function, ``name(lowest, highest)``, that gives the violating values.  All are
temporary SQL functions, inlined by Catalyst: a query that calls them plans like one that
spells them out, with no Python worker and no join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..config import DISPLAY_DOWN, DISPLAY_FLAT, DISPLAY_UP

#: Most decimals ``color_change`` rounds to (Spark wants constant scales, so each is a branch).
MAX_DECIMALS = 6


def register_macros(spark: SparkSession) -> None:
    rounded = " ".join(f"WHEN {d} THEN CAST(round(value, {d}) AS STRING)" for d in range(MAX_DECIMALS + 1))
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION color_change(value DOUBLE, decimals INT DEFAULT 2)
RETURNS STRING
COMMENT 'rounded number and an arrow by the sign of the unrounded one'
RETURN concat(CASE decimals {rounded} ELSE raise_error('color_change: decimals from 0 to {MAX_DECIMALS}') END, ' ',
  CASE WHEN value < 0 THEN '{DISPLAY_DOWN}' WHEN value > 0 THEN '{DISPLAY_UP}' WHEN value = 0 THEN '{DISPLAY_FLAT}' ELSE '' END)""")
    spark.sql("""
CREATE OR REPLACE TEMPORARY FUNCTION out_of_range(value DOUBLE, lowest DOUBLE, highest DOUBLE)
RETURNS DOUBLE
COMMENT 'the value, where it is below the lowest or above the highest'
RETURN CASE WHEN value < lowest OR value > highest THEN value END""")


def register_range_check(spark: SparkSession, name: str, table: str, column: str) -> None:
    """``SELECT * FROM name(lowest, highest)``: values of the column outside the bounds."""
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(lowest DOUBLE DEFAULT NULL, highest DOUBLE DEFAULT NULL)
RETURNS TABLE(value_to_check DOUBLE)
RETURN SELECT CAST(`{column}` AS DOUBLE) FROM {table} WHERE `{column}` < lowest OR `{column}` > highest""")


def range_violations(spark: SparkSession, table: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """``column_name, value_to_check`` of every value of a named table outside its bounds, in SQL."""
    def literal(bound) -> str:
        return "CAST(NULL AS DOUBLE)" if bound is None else f"CAST({float(bound)!r} AS DOUBLE)"

    if bad := [c for c, (lo, hi) in ranges.items() if lo is None and hi is None]:
        raise ValueError(f"no bounds for {bad}")
    rows = ", ".join(f"'{c}', CAST(t.`{c}` AS DOUBLE), {literal(lo)}, {literal(hi)}" for c, (lo, hi) in ranges.items())
    return spark.sql(f"""
SELECT column_name, out_of_range(value, lowest, highest) AS value_to_check
FROM (SELECT stack({len(ranges)}, {rows}) AS (column_name, value, lowest, highest) FROM {table} t)
WHERE out_of_range(value, lowest, highest) IS NOT NULL""")

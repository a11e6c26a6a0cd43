"""Projection used when a result is compared with another engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

COMPARE_DIGITS = 6


def rounded(df: DataFrame, digits: int = COMPARE_DIGITS) -> DataFrame:
    """Round every floating column (to 6 places), so sums taken in a different order by
    another engine hash alike (the value itself is not changed otherwise)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields])

"""Column helpers shared by marts, checks and reports (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DISPLAY_DOWN, DISPLAY_FLAT, DISPLAY_UP


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def change_display(col: Column | str, decimals: int = 2) -> Column:
    """Rounded number, a space and a coloured arrow; the sign is taken from
    the unrounded value.  NULL in gives NULL out (concat of NULL)."""
    c = _c(col)
    arrow = (F.when(c < 0, F.lit(DISPLAY_DOWN))
             .when(c > 0, F.lit(DISPLAY_UP))
             .when(c == 0, F.lit(DISPLAY_FLAT))
             .otherwise(F.lit("")))
    return F.concat(F.round(c, decimals).cast("string"), F.lit(" "), arrow)


def week_start(col: Column | str) -> Column:
    """Monday of the ISO week, as a timestamp (``date_trunc('week', d)``)."""
    return F.date_trunc("week", _c(col))


def iso_year(col: Column | str) -> Column:
    """ISO year: the calendar year of that week's Thursday."""
    return F.year(F.date_add(F.to_date(week_start(col)), 3))


def iso_year_week(col: Column | str) -> Column:
    """``YYYY-Www`` label of the ISO week of a date."""
    return F.concat(F.lpad(iso_year(col).cast("string"), 4, "0"), F.lit("-W"),
                    F.lpad(F.weekofyear(_c(col)).cast("string"), 2, "0"))


def local_date_from_text(text: Column | str) -> Column:
    """Calendar day from the first 10 characters of a local time text."""
    return F.to_date(F.try_to_timestamp(F.substring(_c(text), 1, 10), F.lit("yyyy-MM-dd")))

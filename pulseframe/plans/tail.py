"""Latest N rows of a mart (the ad hoc tail report)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TAIL_ORDER


def tail(mart: DataFrame, name: str, n: int = 10, order_by: dict | None = None) -> DataFrame:
    """``ORDER BY <mart's column> DESC LIMIT n`` (a top-k, not a full sort);
    unknown mart names are rejected."""
    known = order_by or TAIL_ORDER
    if name not in known:
        raise ValueError(f"no tail order is set for mart {name!r}; set for: {sorted(known)}")
    return mart.orderBy(F.col(known[name]).desc()).limit(int(n))

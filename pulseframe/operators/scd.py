"""Change data capture targets without MERGE: SCD type 1 and type 2.

SCD1 keeps the row with the greatest sequence per key (``latest_by``: a
partial + final aggregate, order independent, so replaying files in any
order -- or an old file arriving late -- gives the same table).

SCD2 keeps every version of a key: a new version opens when a tracked
column changes (NULL-safe, so a change to NULL opens one and repeated NULLs
do not).  The open version's other columns follow its newest event.
``__START_AT`` is the sequence value that opened the version, ``__END_AT``
the start of the next version (NULL while current).

Scale: SCD2 first folds events to one row per (key, sequence) with a
partial aggregate, then finds changes inside range-partitioned chunks of (key,
sequence), one plan for every size, so even a key holding a third of all events
is split across tasks (see :func:`scd2`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .latest import latest_by

START, END = "__START_AT", "__END_AT"


def _tie_break(df: DataFrame) -> list[Column]:
    cols = [F.coalesce("value_qty", "value_avg")] if {"value_qty", "value_avg"} <= set(df.columns) else []
    return cols + [F.col(c) for c in ("source_file", "value_raw") if c in df.columns]


def scd1(df: DataFrame, keys: Sequence[str], sequence: Sequence[Column]) -> DataFrame:
    """Current row per key: greatest ``sequence`` (a list of columns compared
    left to right, like a struct), remaining ties by the larger value."""
    return latest_by(df, keys, list(sequence) + _tie_break(df))


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Left join of a small boundary table on NULL-safe equal columns."""
    renamed = right.withColumnsRenamed({c: f"_b_{c}" for c in cols})
    cond = None
    for c in cols:
        same = F.col(c).eqNullSafe(F.col(f"_b_{c}"))
        cond = same if cond is None else cond & same
    return left.join(F.broadcast(renamed), cond, "left").drop(*[f"_b_{c}" for c in cols])


def scd2(df: DataFrame, keys: Sequence[str], sequence: str, track: Sequence[str],
         chunks: int | None = None) -> DataFrame:
    """Version history of ``track`` per key, ordered by column ``sequence``.

    Events are first folded to one per (key, sequence) by a partial aggregate.
    They are then range-partitioned on (key, sequence) into ``chunks`` parts
    (default: the session's shuffle partitions), so a hot key spans several
    consecutive chunks and no key is ever gathered whole in one task.  Change
    detection, version starts and next-version bounds are windows inside a
    (key, chunk) group; only keys cut by a chunk boundary -- at most the first
    and last key of each chunk -- need the neighbouring chunks, and their
    first/last rows (at most 4 per chunk, broadcast with that bound) are
    stitched with a window over (key, chunk) on that tiny table.  NULL is a key
    value like any other.  Versions are a partial + final aggregate per
    (key, version start).
    """
    keys, track = list(keys), list(track)
    spark = df.sparkSession
    ev = stored(spark, latest_by(df, keys + [sequence], _tie_break(df)), "scd2-events")
    n = int(chunks or spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in ev.columns if c not in keys + [sequence]]
    seq = F.col(sequence)
    ev = (ev.repartitionByRange(n, *[F.col(k) for k in keys], seq)
          .withColumn("_chunk", F.spark_partition_id()))
    part = keys + ["_chunk"]
    wc = Window.partitionBy(*part).orderBy(sequence)
    ev = ev.select(
        "*",
        F.row_number().over(wc).alias("_rn"),
        F.row_number().over(Window.partitionBy(*part).orderBy(seq.desc())).alias("_rnd"),
        *[F.lag(c).over(wc).alias(f"_p_{c}") for c in track])
    # The chunked events feed the boundary tables and the main path: write
    # them once (in the shared checkpoint folder) so the
    # upstream is not recomputed per consumer and chunk ids stay fixed.
    ev = stored(spark, ev, "scd2-chunks")

    # Keys cut by a chunk boundary: the smallest and largest key of a chunk.
    kst = F.struct(*keys)
    bounds = ev.groupBy("_chunk").agg(F.min(kst).alias("_kmin"), F.max(kst).alias("_kmax"))

    def boundary_rows(frame: DataFrame) -> DataFrame:
        b = frame.filter((F.col("_rn") == 1) | (F.col("_rnd") == 1)).join(
            F.broadcast(bounds), "_chunk")
        return b.filter(kst.eqNullSafe(F.col("_kmin")) | kst.eqNullSafe(F.col("_kmax")))

    # 1) Is the first row of a (key, chunk) a change versus the key's last
    #    row in the previous chunk?
    b1 = boundary_rows(ev)
    per_chunk = b1.groupBy(*part).agg(
        *[F.max(F.when(F.col("_rnd") == 1, F.struct(F.lit(1).alias("x"), F.col(c).alias("v"))))
          .alias(f"_last_{c}") for c in track],
        *[F.max(F.when(F.col("_rn") == 1, F.struct(F.lit(1).alias("x"), F.col(c).alias("v"))))
          .alias(f"_first_{c}") for c in track])
    wk = Window.partitionBy(*keys).orderBy("_chunk")
    first_change = None
    for c in track:
        prev_last = F.lag(F.col(f"_last_{c}")["v"]).over(wk)
        diff = ~F.col(f"_first_{c}")["v"].eqNullSafe(prev_last)
        first_change = diff if first_change is None else first_change | diff
    has_prev = F.lag("_chunk").over(wk).isNotNull()
    fix1 = per_chunk.select(*part, F.when(has_prev, first_change).alias("_first_new"))
    ev = _same(ev, fix1, part)
    local_change = None
    for c in track:
        diff = ~F.col(c).eqNullSafe(F.col(f"_p_{c}"))
        local_change = diff if local_change is None else local_change | diff
    is_new = (F.when(F.col("_rn") == 1, F.coalesce(F.col("_first_new"), F.lit(True)))
              .otherwise(local_change))
    ev = ev.withColumn("_new", is_new)

    # 2) Version start at or before each row, next version start after it.
    start_seq = F.when(F.col("_new"), seq)
    ev = ev.select(
        "*",
        F.last(start_seq, ignorenulls=True).over(
            wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_start_local"),
        F.first(start_seq, ignorenulls=True).over(
            wc.rowsBetween(1, Window.unboundedFollowing)).alias("_next_local"))
    b2 = boundary_rows(ev)
    per_chunk2 = b2.groupBy(*part).agg(
        F.max(F.when(F.col("_rnd") == 1, F.col("_start_local"))).alias("_chunk_last_start"),
        F.max(F.when(F.col("_rn") == 1, F.coalesce(start_seq, F.col("_next_local"))))
        .alias("_chunk_first_start"))
    fix2 = per_chunk2.select(
        *part,
        F.last("_chunk_last_start", ignorenulls=True).over(
            wk.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev_start"),
        F.first("_chunk_first_start", ignorenulls=True).over(
            wk.rowsBetween(1, Window.unboundedFollowing)).alias("_next_start"))
    ev = _same(ev, fix2, part)
    ev = ev.select(
        *keys, seq, *rest,
        F.coalesce("_start_local", "_prev_start").alias(START),
        F.coalesce("_next_local", "_next_start").alias("_next"))

    # 3) One row per version: the newest event's columns, start and end.
    versions = ev.groupBy(*keys, START).agg(
        F.max(F.struct(seq, *[F.col(c) for c in rest])).alias("_last"),
        F.max("_next").alias(END))
    return versions.select(
        *keys, *[F.col("_last")[c].alias(c) for c in rest],
        F.col("_last")[sequence].alias(sequence), F.col(START), F.col(END))

"""Expect-or-drop expectations with counts, and the expectation event log.

``expect`` returns the kept rows plus per-expectation pass/fail counts from
the same input (two aggregates over one plan; no Python callback per row).
The log holds one event per batch whose ``expectations`` text is a JSON array of
``{name, dataset, passed_records, failed_records}``; batch jobs and streams write it
with ``write_event``;
``expectation_latest`` / ``expectation_totals`` read it back.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXPECTATION_TYPE = ("array<struct<name: string, dataset: string, "
                    "passed_records: bigint, failed_records: bigint>>")


def expect(df: DataFrame, expectations: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, counts): rows failing any expectation are dropped; counts
    are per expectation over all input rows (``name, passed_records,
    failed_records``)."""
    conds = {n: F.coalesce(F.expr(p), F.lit(False)) for n, p in expectations.items()}
    keep = None
    for c in conds.values():
        keep = c if keep is None else keep & c
    kept = df.filter(keep) if keep is not None else df
    counts = df.agg(*[F.count_if(c).alias(f"p_{i}") for i, c in enumerate(conds.values())],
                    F.count(F.lit(1)).alias("n"))
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(f"p_{i}").alias("passed_records"),
                 (F.col("n") - F.col(f"p_{i}")).alias("failed_records"))
        for i, n in enumerate(conds)]))
    return kept, counts.select(rows.alias("e")).select("e.*")


#: One event per batch, whoever writes it: ``batch_id`` grows from batch to batch, also
#: over an empty one; ``timestamp`` is when the counts were taken.
EVENT_SCHEMA = "batch_id long, timestamp timestamp, expectations string"


def write_event(spark: SparkSession, path: str, batch_id: int, counts: list[dict], dataset: str, at: str | None = None) -> None:
    """Log one batch's counts (``name, passed_records, failed_records``) as an event.

    The event has a folder of its own, so that a batch replayed after a failure replaces
    its event instead of adding one.  ``at`` pins the clock (default: now)."""
    text = json.dumps([{"name": c["name"], "dataset": dataset, "passed_records": c["passed_records"],
                        "failed_records": c["failed_records"]} for c in counts])
    clock = F.current_timestamp() if at is None else F.lit(str(at)).cast("timestamp")
    event = spark.range(1).select(clock.alias("timestamp"), F.lit(text).alias("expectations"))
    event.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(path)


def expectation_events(df: DataFrame, expectations: Mapping[str, str], batch: str | Column,
                       dataset: str) -> DataFrame:
    """The events of many batches at once: ``batch_id, timestamp, expectations`` (JSON), with
    the newest load time of a batch for its clock.

    Counts are a partial aggregate per (batch); the per-event array holds
    one element per expectation, so it is bounded by the expectation list.
    """
    conds = {n: F.coalesce(F.expr(p), F.lit(False)) for n, p in expectations.items()}
    b = F.col(batch) if isinstance(batch, str) else batch
    agg = df.groupBy(b.alias("batch_id")).agg(
        F.max("ingested_at").alias("timestamp"),
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(c).alias(f"_p{i}") for i, c in enumerate(conds.values())])
    arr = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(dataset).alias("dataset"),
                 F.col(f"_p{i}").alias("passed_records"),
                 (F.col("_n") - F.col(f"_p{i}")).alias("failed_records"))
        for i, n in enumerate(conds)])
    return agg.select("batch_id", "timestamp", F.to_json(arr).alias("expectations"))


def _explode_log(log: DataFrame) -> DataFrame:
    return (log.select("timestamp", F.explode(F.from_json("expectations", EXPECTATION_TYPE)).alias("e"))
            .select("timestamp", "e.*"))


def expectation_latest(log: DataFrame) -> DataFrame:
    """Per-expectation counts of the most recent event only: of events at one time, the
    one of the last batch."""
    order = [c for c in ("timestamp", "batch_id") if c in log.columns]
    latest = log.orderBy(*[F.col(c).desc() for c in order]).limit(1)
    return _explode_log(latest).select(
        "dataset", F.col("name").alias("expectation"), "passed_records",
        F.col("failed_records").alias("dropped_records"))


def expectation_totals(log: DataFrame) -> DataFrame:
    """Cumulative counts per expectation over every event."""
    return _explode_log(log).groupBy(F.col("name").alias("expectation")).agg(
        F.count(F.lit(1)).alias("num_batches"),
        F.sum("passed_records").alias("cumulative_passed"),
        F.sum("failed_records").alias("cumulative_dropped"))


def dropped_total(counts: DataFrame, column: str = "failed_records") -> DataFrame:
    """Grand total of dropped rows."""
    return counts.agg(F.coalesce(F.sum(column), F.lit(0)).cast("long").alias("total_dropped"))


def expect_observed(df: DataFrame, expectations: Mapping[str, str],
                    name: str = "expectations"):
    """Expect-or-drop with the counts gathered by the *same* job.

    Returns ``(kept, observation)``: the counts are collected as observed
    metrics of whatever action consumes ``kept`` (e.g. the Silver write), so
    the input is not scanned a second time for them.  Read them afterwards
    with :func:`observed_counts`.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    conds = {n: F.coalesce(F.expr(p), F.lit(False)) for n, p in expectations.items()}
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"),
                          *[F.count_if(c).alias(f"p_{i}") for i, c in enumerate(conds.values())])
    keep = None
    for c in conds.values():
        keep = c if keep is None else keep & c
    return (observed.filter(keep) if keep is not None else observed), obs


def observed_counts(obs, expectations: Mapping[str, str]) -> list[dict]:
    """``[{name, passed_records, failed_records}]`` from a finished observation
    (one small dict per expectation)."""
    m = obs.get
    n = int(m.get("n", 0))
    return [{"name": k, "passed_records": int(m[f"p_{i}"]), "failed_records": n - int(m[f"p_{i}"])}
            for i, k in enumerate(expectations)]

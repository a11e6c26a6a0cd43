"""Bronze -> Silver -> staging chain over the driver tables.

Bronze is flattened once and Silver (deduped) is written to shared storage,
partitioned by metric (and day), so later marts prune by metric and never
repeat the JSON explode.  Writes are rebalanced: adaptive execution splits a
large partition value over several tasks and merges small ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SILVER_EXPECTATIONS
from ..operators.flatten import explode_readings
from ..operators.latest import latest_readings, stage_readings
from ..session import apply_defaults, scratch, stored
from ..sources import driver_tables as dtab


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows (one per export file) derived from ``events``.

    The grouping shuffle that builds the documents carries an explicit partition
    count (see ``export_documents``), which adaptive execution keeps, so the
    flatten that follows stays spread over the cluster without a second shuffle.
    """
    apply_defaults(spark)
    return dtab.bronze_table(dtab.table(spark, sf_dir, "events"))


def expectation_filter(df: DataFrame, expectations: dict[str, str] = SILVER_EXPECTATIONS) -> DataFrame:
    """Rows passing every expectation (the drop half of expect-or-drop)."""
    cond = None
    for pred in expectations.values():
        c = F.expr(pred)
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened readings, before expectations and dedup."""
    return explode_readings(bronze(spark, sf_dir))


def silver_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduped Silver base: expectations first, then latest-wins."""
    return latest_readings(expectation_filter(exploded(spark, sf_dir)))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_readings(silver_base(spark, sf_dir))


def write_silver(base: DataFrame, path: str) -> None:
    """Persist Silver once, partitioned by metric: marts that filter on a
    metric prune partitions at the scan, and the JSON explode is never
    repeated per mart.  Also cuts the lineage back to Bronze."""
    (base.hint("rebalance", "metric_name").write.mode("overwrite")
     .partitionBy("metric_name").parquet(path))


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- Silver of several persons ---------------------------------------------------
SUBJECT = ("subject",)
SUBJECT_PARTS = 64


def write_silver_by_subject(base: DataFrame, path: str, parts: int = SUBJECT_PARTS) -> None:
    """Silver with a subject key, dealt to a fixed number of folders by a hash of it: a
    person's readings lie together, and the number of folders does not follow the
    number of persons."""
    part = F.pmod(F.xxhash64("subject"), F.lit(parts)).cast("int")
    (base.withColumn("subject_part", part).hint("rebalance", "subject_part").write.mode("overwrite")
     .partitionBy("subject_part").parquet(path))


# --- Silver with the reading as VARIANT ------------------------------------------
def write_silver_variant(base: DataFrame, path: str) -> None:
    """Silver that keeps the reading itself instead of columns cut from it: a VARIANT,
    which the writer shreds into typed Parquet columns per field."""
    rows = base.select("metric_name", "units", "date", F.try_parse_json("value_raw").alias("reading"), "source_file", "ingested_at")
    rows.hint("rebalance", "metric_name").write.mode("overwrite").partitionBy("metric_name").parquet(path)


def reading_number(reading: str, *fields: str) -> Column:
    """The first of some number fields of a VARIANT reading; through text, as in the flatten."""
    return F.coalesce(*[F.try_variant_get(reading, f"$.{f}", "string") for f in fields]).try_cast("double")


def read_silver_variant(spark: SparkSession, path: str) -> DataFrame:
    """The Silver columns read from the stored VARIANT; a query reads only the paths of the
    columns it uses."""
    rows = spark.read.parquet(path)
    return rows.select(
        "metric_name", "units", "date", reading_number("reading", "qty").alias("value_qty"),
        reading_number("reading", "Avg", "avg").alias("value_avg"), reading_number("reading", "Min", "min").alias("value_min"),
        reading_number("reading", "Max", "max").alias("value_max"), F.try_variant_get("reading", "$.date", "string").alias("date_text"),
        "source_file", "ingested_at")


# --- incremental Silver --------------------------------------------------------
SILVER_PARTS = ("metric_name", "reading_day")


def _with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reading_day", F.to_date("date"))


def write_silver_by_day(base: DataFrame, path: str) -> None:
    """Silver partitioned by (metric, UTC day of the reading)."""
    (_with_day(base).hint("rebalance", *SILVER_PARTS).write.mode("overwrite")
     .partitionBy(*SILVER_PARTS).parquet(path))


def merge_silver(spark: SparkSession, path: str, new_rows: DataFrame) -> DataFrame:
    """Fold newly landed readings into Silver, rewriting only the touched
    (metric, day) partitions.

    The touched partitions are the distinct (metric, day) pairs of the new
    rows; the existing rows of exactly those partitions are read back (a
    semi-join on the partition columns, pruned at the scan by dynamic
    partition pruning), unioned with the new rows and folded again with the
    same latest-wins aggregate.  New rows, touched pairs and the merged rows are
    each stored once in the shared folder (the merged rows because they are read
    from the partitions they replace).  Returns the touched
    partition list.
    """
    with scratch(spark) as keep:
        new = keep(_with_day(new_rows), "new-readings")
        touched = stored(spark, new.select(*SILVER_PARTS).distinct(), "touched-parts")
        old = spark.read.parquet(path).join(touched, list(SILVER_PARTS), "left_semi")
        cols = [c for c in old.columns if c not in SILVER_PARTS]
        both = old.select(*cols, *SILVER_PARTS).unionByName(new.select(*cols, *SILVER_PARTS))
        merged = keep(latest_readings(both.drop("reading_day")).transform(_with_day), "merged-readings")
        (merged.hint("rebalance", *SILVER_PARTS).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*SILVER_PARTS).parquet(path))
    return touched

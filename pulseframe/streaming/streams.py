"""Structured Streaming versions of the ingest, flatten and CDC steps.

* ``ingest_files``: new export files -> Bronze parquet (append, checkpointed,
  run-to-completion trigger); a restart reads only files not yet seen.
* ``flatten_stream``: Bronze stream -> the same ``explode_readings`` as batch
  -> expectations -> Silver staging parquet.
* ``evolving_stream``: Bronze stream -> readings typed by an evolving schema, the rest
  rescued.
* ``dedup_stream``: exact resends dropped by content hash, with bounded state.
* ``scd1_stream``: stateful aggregate ``max(struct(sequence, row))`` per key
  (state store, update mode); each micro-batch folds the keys whose winner
  changed into a target table of one row per key.
* ``scd2_stream``: each micro-batch folds its events, one per (key, sequence),
  into an event table and derives the versions of the touched partitions into
  a history table, so a late file that falls between two versions splits them.

Both targets are partitioned by a part of the key; a batch rewrites only the
partitions it touches.  Folds are idempotent, so a batch replayed after a
failure gives the same tables.

All paths are under the shared checkpoint folder; nothing is collected to
the driver (no memory sink).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from ..config import SILVER_EXPECTATIONS
from ..operators.expectations import expect_observed, observed_counts, write_event
from ..operators.flatten import explode_readings, reading_texts
from ..operators.latest import latest_by
from ..operators.scd import _tie_break, scd2
from ..operators.schema_evolution import MAX_FIELDS, evolve, fields_of, read_evolved, read_with_schema
from ..plans.silver import expectation_filter
from ..session import checkpoint_base, read_if_there, scratch
from ..sources.exports import BRONZE_SCHEMA

SOURCE_FROM_PATH = r"_source_file=([^/]+)"


def _run(q: StreamingQuery) -> StreamingQuery:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def ingest_files(spark: SparkSession, landing: str, bronze_path: str, checkpoint: str,
                 max_files: int | None = None, glob: str | None = None) -> StreamingQuery:
    """Append every new file under ``landing`` to the Bronze parquet table."""
    r = spark.readStream.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    raw = r.text(landing, wholetext=True)
    path = F.col("_metadata.file_path")
    from_dir = F.regexp_extract(path, SOURCE_FROM_PATH, 1)
    name = F.when(from_dir != "", from_dir).otherwise(F.col("_metadata.file_name"))
    bronze = raw.select(
        F.col("value").alias("data"),
        F.lit(None).cast("string").alias("_rescued_data"),
        F.current_timestamp().alias("_ingested_at"),
        F.url_decode(name).alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"))
    q = (bronze.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(bronze_path))
    return _run(q)


def read_bronze_stream(spark: SparkSession, bronze_path: str, max_files: int | None = None) -> DataFrame:
    schema = StructType(BRONZE_SCHEMA.fields + [StructField("file_modification_time", TimestampType())])
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(bronze_path)


#: Micro-batches in which :func:`batch_files` has waiting files read, however many there are.
MICRO_BATCHES = 4


def count_files(spark: SparkSession, bronze_path: str) -> int:
    """Files of a Bronze table, as a stream's source lists them."""
    return len(spark.read.parquet(bronze_path).inputFiles())


def batch_files(waiting: int, least: int = 1, batches: int = MICRO_BATCHES) -> int:
    """``max_files`` by which ``waiting`` files are read in at most ``batches`` micro-batches of
    ``least`` files or more.

    A batch commits every state partition and writes its log whatever it reads.  Files and
    partitions both follow the data, so batches of a fixed number of files cost their square.
    """
    return max(least, -(-waiting // batches))


def silver_stream(bronze: DataFrame, expectations: dict[str, str] = SILVER_EXPECTATIONS) -> DataFrame:
    """Flatten + expect-or-drop on a (streaming or batch) Bronze DataFrame."""
    return silver_keep(explode_readings(bronze), expectations)


def flatten_stream(spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str,
                   max_files: int | None = None) -> StreamingQuery:
    rows = silver_stream(read_bronze_stream(spark, bronze_path, max_files))
    q = (rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(silver_path))
    return _run(q)


def flatten_stream_logged(spark: SparkSession, bronze_path: str, silver_path: str, log_path: str,
                          checkpoint: str, expectations: dict[str, str] = SILVER_EXPECTATIONS,
                          dataset: str = "silver_readings_staging",
                          max_files: int | None = None, at: str | None = None) -> StreamingQuery:
    """Flatten + expect-or-drop with the per-batch expectation counts
    appended to an event log (one event per micro-batch).

    The counts are observed metrics of the batch's own write: nothing is kept in memory
    and the batch is read once.  Each batch writes under ``.../batch_id=<id>`` with
    overwrite, rows before event, and is committed after both, so a batch replayed after a
    failure replaces its own output (exactly once).
    """
    rows = explode_readings(read_bronze_stream(spark, bronze_path, max_files))

    def write(batch: DataFrame, batch_id: int) -> None:
        kept, observed = expect_observed(batch, expectations)
        kept.write.mode("overwrite").parquet(f"{silver_path}/batch_id={batch_id}")
        write_event(spark, log_path, batch_id, observed_counts(observed, expectations), dataset, at)

    q = (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True).start())
    return _run(q)


def evolving_stream(spark: SparkSession, bronze_path: str, table_path: str, log_path: str, checkpoint: str,
                    max_files: int | None = None, max_fields: int = MAX_FIELDS) -> StreamingQuery:
    """Readings typed by an inferred, evolving schema; what it does not cover is rescued.

    Each micro-batch first adds the fields it brings to the schema log at ``log_path``, then
    is read with that schema (see ``operators.schema_evolution``).  Rows and version lie under
    ``.../batch_id=<id>`` and are overwritten by a replay.  Read with :func:`read_evolving`.
    """
    rows = reading_texts(read_bronze_stream(spark, bronze_path, max_files), extra=["file_modification_time"])

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark) as keep:
            texts = keep(batch, "reading-texts")
            fields = evolve(spark, log_path, fields_of(texts, max_fields=max_fields), batch_id, max_fields)
            typed = read_with_schema(texts, fields, keep=list(EVOLVING_COLUMNS))
            typed.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")

    q = (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True).start())
    return _run(q)


#: Columns beside ``reading`` and ``_rescued_data`` in the table of :func:`evolving_stream`.
EVOLVING_COLUMNS = {"metric_name": "string", "units": "string", "source_file": "string", "ingested_at": "timestamp",
                    "file_modification_time": "timestamp"}


def read_evolving(spark: SparkSession, table_path: str, log_path: str) -> DataFrame:
    return read_evolved(spark, table_path, log_path, ", ".join(f"{c} {t}" for c, t in EVOLVING_COLUMNS.items()))


def dedup_stream(spark: SparkSession, bronze_path: str, table_path: str, checkpoint: str, within: str = "7 days",
                 content: str = "data", max_files: int | None = None) -> StreamingQuery:
    """Append Bronze rows whose content (SHA-256) did not arrive ``within`` the time before.

    The state holds one hash per document of that time and no more: hashes leave it as the
    watermark passes.  Its clock is the arrival of the micro-batch, so no file counts as
    late and none is dropped for its own times, and a restart goes on with the state of the
    checkpoint.  A resend that comes after the time is taken as new.  Of copies in one
    micro-batch any one stays.
    """
    rows = (read_bronze_stream(spark, bronze_path, max_files)
            .withColumn("content_sha256", F.sha2(F.col(content), 256))
            .withColumn("_arrived_at", F.current_timestamp()))
    kept = rows.withWatermark("_arrived_at", within).dropDuplicatesWithinWatermark(["content_sha256"]).drop("_arrived_at")
    q = (kept.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(table_path))
    return _run(q)


def silver_keep(rows: DataFrame, expectations: dict[str, str] = SILVER_EXPECTATIONS) -> DataFrame:
    """Rows passing every expectation (the same filter as batch Silver)."""
    return expectation_filter(rows, expectations)


def _with_part(rows: DataFrame, part: Column) -> DataFrame:
    return rows.withColumn("_part", F.coalesce(part.cast("string"), F.lit("none")))


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`_merge_parts`, without its partition column.

    Partitions written before a column came hold nulls in it."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop("_part")


def _merge_parts(path: str, new: DataFrame, fold: Callable[[DataFrame], DataFrame],
                 keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Fold rows into a table partitioned by ``_part``, rewriting only their partitions.

    Columns are met by name: one that only the table or only the new rows have is null in
    the others.  The folded rows are stored before the write, since they are read from
    the partitions they replace; they are returned.  Anything but a table that is not there
    yet raises, so no failure passes for a first batch.
    """
    spark = new.sparkSession
    old, both = read_if_there(spark, path, mergeSchema="true"), new
    if old is not None:
        touched = old.withColumn("_part", F.col("_part").cast("string")).join(new.select("_part").distinct(), "_part", "left_semi")
        both = touched.unionByName(new, allowMissingColumns=True)
    merged = keep(fold(both), "folded-parts")
    write_parts(path, merged)
    return merged


def write_parts(path: str, rows: DataFrame) -> None:
    (rows.hint("rebalance", "_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_part").parquet(path))


def scd1_stream(spark: SparkSession, bronze_path: str, table_path: str, checkpoint: str,
                keys: Sequence[str], sequence: Sequence[Column], part: Column,
                max_files: int | None = None) -> StreamingQuery:
    """Maintain one current row per key at ``table_path``, partitioned by ``part``."""
    checkpoint_base(spark)
    rows = silver_stream(read_bronze_stream(spark, bronze_path, max_files))
    order = list(sequence) + _tie_break(rows)
    winners = latest_by(rows, keys, order)

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark) as keep:
            new = keep(_with_part(batch, part), "new-rows")
            if not new.isEmpty():
                _merge_parts(table_path, new, lambda both: latest_by(both, list(keys), order), keep)

    q = (winners.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True).start())
    return _run(q)


def scd2_stream(spark: SparkSession, bronze_path: str, events_path: str, history_path: str, checkpoint: str,
                keys: Sequence[str], sequence: str, track: Sequence[str], part: Column,
                where: str | None = None, max_files: int | None = None) -> StreamingQuery:
    """Maintain the version history at ``history_path``; ``part`` is derived from the keys."""
    checkpoint_base(spark)
    rows = silver_stream(read_bronze_stream(spark, bronze_path, max_files))
    if where:
        rows = rows.filter(where)

    def write(batch: DataFrame, batch_id: int) -> None:
        fold = lambda both: latest_by(both, [*keys, sequence], _tie_break(both))
        with scratch(spark) as keep:
            new = keep(fold(_with_part(batch, part)), "new-rows")
            if not new.isEmpty():
                events = _merge_parts(events_path, new, fold, keep)
                write_parts(history_path, _with_part(scd2(events.drop("_part"), keys, sequence, track), part))

    q = (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True).start())
    return _run(q)

"""Export-file sources and Bronze sinks.

* ``read_exports`` / ``stream_exports``: one row per JSON file (whole text),
  with file provenance from ``_metadata`` -- the same columns in batch and
  streaming.
* ``unwrap``: store the inner ``data`` object, accepting files one level deep.
* ``only_new``: files not landed yet, as an anti-join (no driver-side set).
* ``land``: append to a landing table partitioned by ingestion date.
* ``ingest_folder``: list, keep new files, unwrap, land.
* ``drop_exact_resends``: SHA-256 of the raw content, earliest copy kept.
* ``ingest_counts``: row and distinct-file counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..config import DOCUMENT_JSON
from ..session import read_if_there

# The Bronze columns.
BRONZE_SCHEMA = StructType([
    StructField("data", StringType(), True),
    StructField("_rescued_data", StringType(), True),
    StructField("_ingested_at", TimestampType(), True),
    StructField("_source_file", StringType(), True),
])


def _ingest_time(ingested_at: dt.datetime | str | Column | None) -> Column:
    if ingested_at is None:
        return F.current_timestamp()
    if isinstance(ingested_at, Column):
        return ingested_at
    return F.lit(str(ingested_at)).cast("timestamp")


def _provenance(df: DataFrame, ingested_at) -> DataFrame:
    name = (F.col("_source_file") if "_source_file" in df.columns
            else F.col("_metadata.file_name"))
    return df.select(
        F.col("value").alias("data"),
        F.lit(None).cast("string").alias("_rescued_data"),
        _ingest_time(ingested_at).alias("_ingested_at"),
        name.alias("_source_file"),
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"))


def read_exports(spark: SparkSession, path: str, glob: str | None = "*.json",
                 ingested_at=None, recursive: bool = True) -> DataFrame:
    """Batch read of export files, one row per file (whole document).

    ``wholetext`` is passed as an argument (as an option it would be reset and
    split by line).  ``ingested_at`` pins the load time for reproducible runs;
    by default it is the query's ``current_timestamp()``.
    """
    opts = {}
    if glob:
        opts["pathGlobFilter"] = glob
    if recursive and "_source_file=" not in path:
        opts["recursiveFileLookup"] = "true"
    df = spark.read.options(**opts).text(path, wholetext=True)
    return _provenance(df, ingested_at)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written by :func:`land`."""
    return spark.read.parquet(path)


def stream_exports(spark: SparkSession, path: str, max_files: int | None = None,
                   glob: str | None = "*.json") -> DataFrame:
    """Incremental file source: each new file read once across restarts
    (progress lives in the sink's checkpoint).  ``_ingested_at`` is the
    micro-batch time."""
    r = spark.readStream
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return _provenance(r.text(path, wholetext=True), None)


def unwrap(df: DataFrame, data: str = "data") -> DataFrame:
    """Keep only the inner ``data`` object when a file arrived one level too
    deep (``{"data": {"metrics": ...}}``); leave ``{"metrics": ...}`` as is.

    One parse per document: both candidate fields come back as raw JSON text.
    """
    p = F.from_json(F.col(data), "struct<metrics: string, data: string>", DOCUMENT_JSON)
    deep = p["metrics"].isNull() & p["data"].isNotNull()
    return df.withColumn("_was_wrapped", F.coalesce(deep, F.lit(False))).withColumn(
        data, F.when(deep, p["data"]).otherwise(F.col(data)))


def only_new(listing: DataFrame, landed: DataFrame,
             keys: Sequence[str] = ("_source_file",)) -> DataFrame:
    """Listed files whose key is not in the landed table (left anti-join).

    The landed side is reduced to distinct keys first; AQE broadcasts it
    when it is small and shuffles otherwise, nothing goes through the driver.
    """
    seen = landed.select(*keys).distinct()
    return listing.join(seen, list(keys), "left_anti")


def landing_path(ts: Column | str, name: Column | str) -> Column:
    """``raw/exports/yyyy/MM/dd/yyyyMMdd_HHmmss_<name>`` for a load time."""
    t = F.col(ts) if isinstance(ts, str) else ts
    n = F.col(name) if isinstance(name, str) else name
    return F.concat(F.date_format(t, "'raw/exports/'yyyy/MM/dd/yyyyMMdd_HHmmss'_'"), n)


def request_id(*cols: str) -> Column:
    """A repeatable id of one delivery, from what identifies it."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256), 1, 32)


def land(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append raw documents, byte for byte, to the landing table at ``path``.

    One folder per ingestion day; the file's name, load time, request id, size
    and SHA-256 are columns beside the body, so the number of folders and files
    follows days and bytes, not documents.  The source file's modification time, by
    which change data are sequenced, stays with it (null where it is not known).
    ``rebalance`` lets adaptive execution split a large day over several tasks.
    An empty ``df`` writes no rows.
    """
    body = F.col("data").cast("binary")

    def given(name: str, kind: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)

    out = df.select(
        "data", given("_rescued_data", "string"), "_ingested_at", "_source_file", given("file_modification_time", "timestamp"),
        request_id("_source_file", "_ingested_at").alias("request_id"),
        F.octet_length(body).cast("long").alias("content_bytes"), F.sha2(body, 256).alias("content_sha256"),
        F.to_date("_ingested_at").alias("ingest_date"))
    out.hint("rebalance", "ingest_date").write.mode(mode).partitionBy("ingest_date").parquet(path)


#: Keys by which a file counts as landed: its name, or its name and modification time,
#: which takes a file revised under its old name as new.
BY_NAME = ("_source_file",)
BY_REVISION = ("_source_file", "file_modification_time")


def ingest_folder(spark: SparkSession, folder: str, table: str, ingested_at=None, glob: str | None = "*.json",
                  keys: Sequence[str] = BY_NAME) -> int:
    """List a folder's export files, land those not landed yet, unwrapped; returns how many.

    Nothing is written when nothing is new.  The file's path under the folder is
    its name, so equal names in different sub-folders stay apart.  ``keys`` says what
    makes a file a new one.
    """
    listing = read_exports(spark, folder, glob, ingested_at)
    listing = listing.withColumn("_source_file", F.col("source_path"))
    landed = read_if_there(spark, table)
    new = only_new(listing, landed, keys) if landed is not None else listing
    count = new.select("_source_file").count()  # names alone: bodies are not read
    if count:
        land(unwrap(new).drop("_was_wrapped"), table)
    return count


def drop_exact_resends(df: DataFrame, content: str = "data", order: str = "_ingested_at",
                       name: str = "_source_file") -> DataFrame:
    """Keep the earliest copy of each distinct raw content (SHA-256).

    Only (hash, time, name) are shuffled, folded map-side, so a hash shared by a
    third of all rows costs one row per task.  Columns beside those three are
    joined back by (hash, time, name) and only where they are asked for.
    """
    hashed = df.withColumn("content_sha256", F.sha2(F.col(content), 256))
    first = (hashed.groupBy("content_sha256")
             .agg(F.min(F.struct(F.col(order), F.col(name))).alias("_f"), F.count(F.lit(1)).alias("copies"))
             .select("content_sha256", "copies", F.col("_f")[order].alias(order), F.col("_f")[name].alias(name)))
    return first


def with_bodies(first: DataFrame, df: DataFrame, content: str = "data", order: str = "_ingested_at",
                name: str = "_source_file") -> DataFrame:
    """The other columns of ``df`` for the rows :func:`drop_exact_resends` kept, one row each."""
    rest = [c for c in df.columns if c not in (order, name)]
    rows = df.select(F.sha2(F.col(content), 256).alias("_h"), F.col(order).alias("_o"), F.col(name).alias("_n"), *rest)
    joined = first.join(rows, (F.col("content_sha256") == F.col("_h")) & F.col(order).eqNullSafe(F.col("_o"))
                        & F.col(name).eqNullSafe(F.col("_n")))
    return joined.drop("_h", "_o", "_n").dropDuplicates(["content_sha256"])


def ingest_counts(df: DataFrame, name: str = "_source_file") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_distinct(name).alias("file_count"))

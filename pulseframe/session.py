"""Session defaults and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: instants shown in UTC, ANSI semantics, AQE.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Suggested settings for a large cluster (~1000 executors, ~100 TB input):
# AQE sizes shuffle partitions from a high initial count down to ~256 MB
# each and splits skewed join partitions; scans read 256 MB splits; the
# broadcast threshold stays a checked, runtime size.
CLUSTER_SETTINGS = {
    **SESSION_DEFAULTS,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "pulseframe", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches (UI off, no servers)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g"))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the settings the marts depend on (idempotent)."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and landed files.

    Reads ``spark.checkpoint.dir`` from the session.  Only where it is unset
    (local tests) is one created under the system temp folder and set on the
    context, so a cluster always uses its own shared storage.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(a driver-local temp folder is not visible to executors)")
        base = tempfile.mkdtemp(prefix="pulseframe-ckpt-")
        sc.setCheckpointDir(base)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder under :func:`checkpoint_base`."""
    return os.path.join(checkpoint_base(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under :func:`checkpoint_base` and read it back: cuts the
    lineage as a reliable checkpoint does, and keeps columns and statistics, so that later
    reads take only the columns and row groups they need."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """:func:`stored` for tables that nothing needs once the block is left; they are removed then.

    For rows that are read from what they replace: stored, written to the target, removed.
    """
    made: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        made.append(shared_dir(spark, name))
        df.write.parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    try:
        yield keep
    finally:
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever the cluster's files live."""
    files, place = _files(spark, path)
    files.delete(place, True)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def read_if_there(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """The Parquet table at ``path``; None where there is no such path yet.

    Nothing else counts as "not yet": a table that is there and cannot be read raises.
    """
    files, place = _files(spark, path)
    return spark.read.options(**options).parquet(path) if files.exists(place) else None

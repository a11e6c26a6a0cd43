"""Helpers shared by the training-data operators.

Arrow batches are handled as plain Python lists inside tasks; Spark partitions
and shuffles the work.  Word classes follow two fixed patterns:

* ``ALNUM``: words are runs of anything but ASCII separators and symbols, after
  lower-casing A-Z only;
* ``BLANK``: words are runs of anything but ASCII white space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.session import shared_dir

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: UTF-8 bytes to their lower-cased word bytes; every separator becomes a space.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts the lineage, so later
    stages survive lost executors without recomputing what came before."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drawn(docs: DataFrame, rows: int, seed: int, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t, copies, columns of ``known``): a bounded draw of at most ``rows`` *rows* of ``docs``.

    Those of the smallest hashes of id and text among rows with an id in ``known`` (one row
    per id; None: all rows).  Rows of one id and text come once, with the number drawn, so
    an id that holds most rows takes part with no more rows than any draw has.
    """
    text = text_bytes(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.lit(seed), F.col(id_col), text).alias("key"))
    if known is not None:
        keyed = keyed.join(known, "doc_id")
    wanted = keyed.sort("key", "doc_id").limit(rows).groupBy(*keyed.columns).agg(F.count("*").alias("copies"))
    # at most ``rows`` rows: a proven bound
    wanted = F.broadcast(wanted.withColumnsRenamed({"doc_id": "d_id", "key": "d_key"}))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.lit(seed), F.col(id_col), text).alias("key"), text.alias("t"))
    found = texts.join(wanted, (F.col("doc_id") == F.col("d_id")) & (F.col("key") == F.col("d_key"))).drop("d_id", "d_key")
    rest = [c for c in found.columns if c != "t"]
    return found.groupBy(*rest).agg(F.first("t").alias("t")).drop("key")


def text_bytes(col: str = "text"):
    """The column's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def normalised(text: Column) -> Column:
    """' w1 w2 ... ' with single spaces, or ' ' where there are no words."""
    words = F.regexp_replace(F.translate(text, UPPER, LOWER), SEPARATORS, " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a text expression's UTF-8 bytes (for oracles)."""
    entries = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        entries.append(c)
    codes = f"list_transform(range(0, octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    step = f"lambda a, b: xor(a >> 8, (CAST({entries} AS BIGINT[]))[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {step}), CAST(4294967295 AS BIGINT))"


def per_row(schema: pa.Schema, rows: Callable[..., Iterable], max_rows: int = 256,
            ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function from ``rows(*columns of one batch) -> list of tuples``.

    Batches are cut to ``max_rows`` so that very long texts do not add up in a worker.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, max_rows):
                batch = big.slice(at, max_rows)
                out = list(rows(*(c.to_pylist() for c in batch.columns)))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, f.type) for v, f in zip(zip(*out), schema)], schema=schema)
    return run

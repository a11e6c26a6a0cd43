"""Bronze -> Silver flatten: one row per (file, metric, reading).

Large exports (tens of MB in one file) are never parsed as one VARIANT:
``from_json`` splits the document into metrics and each metric's readings
as raw JSON *text* (one streaming parse), and only each small reading is
parsed into a VARIANT, because readings are heterogeneous (qty, Avg/Min/Max
in either case, sleep fields, ...).  The same function serves batch and
streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DOCUMENT_JSON, READING_TS_PATTERN

_METRIC = "array<struct<name: string, units: string, data: array<string>>>"
# Accept both the unwrapped shape {"metrics": [...]} and one level deeper
# {"data": {"metrics": [...]}} (files landed before the unwrap step).
DOC_SCHEMA = f"struct<metrics: {_METRIC}, data: struct<metrics: {_METRIC}>>"


def _text(v: Column, path: str) -> Column:
    """Path access with a cast to string (``v:path::string``)."""
    return F.try_variant_get(v, path, "string")


def _num(v: Column, *paths: str) -> Column:
    """Numbers go through text: JSON ``true`` becomes NULL, ``"1.5"`` 1.5."""
    txt = F.coalesce(*[_text(v, p) for p in paths])
    return txt.try_cast("double")


def explode_readings(bronze: DataFrame, data_col: str = "data",
                     file_col: str = "_source_file",
                     ingested_col: str = "_ingested_at",
                     keep: tuple[str, ...] = ("file_modification_time",),
                     spread: int | None = None, subject: str | None = None) -> DataFrame:
    """Explode Bronze documents into Silver-base rows (before dedup).

    Output: ``metric_name, units, date, value_qty, value_avg, value_min,
    value_max, value_raw, source_file, ingested_at`` plus any ``keep``
    column present in the input.

    One export file is one Bronze row, so all its readings start in one
    task.  With ``spread`` (a partition count) the reading texts are
    redistributed round-robin before they are parsed, so a few very large
    exports do not leave the parse to a few tasks (costs one shuffle of the
    reading text; leave unset for many small files).

    ``subject``: path of the person a reading belongs to, where exports of several are
    landed together; it becomes a column ``subject``.
    """
    extra = [c for c in keep if c in bronze.columns]
    return flatten_reading_text(reading_texts(bronze, data_col, file_col, ingested_col, extra, spread), extra, subject)


def reading_texts(bronze: DataFrame, data_col: str = "data", file_col: str = "_source_file", ingested_col: str = "_ingested_at",
                  extra: list[str] | tuple = (), spread: int | None = None) -> DataFrame:
    """One raw reading text per row (``value_raw``) with its metric and file."""
    # Parse once into a column; referencing the parse twice inside one
    # expression would parse every document twice.
    parsed = bronze.select(
        F.col(file_col).alias("source_file"), F.col(ingested_col).alias("ingested_at"),
        *extra, F.from_json(F.col(data_col), DOC_SCHEMA, DOCUMENT_JSON).alias("_doc"))
    metrics = parsed.select(
        "source_file", "ingested_at", *extra,
        F.explode(F.coalesce(F.col("_doc.metrics"), F.col("_doc.data.metrics"))).alias("m"))
    readings = metrics.select(
        "source_file", "ingested_at", *extra,
        F.col("m.name").alias("metric_name"), F.col("m.units").alias("units"),
        F.explode(F.col("m.data")).alias("value_raw"))
    return readings.repartition(int(spread)) if spread else readings


def unparsed_documents(bronze: DataFrame, data_col: str = "data",
                       file_col: str = "_source_file") -> DataFrame:
    """Files whose document holds no metrics array that the flatten can read: their rows
    would vanish in the explode, so they are counted here (``_source_file, reason``)."""
    doc = bronze.select(F.col(file_col).alias("_source_file"), F.col(data_col).alias("_d"),
                        F.from_json(F.col(data_col), DOC_SCHEMA, DOCUMENT_JSON).alias("_doc"))
    reason = (F.when(F.col("_d").isNull(), F.lit("no_document"))
              .when(F.coalesce(F.col("_doc.metrics"), F.col("_doc.data.metrics")).isNull(), F.lit("no_metrics_read")))
    return doc.select("_source_file", reason.alias("reason")).filter("reason IS NOT NULL")


def flatten_reading_text(readings: DataFrame, extra: list[str] | tuple = (), subject: str | None = None) -> DataFrame:
    """Type one reading text per row into the Silver-base columns."""
    # Parse each reading once into its own column, then read paths from it
    # (inline, the parse would be repeated for every path).
    v = F.col("_v")
    return readings.withColumn("_v", F.try_parse_json(F.col("value_raw"))).select(
        "metric_name",
        "units",
        F.try_to_timestamp(_text(v, "$.date"), F.lit(READING_TS_PATTERN)).alias("date"),
        _num(v, "$.qty").alias("value_qty"),
        _num(v, "$.Avg", "$.avg").alias("value_avg"),
        _num(v, "$.Min", "$.min").alias("value_min"),
        _num(v, "$.Max", "$.max").alias("value_max"),
        "value_raw",
        "source_file",
        "ingested_at",
        *extra,
        *([_text(v, subject).alias("subject")] if subject else []),
    )


def lateral_fields(rows: DataFrame, value: Column, outer: bool = False) -> DataFrame:
    """``rows`` joined laterally with the elements of a variant value each: ``pos, key, value``.

    An array gives its elements (null keys), an object its fields; a null or missing value
    and a scalar give nothing, or with ``outer`` one row of nulls.
    """
    tvf = rows.sparkSession.tvf
    elements = tvf.variant_explode_outer(value.outer()) if outer else tvf.variant_explode(value.outer())
    return rows.lateralJoin(elements)


def lateral_readings(bronze: DataFrame, data_col: str = "data", file_col: str = "_source_file") -> DataFrame:
    """(source_file, metric_name, reading): the flatten by two lateral joins over VARIANT.

    For documents that fit one VARIANT (16 MiB); ``explode_readings`` splits documents
    of any size.  Those that do not parse give no rows here and show in
    :func:`unparsed_documents`."""
    docs = bronze.select(F.col(file_col).alias("source_file"), F.try_parse_json(data_col).alias("doc"))
    metrics = F.coalesce(F.try_variant_get("doc", "$.metrics", "variant"), F.try_variant_get("doc", "$.data.metrics", "variant"))
    per_metric = lateral_fields(docs.select("source_file", metrics.alias("metrics")), F.col("metrics")).select("source_file", F.col("value").alias("metric"))
    named = per_metric.select("source_file", F.try_variant_get("metric", "$.name", "string").alias("metric_name"),
                              F.try_variant_get("metric", "$.data", "variant").alias("data"))
    return lateral_fields(named, F.col("data")).select("source_file", "metric_name", F.col("value").alias("reading"))


def reading_shapes(rows: DataFrame) -> DataFrame:
    """Schema drift report: readings per (metric, sorted key set)."""
    keys = F.array_join(F.array_sort(F.json_object_keys("value_raw")), ",")
    return (rows.groupBy("metric_name", keys.alias("shape"))
            .agg(F.count(F.lit(1)).alias("n_readings")))


def reading_schema_profile(rows: DataFrame) -> DataFrame:
    """Merged VARIANT schema of all readings per metric (``schema_of_variant_agg``)."""
    return (rows.groupBy("metric_name")
            .agg(F.schema_of_variant_agg(F.try_parse_json("value_raw")).alias("reading_schema"),
                 F.count(F.lit(1)).alias("n_readings")))

"""Schema inference and evolution for JSON readings, with rescued data.

The fields of readings are found from the data, batch by batch, and kept in a *schema
log*: a batch that brings new fields adds a version.  A field keeps the type it was first
stored with.  Every reading is then read with the stored schema into typed columns; what
the schema does not cover goes to ``_rescued_data`` as one JSON object: fields that are
not in the schema, fields spelled in another case than the schema's, and values of
another JSON type than their field's.  Typed columns and rescued data together are the
whole reading; nothing is lost, whatever comes.

Numbers are stored as double, strings and booleans as such, objects and arrays as JSON
text.  Within a batch a field has the commonest type of its least spelling (ties: by
name).  At most ``max_fields`` fields, the commonest first, become columns; the others
stay rescued.  A reading that is no JSON object is rescued as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_if_there

# JSON type -> type of its column.
COLUMN_TYPES = {"number": "double", "string": "string", "boolean": "boolean", "object": "string", "array": "string"}
MAX_FIELDS = 1000
RESCUED = "_rescued_data"
Field = tuple[str, str]
LOG_SCHEMA = "batch_id long, position int, field string, kind string"


def kind_of(value: Column) -> Column:
    """JSON type of a variant: number, string, boolean, object, array or null."""
    shape = F.upper(F.schema_of_variant(value))
    return (F.when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array")
            .when(shape == "STRING", "string").when(shape == "BOOLEAN", "boolean").when(shape == "VOID", "null").otherwise("number"))


def _with_fields(rows: DataFrame, raw: str) -> DataFrame:
    """``rows`` with ``_fields``, the reading's map of field -> variant (null where it is no object)."""
    parsed = rows.withColumn("_v", F.try_parse_json(raw))
    return parsed.withColumn("_fields", F.expr("try_variant_get(_v, '$', 'map<string,variant>')")).drop("_v")


def fields_of(rows: DataFrame, raw: str = "value_raw", max_fields: int = MAX_FIELDS) -> list[Field]:
    """The (field, JSON type) pairs of a batch of readings, the commonest first."""
    entries = (_with_fields(rows, raw).select(F.explode(F.map_entries("_fields")).alias("e"))
               .select(F.col("e.key").alias("field"), kind_of(F.col("e.value")).alias("kind")).filter("kind <> 'null'"))
    counted = entries.groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n"))
    chosen = counted.groupBy(F.lower("field").alias("name")).agg(
        F.sum("n").alias("n"), F.min(F.struct("field", (-F.col("n")).alias("rare"), "kind")).alias("first"))
    # bounded by ``max_fields``
    got = chosen.sort(F.desc("n"), "name").limit(max_fields).select("first.field", "first.kind").collect()
    return [(r["field"], r["kind"]) for r in got]


def stored_fields(spark: SparkSession, log: str, before: int | None = None) -> list[Field]:
    """The stored schema: all fields logged, in the order they came; ``before`` leaves out
    that batch and later ones."""
    rows = read_if_there(spark, log)
    if rows is None:
        return []
    rows = rows.select("batch_id", "position", "field", "kind")
    got = (rows if before is None else rows.filter(F.col("batch_id") < before)).collect()  # one row per field
    return [(r["field"], r["kind"]) for r in sorted(got, key=lambda r: (r["batch_id"], r["position"]))]


def evolve(spark: SparkSession, log: str, seen: Sequence[Field], batch_id: int, max_fields: int = MAX_FIELDS) -> list[Field]:
    """Merge a batch's fields into the stored schema; returns the schema to read the batch with.

    Only fields that no stored one equals (in any case) are added, as one new version in a
    folder of its batch's, so a batch replayed after a failure adds nothing twice.
    """
    old = stored_fields(spark, log, batch_id)
    known = {f.lower() for f, _ in old}
    new = [(f, k) for f, k in seen if f.lower() not in known][:max(0, max_fields - len(old))]
    new = sorted(new, key=lambda x: x[0].lower())
    if new:
        rows = spark.createDataFrame([(k, f, kind) for k, (f, kind) in enumerate(new)], "position int, field string, kind string")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")
    return old + new


def schema_versions(spark: SparkSession, log: str) -> DataFrame:
    """(version, field, kind): the version, from 1, that brought each field."""
    rows = spark.read.schema(LOG_SCHEMA).parquet(log)
    # one row per field: the versions are numbered on the driver's small list
    ids = sorted(r["batch_id"] for r in rows.select("batch_id").distinct().collect())
    number = F.create_map(*[x for k, i in enumerate(ids) for x in (F.lit(i), F.lit(k + 1))])
    return rows.select(F.element_at(number, F.col("batch_id")).alias("version"), "field", "kind")


def read_with_schema(rows: DataFrame, fields: Sequence[Field], raw: str = "value_raw", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``reading`` (a struct of the schema's typed fields) and ``_rescued_data``."""
    held = _with_fields(rows, raw)
    if not fields:
        return held.select(*keep, F.col(raw).alias(RESCUED))
    kinds = F.create_map(*[F.lit(x) for pair in fields for x in pair])

    def covered(name: Column, value: Column) -> Column:
        kind = F.try_element_at(kinds, name)
        return F.coalesce((kind == kind_of(value)) | (kind.isNotNull() & (kind_of(value) == "null")), F.lit(False))

    def typed(field: str, kind: str) -> Column:
        value = F.try_element_at("_fields", F.lit(field))
        read = F.to_json(value) if kind in ("object", "array") else F.try_variant_get(value, "$", COLUMN_TYPES[kind])
        return F.when(kind_of(value) == kind, read).alias(field)

    rest = F.map_filter("_fields", lambda k, v: ~covered(k, v))
    split = held.select(*keep, F.col(raw).alias("_raw"), "_fields", F.struct(*[typed(f, k) for f, k in fields]).alias("reading"), rest.alias("_rest"))
    rescued = F.when(F.col("_fields").isNull(), F.col("_raw")).when(F.size("_rest") > 0, F.to_json("_rest"))
    return split.select(*keep, "reading", rescued.alias(RESCUED))


def read_evolved(spark: SparkSession, table: str, log: str, keep: str) -> DataFrame:
    """A table of batches read with their then schemas, under the newest one: columns that
    came later are null in earlier batches.  ``keep``: the kept columns' DDL.

    The schema comes from the log, so no file footer is read for it."""
    columns = ", ".join(f"`{f.replace('`', '``')}`: {COLUMN_TYPES[k]}" for f, k in stored_fields(spark, log))
    nested = f", reading struct<{columns}>" if columns else ""
    return spark.read.schema(f"{keep}{nested}, {RESCUED} string, batch_id long").parquet(table)

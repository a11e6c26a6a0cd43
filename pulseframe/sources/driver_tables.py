"""Health-export shaped inputs derived from the driver's tables.

The driver data has no wearable exports, so readings are read out of the
``events`` table (and a long calendar out of ``orders``).  Every derived
table is a Spark plan over the whole input table; nothing is generated on
the driver.

Mapping (all of it is mirrored by the DuckDB oracle SQL):

* event_type -> metric: click=step_count, view=heart_rate,
  purchase=active_energy, signup=weight_body_mass, error=body_fat_percentage.
* local reading time text = the event's hour, with offset ``+0200``.
  Every 101st event (id % 101 = 7) carries the unparseable text ``bad``;
  every 103rd (id % 103 = 11), and every 6th of local midnight (id % 6 = 1),
  is stamped with the ``Z`` offset instead, so days with two rollups occur.
* every 997th event (id % 997 = 13) is a reading of ``mood_score``, a name that
  is not on the accepted list.
* ``view`` readings fill Avg/Min/Max (upper-case keys for even ids,
  lower-case for odd ids); the others fill ``qty``.  ``qty`` is written as a
  JSON string when id % 53 = 5 and as ``true`` when id % 59 = 3.
* export file = ``event_id div FILE_EVENTS``: the number of files grows with
  the data and each file stays bounded.  File ``f`` is ingested at
  2024-02-01 + f hours (modified ten minutes earlier).
* every RESEND_EVERY-th file is exported again, later (+30 min), with each
  value raised by 1: a fully superseding, overlapping re-export.  Every second
  re-export (f % 20 = 10) holds its metrics with empty ``data`` arrays.
* every WRAP_EVERY-th file (f % 7 = 3) is landed one level too deep
  (``{"data": {...}}``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_EVENTS = 250
RESEND_EVERY = 10
WRAP_EVERY = 7
WRAP_AT = 3
INGEST_BASE_EPOCH = 1706745600  # 2024-02-01 00:00:00 UTC
RESEND_DELAY_SECONDS = 1800
MODIFIED_BEFORE_INGEST_SECONDS = 600
LOCAL_OFFSET_TEXT = " +0200"

# --- fixed values of the mapping --------------------------------------------
EVENT_METRICS = {
    "click": "step_count",
    "view": "heart_rate",
    "purchase": "active_energy",
    "signup": "weight_body_mass",
    "error": "body_fat_percentage",
}
METRIC_UNITS = {
    "step_count": "Count",
    "heart_rate": "count/min",
    "active_energy": "kcal",
    "weight_body_mass": "KG",
    "body_fat_percentage": "%",
    "mood_score": "pts",
}
UNKNOWN_METRIC = "mood_score"
# --- end of fixed values ----------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map_col(mapping: dict, col: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def _num_text(c: Column) -> Column:
    return c.cast("string")


def event_readings(events: DataFrame) -> DataFrame:
    """One reading per event: file number, metric, units and the reading JSON."""
    eid = F.col("event_id")
    unknown = eid % 997 == 13
    metric = F.when(unknown, F.lit(UNKNOWN_METRIC)).otherwise(_map_col(EVENT_METRICS, F.col("event_type")))
    midnight = F.hour("ts") == 0
    hour_text = F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd HH:mm:ss")
    date_text = (F.when(eid % 101 == 7, F.lit("bad"))
                 .when((eid % 103 == 11) | (midnight & (eid % 6 == 1)), F.concat(hour_text, F.lit(" Z")))
                 .otherwise(F.concat(hour_text, F.lit(LOCAL_OFFSET_TEXT))))
    return events.select(
        eid.alias("event_id"),
        (eid / FILE_EVENTS).cast("long").alias("file_no"),
        metric.alias("metric_name"),
        _map_col(METRIC_UNITS, metric).alias("units"),
        "user_id",
        (F.col("user_id") % 4).alias("device"),
        date_text.alias("date_text"),
        F.col("value"),
        ((F.col("event_type") == "view") & ~unknown).alias("is_range"),
    )


def _reading_json(bump: Column, source: Column | None = None, more: Column | None = None) -> Column:
    """JSON text of one reading, values raised by ``bump``; ``source``: JSON of its source
    (default: the watch's name), ``more``: JSON of further fields, each with a comma before."""
    eid = F.col("event_id")
    v = F.col("value") + bump
    upper = eid % 2 == 0
    rng = F.concat(
        F.when(upper, F.lit('"Avg":')).otherwise(F.lit('"avg":')), _num_text(v),
        F.when(upper, F.lit(',"Min":')).otherwise(F.lit(',"min":')), _num_text(v - 1),
        F.when(upper, F.lit(',"Max":')).otherwise(F.lit(',"max":')), _num_text(v + 1))
    qty = (F.when(eid % 53 == 5, F.concat(F.lit('"qty":"'), _num_text(v), F.lit('"')))
           .when(eid % 59 == 3, F.lit('"qty":true'))
           .otherwise(F.concat(F.lit('"qty":'), _num_text(v))))
    watch = F.concat(F.lit('"watch-'), F.col("device").cast("string"), F.lit('"'))
    return F.concat(
        F.lit('{"source":'), watch if source is None else source,
        F.lit(',"date":"'), F.col("date_text"), F.lit('",'),
        F.when(F.col("is_range"), rng).otherwise(qty), F.lit("") if more is None else more, F.lit("}"))


def subject_json() -> dict[str, Column]:
    """Readings that say whose they are (``user_id``)."""
    return {"more": F.concat(F.lit(',"subject":'), F.col("user_id").cast("string"))}


def drift_json(cutoff: str) -> dict[str, Column]:
    """Readings of files ingested after ``cutoff`` in a changed shape: every 7th event
    (id % 7 = 2) has a new field ``context``, every 13th (id % 13 = 4) a number for source."""
    late = F.timestamp_seconds(_ingest_seconds()) > F.lit(cutoff).cast("timestamp")
    eid = F.col("event_id")
    watch = F.concat(F.lit('"watch-'), F.col("device").cast("string"), F.lit('"'))
    return {"source": F.when(late & (eid % 13 == 4), F.col("device").cast("string")).otherwise(watch),
            "more": F.when(late & (eid % 7 == 2), F.lit(',"context":"walk"')).otherwise(F.lit(""))}


def _ingest_seconds() -> Column:
    return (F.lit(INGEST_BASE_EPOCH) + F.col("file_no") * 3600
            + F.when(F.col("resend"), F.lit(RESEND_DELAY_SECONDS)).otherwise(F.lit(0)))


def file_readings(events: DataFrame, shape: dict[str, Column] | None = None) -> DataFrame:
    """Readings with their export file: originals plus the re-exports.

    One scan: an event of a re-exported file yields two rows (``explode``
    of a one- or two-element array) instead of a second scan and a union.
    """
    r = event_readings(events)
    copies = F.when(F.col("file_no") % RESEND_EVERY == 0, F.array(F.lit(False), F.lit(True))) \
        .otherwise(F.array(F.lit(False)))
    both = r.select("*", F.explode(copies).alias("resend"))
    both = both.withColumn("bump", F.when(F.col("resend"), F.lit(1.0)).otherwise(F.lit(0.0)))
    name = F.concat(F.lit("export_"), F.format_string("%05d", F.col("file_no")),  # at least five digits
                    F.when(F.col("resend"), F.lit("_resend")).otherwise(F.lit("")),
                    F.lit(".json"))
    ingest_s = _ingest_seconds()
    return both.select(
        "event_id", "file_no", "metric_name", "units",
        F.when(~(F.col("resend") & (F.col("file_no") % 20 == 10)), _reading_json(F.col("bump"), **(shape or {}))).alias("reading"),
        name.alias("_source_file"),
        F.timestamp_seconds(ingest_s).alias("_ingested_at"),
        F.timestamp_seconds(ingest_s - MODIFIED_BEFORE_INGEST_SECONDS).alias("file_modification_time"),
    )


def export_documents(events: DataFrame, shape: dict[str, Column] | None = None) -> DataFrame:
    """Group readings into one export document per file (Bronze ``data`` text).

    One shuffle: readings are collected per file (a file holds at most
    ``FILE_EVENTS`` readings, so each group is bounded), sorted by
    (metric, event id), and nested per metric with array functions.

    The shuffle carries an explicit partition count: the documents are small in
    bytes, but what follows multiplies every one into its readings, so adaptive
    execution must not squeeze them into a task or two.
    """
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fr = file_readings(events, shape).repartition(n, "_source_file", "file_no", "_ingested_at", "file_modification_time")
    per_file = (fr.groupBy("_source_file", "file_no", "_ingested_at", "file_modification_time")
                .agg(F.array_sort(F.collect_list(
                    F.struct("metric_name", "event_id", "units", "reading"))).alias("rs")))
    metrics = F.array_distinct(F.transform("rs", lambda x: F.struct(x["metric_name"], x["units"])))

    def metric_json(m: Column) -> Column:
        readings = F.filter("rs", lambda x: x["metric_name"] == m["metric_name"])
        return F.concat(
            F.lit('{"name":"'), m["metric_name"], F.lit('","units":"'), m["units"],
            F.lit('","data":['), F.array_join(F.transform(readings, lambda x: x["reading"]), ","),
            F.lit("]}"))

    workouts = F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(3)),
                    lambda i: F.when(i <= F.col("file_no") % 3,
                                     F.concat(F.lit('{"name":"walk","duration":'),
                                              (i * 10).cast("string"), F.lit("}")))),
        ",")
    inner = F.concat(F.lit('{"metrics":['),
                     F.array_join(F.transform(metrics, metric_json), ","),
                     F.lit('],"workouts":['), workouts, F.lit("]}"))
    return per_file.select(
        "_source_file", "file_no", "_ingested_at", "file_modification_time",
        inner.alias("inner"))


def bronze_table(events: DataFrame, shape: dict[str, Column] | None = None) -> DataFrame:
    """The Bronze table: one row per landed file, four columns (+ mod. time).

    ``shape`` changes the readings' JSON (:func:`subject_json`, :func:`drift_json`).

    Files with ``file_no % WRAP_EVERY == WRAP_AT`` were landed one level too
    deep, as the raw export ``{"data": {...}}``.
    """
    docs = export_documents(events, shape)
    wrapped = F.col("file_no") % WRAP_EVERY == WRAP_AT
    data = F.when(wrapped, F.concat(F.lit('{"data":'), F.col("inner"), F.lit("}"))).otherwise(F.col("inner"))
    return docs.select(
        data.alias("data"),
        F.lit(None).cast("string").alias("_rescued_data"),
        "_ingested_at", "_source_file", "file_modification_time")


# Corruption applied to raw request bodies for validation tests, by
# ``file_no % 64``: edits of the real export text; the other files stay valid.
LONG_STRING = 21_000_000


def raw_bodies(events: DataFrame) -> DataFrame:
    """Raw export bodies ``{"data": {...}}``, one per file, with a fixed
    share corrupted (edits of the real document) to exercise every rule.  Every
    640th file holds one string of over 20 million characters."""
    docs = export_documents(events)
    body = F.concat(F.lit('{"data":'), F.col("inner"), F.lit("}"))
    k = F.col("file_no") % 64

    def head(repl: str) -> Column:
        return F.regexp_replace(body, r'^\{"data":\{"metrics":\[', repl)

    def tail(repl: str) -> Column:
        return F.regexp_replace(body, r'"workouts":\[[^\]]*\]', repl)

    cases = [
        (1, F.lit("")),
        (2, F.expr("substring(body, 1, length(body) - 5)")),
        (3, F.concat(F.lit("["), body, F.lit("]"))),
        (4, F.concat(F.lit('{"payload":'), F.col("inner"), F.lit("}"))),
        (5, F.to_json(F.struct(F.col("inner").alias("data")))),
        (6, F.regexp_replace(body, r'"metrics":\[.*\],"workouts"', '"metrics":[],"workouts"')),
        (7, F.regexp_replace(body, r'"metrics":\[.*\],"workouts"', '"metrics":"none","workouts"')),
        (8, head('{"data":{"metrics":["junk",')),
        (9, head('{"data":{"metrics":[{"units":"kg","data":[]},')),
        (10, head('{"data":{"metrics":[{"name":"step_count","data":{}},')),
        (11, head('{"data":{"metrics":[{"name":"a"},"junk",')),
        (12, tail('"workouts":{}')),
        (13, tail('"workouts":null')),
        (14, head('{"data":{"metrics":[{"name":"","data":[]},')),
        (15, F.concat(body, F.lit(" x"))),
        (16, F.concat(body, F.lit("]"))),
        (17, F.concat(body, F.lit("] x"))),
        (18, F.regexp_replace(body, r'^\{', '{"data":{"metrics":"first of two keys"},')),
    ]
    long = F.concat(F.lit('{"data":{"note":"'), F.repeat(F.lit("x"), (F.lit(LONG_STRING) + F.col("file_no") % 2).cast("int")), F.lit('",'), F.expr("substring(inner, 2)"), F.lit("}"))
    out = F.when(F.col("file_no") % 640 == 19, long)
    for n, c in cases:
        out = out.when(k == n, c)
    out = out.otherwise(body)
    return (docs.withColumn("body", body)
            .select("_source_file", "file_no", "_ingested_at", out.alias("body")))


def export_files(events: DataFrame, path: str) -> None:
    """Every export as a ``.json`` file of its own, in a folder named after it, beside a
    ``.txt`` file for each tenth (what arrives in a watched folder)."""
    docs = export_documents(events).select("_source_file", "file_no", F.parse_json("inner").alias("data"))
    docs.select("_source_file", "data").write.partitionBy("_source_file").json(path)
    notes = docs.filter("file_no % 10 = 0").select("_source_file", F.lit("not an export").alias("value"))
    notes.write.mode("append").partitionBy("_source_file").text(path)


# --- fixed values of the long-calendar mapping ----------------------------------
ORDER_STATUS_METRICS = {"F": "step_count", "O": "active_energy", "P": "resting_heart_rate"}
# --- end of fixed values ----------------------------------------------------------


def order_staged(orders: DataFrame) -> DataFrame:
    """Staging-shaped readings over the ``orders`` calendar (1995-2001).

    Each order is one reading of the metric of its status, at local hour
    ``o_orderkey % 24`` of ``o_orderdate`` (hour 0 is the day's rollup), with
    whole-number values as a device reports them: steps
    ``floor(o_totalprice / 10)``, kcal ``floor(o_totalprice / 100)``, resting
    bpm ``40 + o_orderkey % 50``; every order also yields a weight reading
    ``floor(o_totalprice / 1000)`` kg at that hour and, for status 'F', a body
    fat reading ``floor(o_totalprice / 10000)`` %; sums of whole numbers do not
    depend on their order.  345 ISO weeks with year boundaries.
    """
    hour = (F.col("o_orderkey") % 24).cast("int")
    base = orders.select(
        F.to_date("o_orderdate").alias("metric_date"), hour.alias("hour"),
        F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice"))
    m = _map_col(ORDER_STATUS_METRICS, F.col("o_orderstatus"))
    st = F.col("o_orderstatus")
    v = (F.when(st == "F", F.floor(F.col("o_totalprice") / 10))
         .when(st == "O", F.floor(F.col("o_totalprice") / 100))
         .otherwise(40 + F.col("o_orderkey") % 50)).cast("double")
    items = F.array(
        F.struct(m.alias("metric_name"), v.alias("value")),
        F.struct(F.lit("weight_body_mass").alias("metric_name"),
                 F.floor(F.col("o_totalprice") / 1000).cast("double").alias("value")),
        F.struct(F.when(F.col("o_orderstatus") == "F", F.lit("body_fat_percentage")).alias("metric_name"),
                 F.floor(F.col("o_totalprice") / 10000).cast("double").alias("value")))
    rows = base.select("metric_date", "hour", F.explode(items).alias("r"))
    return (rows.filter(F.col("r.metric_name").isNotNull())
            .select(F.col("r.metric_name").alias("metric_name"), "metric_date",
                    F.col("r.value").alias("value"),
                    (F.col("hour") == 0).alias("is_daily_rollup"),
                    F.timestamp_seconds(F.lit(INGEST_BASE_EPOCH)).alias("ingested_at")))

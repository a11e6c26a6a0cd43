"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through ``plans.silver``) over their
whole extent.  Floating columns are rounded to 6 decimals only in this
comparison projection (see ``plans.compare``); the library functions return
unrounded values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ACCEPTED_METRICS, DAILY_RANGES, DOCUMENT_JSON, SILVER_EXPECTATIONS
from ..functions.columns import change_display, iso_year_week
from ..functions.sql_functions import range_violations, register_macros, register_range_check
from ..operators import expectations as X
from ..operators import payload as P
from ..operators import quality as Q
from ..operators.flatten import explode_readings, lateral_fields, lateral_readings, reading_shapes, unparsed_documents
from ..operators.latest import SILVER_KEYS, latest_readings, reading_date_text, stage_readings
from ..operators.scd import scd1, scd2
from ..operators.schema_evolution import kind_of, schema_versions, stored_fields
from ..session import apply_defaults, shared_dir, stored
from ..sources import driver_tables as dtab
from ..sources import exports as S
from ..streaming import streams as ST
from . import build, day_bitmaps, marts, silver, weekly
from .compare import rounded
from .oracle import AS_OF
from .tail import tail

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    """Register ``fn`` under ``name``; the registered callable first pins the
    session settings results depend on (UTC, ANSI), whatever session the
    caller passes."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


@register("readings_explode")
def q_readings_explode(spark, sf_dir):
    df = silver.exploded(spark, sf_dir)
    return rounded(df.select(
        "metric_name", "units", "date", "value_qty", "value_avg", "value_min", "value_max",
        reading_date_text(F.col("value_raw")).alias("date_text"),
        "source_file", "ingested_at", "file_modification_time"))


@register("latest_reading")
def q_latest_reading(spark, sf_dir):
    return rounded(silver.silver_base(spark, sf_dir).select(
        "metric_name", "units", "date", "value_qty", "value_avg", "value_min", "value_max",
        "source_file", "ingested_at"))


@register("stg_readings")
def q_stg_readings(spark, sf_dir):
    return rounded(silver.staged(spark, sf_dir))


@register("daily_metric_value")
def q_daily_metric_value(spark, sf_dir):
    return rounded(marts.daily_values(silver.staged(spark, sf_dir)))


def daily(spark, sf_dir):
    return marts.daily_summary(silver.staged(spark, sf_dir))


@register("daily_summary")
def q_daily_summary(spark, sf_dir):
    return rounded(daily(spark, sf_dir))


@register("unpivot_daily")
def q_unpivot_daily(spark, sf_dir):
    return rounded(marts.unpivot_daily(daily(spark, sf_dir)))


@register("weekly_trends")
def q_weekly_trends(spark, sf_dir):
    return rounded(marts.weekly_trends(daily(spark, sf_dir)))


@register("weekly_weight")
def q_weekly_weight(spark, sf_dir):
    return marts.weekly_weight(silver.staged(spark, sf_dir))


@register("metric_freshness")
def q_metric_freshness(spark, sf_dir):
    return marts.metric_freshness(silver.staged(spark, sf_dir), as_of=AS_OF)


# --- data-quality checks (K1-K10) -------------------------------------------

FRESHNESS_AS_OF = "2024-02-03 06:00:00"


@register("check_not_null")
def q_check_not_null(spark, sf_dir):
    # before the expectations, which drop exactly these rows
    return Q.not_null(silver.exploded(spark, sf_dir), "date", show=["metric_name", "source_file"])


@register("check_unique")
def q_check_unique(spark, sf_dir):
    # Uniqueness of the Silver grain: (metric_name, reading instant) must be
    # unique after dedup and is not before it (overlapping files).
    rows = silver.expectation_filter(silver.exploded(spark, sf_dir))
    return Q.unique(rows, ["metric_name", "date"])


@register("check_accepted_values")
def q_check_accepted_values(spark, sf_dir):
    return Q.accepted_values(silver.staged(spark, sf_dir), "metric_name", ACCEPTED_METRICS)


@register("check_within_range")
def q_check_within_range(spark, sf_dir):
    violations = Q.within_ranges(daily(spark, sf_dir), DAILY_RANGES)
    return violations.select("column_name", F.round("value_to_check", 6).alias("value_to_check"))


@register("check_rollup_match")
def q_check_rollup_match(spark, sf_dir):
    stg = silver.staged(spark, sf_dir)
    return rounded(Q.rollup_matches(stg, marts.daily_summary(stg)))


@register("check_file_completeness")
def q_check_file_completeness(spark, sf_dir):
    # Reference semantics: against the deduped Silver base, so a file wholly
    # superseded by a later overlapping export is reported.
    return Q.files_without_rows(silver.bronze(spark, sf_dir), silver.silver_base(spark, sf_dir))


@register("check_source_freshness")
def q_check_source_freshness(spark, sf_dir):
    return Q.source_freshness(silver.bronze(spark, sf_dir), FRESHNESS_AS_OF)


@register("quality_suite")
def q_quality_suite(spark, sf_dir):
    """The 26 data tests over stored tables: Silver and each mart are written
    once to the shared folder, so a table's counting pass and its uniqueness pass
    read its columns, not its derivation."""
    base = stored(spark, silver.silver_base(spark, sf_dir), "suite-silver")
    stg = stage_readings(base)
    d = stored(spark, marts.daily_summary(stg), "suite-daily")
    tables = {"stg": stg, "daily": d, "weekly": stored(spark, marts.weekly_trends(d), "suite-weekly"),
              "weight": stored(spark, marts.weekly_weight(stg), "suite-weight"),
              "freshness": stored(spark, marts.metric_freshness(stg, as_of=AS_OF), "suite-freshness")}
    return Q.suite_result(build.suite_counts(tables, silver.bronze(spark, sf_dir), base))


# --- sources (A1-A16) ---------------------------------------------------------
LANDED_CUTOFF = "2024-02-02 00:00:00"


@register("bronze_unwrap")
def q_bronze_unwrap(spark, sf_dir):
    b = S.unwrap(silver.bronze(spark, sf_dir))
    n = F.size(F.from_json("data", "struct<metrics: array<string>>", DOCUMENT_JSON)["metrics"])
    return b.select("_source_file", F.col("_was_wrapped").alias("was_wrapped"),
                    n.alias("n_metrics"))


@register("bronze_load")
def q_bronze_load(spark, sf_dir):
    """Land Bronze as a table (partitioned by ingestion date) and read it back."""
    path = shared_dir(spark, "landing")
    S.land(silver.bronze(spark, sf_dir), path)
    back = S.unwrap(S.read_landed(spark, path))
    p = F.from_json("data", "struct<metrics: array<struct<name: string, data: array<string>>>>", DOCUMENT_JSON)
    return back.select(
        "_source_file", "_ingested_at", F.col("ingest_date").cast("date").alias("ingest_date"),
        F.size(p["metrics"]).alias("n_metrics"),
        F.aggregate(F.transform(p["metrics"], lambda m: F.size(m["data"])), F.lit(0),
                    lambda a, x: a + x).alias("n_readings"))


@register("folder_ingest")
def q_folder_ingest(spark, sf_dir):
    """A folder of .json (and other) files ingested twice: list, keep .json, keep
    new names, unwrap, append with provenance; the second run adds nothing."""
    folder, target = shared_dir(spark, "exports"), shared_dir(spark, "bronze-table")
    dtab.export_files(dtab.table(spark, sf_dir, "events"), folder)
    for _ in range(2):
        S.ingest_folder(spark, folder, target, ingested_at=LANDED_CUTOFF)
    back = S.read_landed(spark, target)
    p = F.from_json("data", "struct<metrics: array<struct<name: string, data: array<string>>>>", DOCUMENT_JSON)
    listed = S.read_exports(spark, folder).select(F.col("source_path").alias("_path"), F.col("file_modification_time").alias("_modified"))
    back = back.join(listed, F.col("_source_file") == F.col("_path"), "left")
    return back.select(
        F.regexp_extract(F.url_decode("_source_file"), r"_source_file=([^/]+)/[^/]+\.json$", 1).alias("_source_file"),
        "_ingested_at", "ingest_date", F.size(p["metrics"]).alias("n_metrics"),
        F.aggregate(F.transform(p["metrics"], lambda m: F.size(m["data"])), F.lit(0), lambda a, x: a + x).alias("n_readings"),
        ((F.col("content_sha256") == F.sha2("data", 256)) & (F.col("content_bytes") == F.octet_length("data"))
         & (F.length("request_id") == 32) & F.col("_rescued_data").isNull()).alias("intact"),
        F.col("file_modification_time").eqNullSafe(F.col("_modified")).alias("modified_as_listed"))


@register("unparsed_documents")
def q_unparsed_documents(spark, sf_dir):
    """Landed documents the flatten could not read (nothing may just vanish): raw
    bodies taken as landed, so the corrupted ones show."""
    bodies = _raw_bodies(spark, sf_dir).withColumnRenamed("body", "data")
    return unparsed_documents(bodies)


@register("mart_order")
def q_mart_order(spark, sf_dir):
    """The marts' final sorts, shown as row numbers of the sorted mart."""
    stg = silver.staged(spark, sf_dir)
    d = marts.daily_summary(stg)
    parts = [marts.numbered(name, mart).select(F.lit(name).alias("mart"), F.col(key).cast("string").alias("row_key"), "row_no")
             for name, mart, key in (("fct_daily_activity_summary", d, "metric_date"),
                                     ("fct_weekly_trends", marts.weekly_trends(d), "week_start"),
                                     ("fct_weekly_weight_trends", marts.weekly_weight(stg), "week_end_date"),
                                     ("fct_metric_freshness", marts.metric_freshness(stg, as_of=AS_OF), "metric_name"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("new_files_anti_join")
def q_new_files_anti_join(spark, sf_dir):
    b = silver.bronze(spark, sf_dir)
    landed = b.filter(F.col("_ingested_at") <= F.lit(LANDED_CUTOFF).cast("timestamp"))
    return S.only_new(b.select("_source_file", "_ingested_at"), landed)


@register("exact_resend_dedup")
def q_exact_resend_dedup(spark, sf_dir):
    docs = dtab.export_documents(dtab.table(spark, sf_dir, "events"))
    body = docs.select(F.concat(F.lit('{"data":'), F.col("inner"), F.lit("}")).alias("data"),
                       "_ingested_at", "_source_file", "file_no")
    copies = (body.filter(F.col("file_no") % 5 == 2)
              .select("data", (F.col("_ingested_at") + F.expr("INTERVAL 1 HOUR")).alias("_ingested_at"),
                      F.concat(F.lit("copy_"), F.col("_source_file")).alias("_source_file"), "file_no"))
    kept = S.drop_exact_resends(body.unionByName(copies).drop("file_no"))
    return kept.select("_source_file", "_ingested_at", "copies")


@register("exact_resend_bodies")
def q_exact_resend_bodies(spark, sf_dir):
    """Exact resends dropped, the first copies with their bodies: what is in them and whence."""
    rows = _with_copies(spark, sf_dir)
    kept = S.with_bodies(S.drop_exact_resends(rows), rows)
    doc = F.from_json("data", "struct<exported: string, data: struct<metrics: array<struct<name: string>>>>", DOCUMENT_JSON)
    read = kept.withColumn("_doc", doc)
    return read.select("_source_file", "_ingested_at", "copies", F.col("_doc.exported").alias("exported"),
                       F.size("_doc.data.metrics").alias("n_metrics"))


def _export_bodies(spark, sf_dir):
    """Request bodies that say which export they are (as real ones carry their time)."""
    docs = dtab.export_documents(dtab.table(spark, sf_dir, "events"))
    body = F.concat(F.lit('{"exported":"'), F.col("_source_file"), F.lit('","data":'), F.col("inner"), F.lit("}"))
    return docs.select(body.alias("data"), F.lit(None).cast("string").alias("_rescued_data"), "_ingested_at", "_source_file",
                       "file_modification_time", "file_no")


def _resent(bodies):
    """Every fifth file once more, an hour later, under another name."""
    return (bodies.filter(F.col("file_no") % 5 == 2)
            .withColumns({"_ingested_at": F.col("_ingested_at") + F.expr("INTERVAL 1 HOUR"),
                          "_source_file": F.concat(F.lit("copy_"), F.col("_source_file"))}))


def _with_copies(spark, sf_dir):
    bodies = _export_bodies(spark, sf_dir)
    return bodies.unionByName(_resent(bodies)).drop("file_no")


@register("stream_resend_dedup")
def q_stream_resend_dedup(spark, sf_dir):
    """A12 on a stream: files, then in a later run (restarted from its checkpoint) resends of
    a fifth of them, batch by batch; each content is kept once.  The number of batches does
    not grow with the files."""
    source, target, ckpt = (shared_dir(spark, n) for n in ("bronze-resent", "bronze-once", "ckpt-once"))
    bodies = _export_bodies(spark, sf_dir)
    bodies.drop("file_no").write.parquet(source)
    first = ST.count_files(spark, source)
    ST.dedup_stream(spark, source, target, ckpt, max_files=ST.batch_files(first, least=4))
    _resent(bodies).drop("file_no").write.mode("append").parquet(source)
    later = ST.count_files(spark, source) - first
    ST.dedup_stream(spark, source, target, ckpt, max_files=ST.batch_files(later, least=4))
    return spark.read.parquet(target).select("_source_file", "_ingested_at", (F.col("content_sha256") == F.sha2("data", 256)).alias("intact"))


@register("ingest_counts")
def q_ingest_counts(spark, sf_dir):
    return S.ingest_counts(silver.bronze(spark, sf_dir))


@register("landing_partitions")
def q_landing_partitions(spark, sf_dir):
    b = silver.bronze(spark, sf_dir)
    return b.select("_source_file", S.landing_path("_ingested_at", "_source_file").alias("landing_path"))


# --- payload validation and summary (B5, C10, K9) -------------------------------
def _raw_bodies(spark, sf_dir):
    """Raw request bodies, one per export file."""
    return dtab.raw_bodies(dtab.table(spark, sf_dir, "events"))


@register("payload_validation")
def q_payload_validation(spark, sf_dir):
    bodies = _raw_bodies(spark, sf_dir)
    return P.classify_payloads(bodies).select("_source_file", "rule", "reason", "metric_index", "is_valid")


@register("payload_summary")
def q_payload_summary(spark, sf_dir):
    bodies = _raw_bodies(spark, sf_dir)
    valid = P.classify_payloads(bodies).filter("is_valid")
    s = P.summarize_payloads(valid)
    return s.select("_source_file", "metric_count", "workout_count",
                    F.array_join("metric_names", ",").alias("metric_names"))


# --- expectations (B3, J5, M7) --------------------------------------------------
@register("expectation_counts")
def q_expectation_counts(spark, sf_dir):
    _, counts = X.expect(silver.exploded(spark, sf_dir), SILVER_EXPECTATIONS)
    return counts


def expectation_log(spark, sf_dir):
    rows = silver.exploded(spark, sf_dir)
    return X.expectation_events(rows, SILVER_EXPECTATIONS,
                                batch=F.date_format("ingested_at", "yyyy-MM-dd"),
                                dataset="silver_readings_staging")


@register("expectation_log")
def q_expectation_log(spark, sf_dir):
    return X.expectation_totals(expectation_log(spark, sf_dir))


@register("expectation_log_latest")
def q_expectation_log_latest(spark, sf_dir):
    return X.expectation_latest(expectation_log(spark, sf_dir))


@register("expectation_dropped_total")
def q_expectation_dropped_total(spark, sf_dir):
    _, counts = X.expect(silver.exploded(spark, sf_dir), SILVER_EXPECTATIONS)
    return X.dropped_total(counts)


# --- change data capture (J3, J4, F4) --------------------------------------------
def silver_events(spark, sf_dir):
    return silver.expectation_filter(silver.exploded(spark, sf_dir))


@register("scd1_current")
def q_scd1_current(spark, sf_dir):
    cur = scd1(silver_events(spark, sf_dir), ["metric_name", "date"],
               [F.col("file_modification_time")])
    return rounded(cur.select("metric_name", "date", "value_qty", "value_avg",
                              "source_file", "file_modification_time"))


@register("scd2_history")
def q_scd2_history(spark, sf_dir):
    steps = silver_events(spark, sf_dir).filter(F.col("metric_name") == "step_count")
    h = scd2(steps, ["metric_name", "date"], "file_modification_time", ["value_qty"])
    return rounded(h.select("metric_name", "date", "value_qty", "source_file",
                            "__START_AT", "__END_AT"))


# --- schema evolution with rescued data (A13, A14) --------------------------------
def _evolving(spark, sf_dir):
    """Two runs of the evolving stream: the files landed by the cutoff, then the later ones,
    whose readings have a new field and a retyped one; returns (table, schema log)."""
    bronze = dtab.bronze_table(dtab.table(spark, sf_dir, "events"), dtab.drift_json(LANDED_CUTOFF))
    source, target, log, ckpt = (shared_dir(spark, n) for n in ("bronze-drift", "evolving", "schema-log", "ckpt-evolving"))
    early = F.col("_ingested_at") <= F.lit(LANDED_CUTOFF).cast("timestamp")
    bronze.filter(early).write.parquet(source)
    ST.evolving_stream(spark, source, target, log, ckpt)
    bronze.filter(~early).write.mode("append").parquet(source)
    ST.evolving_stream(spark, source, target, log, ckpt)
    return target, log


@register("schema_evolution_rescue")
def q_schema_evolution_rescue(spark, sf_dir):
    """Typed columns and rescued fields of every reading, over two schema versions."""
    target, log = _evolving(spark, sf_dir)
    rows = ST.read_evolving(spark, target, log)
    there = {f for f, _ in stored_fields(spark, log)}

    def field(name: str, kind: str):
        return (F.col(f"reading.{name}") if name in there else F.lit(None)).cast(kind).alias(f"f_{name.lower()}")

    rescued = F.expr("try_variant_get(try_parse_json(_rescued_data), '$', 'map<string,variant>')")
    text = F.transform(F.map_entries(rescued), lambda e: F.concat(
        e["key"], F.lit("="), F.coalesce(F.when(kind_of(e["value"]) == "number", F.try_variant_get(e["value"], "$", "double").cast("string")),
                                         F.try_variant_get(e["value"], "$", "string"))))
    return rounded(rows.select(
        "source_file", "metric_name", field("date", "string"), field("source", "string"), field("qty", "double"), field("Avg", "double"),
        field("Min", "double"), field("Max", "double"), field("context", "string"), F.array_join(text, ";").alias("rescued")))


@register("schema_versions")
def q_schema_versions(spark, sf_dir):
    """The stored schema: which version brought which field, with its JSON type."""
    _, log = _evolving(spark, sf_dir)
    return schema_versions(spark, log)


# --- lateral flatten, VARIANT at rest, macros in SQL --------------------------------
@register("variant_lateral_explode")
def q_variant_lateral_explode(spark, sf_dir):
    """C3, C4, D5 as lateral table functions: readings and their fields by metric; an object
    gives its fields, a path that is not there gives nothing, or one row where it is outer."""
    readings = lateral_readings(silver.bronze(spark, sf_dir))
    fields = lateral_fields(readings, F.col("reading"))
    absent = F.try_variant_get("reading", "$.absent", "variant")
    parts = [("reading", readings.select("metric_name", F.lit("").alias("key"))),
             ("field", fields.select("metric_name", "key")),
             ("absent", lateral_fields(readings, absent).select("metric_name", "key")),
             ("absent_outer", lateral_fields(readings, absent, outer=True).select("metric_name", F.coalesce("key", F.lit("")).alias("key")))]
    out = None
    for level, rows in parts:
        counted = rows.groupBy("metric_name", "key").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(level).alias("level"), "metric_name", "key", "n_rows")
        out = counted if out is None else out.unionByName(counted)
    return out


@register("silver_variant_paths")
def q_silver_variant_paths(spark, sf_dir):
    """Silver that keeps readings as shredded VARIANT; its columns are paths read in the scan."""
    path = shared_dir(spark, "silver-variant")
    silver.write_silver_variant(silver.silver_base(spark, sf_dir), path)
    return rounded(silver.read_silver_variant(spark, path))


@register("sql_macros")
def q_sql_macros(spark, sf_dir):
    """The display and range macros called from SQL over the stored daily mart."""
    register_macros(spark)
    stored(spark, daily(spark, sf_dir), "daily-for-sql").createOrReplaceTempView("pulse_daily_for_sql")
    bad = range_violations(spark, "pulse_daily_for_sql", DAILY_RANGES)
    register_range_check(spark, "steps_out_of_range", "pulse_daily_for_sql", "total_steps")
    steps = spark.sql("SELECT 'steps' AS macro, 'total_steps' AS name, CAST(round(value_to_check, 2) AS STRING) AS text, "
                      "CAST(NULL AS STRING) AS text0 FROM steps_out_of_range({}, {})".format(*DAILY_RANGES["total_steps"]))
    shown = spark.sql("SELECT 'display' AS macro, CAST(metric_date AS STRING) AS name, color_change(round(total_steps, 6) - 50) AS text, "
                      "color_change(round(avg_heart_rate_bpm, 6) - 50, 0) AS text0 FROM pulse_daily_for_sql")
    return shown.unionByName(steps).unionByName(bad.select(F.lit("range").alias("macro"), F.col("column_name").alias("name"),
                                        F.round("value_to_check", 2).cast("string").alias("text"), F.lit(None).cast("string").alias("text0")))


@register("check_source_freshness_pruned")
def q_check_source_freshness_pruned(spark, sf_dir):
    """K7 over the landed table, from the newest load day's files alone."""
    path = shared_dir(spark, "landed-days")
    S.land(silver.bronze(spark, sf_dir), path)
    return Q.source_freshness_pruned(spark, path, FRESHNESS_AS_OF)


# --- several persons (a subject key from the flatten to the marts) ------------------
@register("weekly_trends_by_subject")
def q_weekly_trends_by_subject(spark, sf_dir):
    """Weekly trends of each person: the subject is part of the dedup key, the stored Silver's
    folders, the marts' groups and the windows, so that none is global."""
    by = silver.SUBJECT
    bronze = dtab.bronze_table(dtab.table(spark, sf_dir, "events"), dtab.subject_json())
    rows = silver.expectation_filter(explode_readings(bronze, subject="$.subject"))
    path = shared_dir(spark, "silver-subjects")
    silver.write_silver_by_subject(latest_readings(rows, (*by, *SILVER_KEYS)), path)
    stg = stage_readings(spark.read.parquet(path), by)
    return rounded(marts.weekly_trends(marts.daily_summary(stg, by=by), by).withColumn("subject", F.col("subject").cast("long")))


# --- reports, display and scalar functions ---------------------------------------
@register("mart_tail")
def q_mart_tail(spark, sf_dir):
    return rounded(tail(marts.weekly_trends(daily(spark, sf_dir)), "fct_weekly_trends", 3))


@register("change_display")
def q_change_display(spark, sf_dir):
    dv = marts.daily_values(silver.staged(spark, sf_dir))
    # The day value is an average/sum of doubles whose last bit depends on
    # summation order (which differs between engines); it is taken to 6
    # places first so that noise cannot flip a half-way case of the display.
    x = F.round("daily_value", 6) - 50
    return dv.select("metric_name", "metric_date", change_display(x).alias("display"))


@register("scalar_functions")
def q_scalar_functions(spark, sf_dir):
    ev = dtab.table(spark, sf_dir, "events")
    ts, d = F.col("ts"), F.to_date("ts")
    return ev.select(
        "event_id",
        F.lower(F.concat(F.lit("A"), F.col("event_type"))).alias("s_lower"),
        F.substring("props", 1, 5).alias("s_sub"),
        F.lpad(F.col("user_id").cast("string"), 6, "0").alias("s_lpad"),
        F.concat(F.col("event_type"), F.lit("-"), F.col("user_id").cast("string")).alias("s_concat"),
        F.concat(F.col("event_type"), F.lit(".json")).endswith(".json").alias("b_suffix"),
        F.try_to_timestamp(F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" +0200")),
                           F.lit("yyyy-MM-dd HH:mm:ss XX")).alias("t_parsed"),
        d.alias("d_date"),
        F.to_date(F.date_trunc("week", ts)).alias("d_week"),
        F.weekofyear(ts).alias("i_week"),
        F.year(ts).alias("i_year"),
        iso_year_week(d).alias("s_year_week"),
        F.date_add(d, -3).alias("d_minus3"),
        F.datediff(d, F.lit("2024-01-01").cast("date")).alias("i_days"),
        F.round("value", 1).alias("f_round"),
        F.try_divide(F.col("value"), F.col("user_id") % 3).alias("f_div"),
        F.nullif(F.col("user_id") % 5, F.lit(0)).alias("i_nullif"),
        F.abs(F.col("value") - 50).alias("f_abs"),
        F.coalesce(F.nullif(F.col("event_type"), F.lit("view")), F.lit("v")).alias("s_coalesce"),
        F.when(F.col("value") > 100, "hi").when(F.col("value") > 10, "mid").otherwise("lo").alias("s_case"),
        F.get_json_object("props", "$.k").try_cast("double").alias("f_try_cast"),
        F.get_json_object("props", "$.k").alias("s_json"),
        F.sha2("props", 256).alias("s_sha256"),
        S.landing_path(ts, F.col("event_id").cast("string")).alias("s_path"))


# --- streaming (A1, A10, J1-J6) ----------------------------------------------------


def _bronze_parquet(spark, sf_dir):
    """Bronze written as a parquet table (a stream source), a file per task."""
    path = shared_dir(spark, "bronze")
    silver.bronze(spark, sf_dir).write.parquet(path)
    return path


@register("stream_file_ingest")
def q_stream_file_ingest(spark, sf_dir):
    folder = shared_dir(spark, "exports")
    dtab.export_files(dtab.table(spark, sf_dir, "events"), folder)
    bronze_path, ckpt = shared_dir(spark, "bronze-stream"), shared_dir(spark, "ckpt-ingest")
    ST.ingest_files(spark, folder, bronze_path, ckpt, glob="*.json")
    # A second run over the same folder must read nothing new.
    ST.ingest_files(spark, folder, bronze_path, ckpt, glob="*.json")
    back = S.unwrap(spark.read.parquet(bronze_path))
    p = F.from_json("data", "struct<metrics: array<struct<name: string, data: array<string>>>>", DOCUMENT_JSON)
    return back.select(
        "_source_file", F.size(p["metrics"]).alias("n_metrics"),
        F.aggregate(F.transform(p["metrics"], lambda m: F.size(m["data"])), F.lit(0),
                    lambda a, x: a + x).alias("n_readings"))


@register("stream_flatten")
def q_stream_flatten(spark, sf_dir):
    bronze_path = _bronze_parquet(spark, sf_dir)
    out, ckpt = shared_dir(spark, "silver-stream"), shared_dir(spark, "ckpt-flatten")
    ST.flatten_stream(spark, bronze_path, out, ckpt)
    df = spark.read.parquet(out)
    return rounded(df.select(
        "metric_name", "units", "date", "value_qty", "value_avg", "value_min", "value_max",
        reading_date_text(F.col("value_raw")).alias("date_text"),
        "source_file", "file_modification_time"))


@register("stream_scd1")
def q_stream_scd1(spark, sf_dir):
    bronze_path = _bronze_parquet(spark, sf_dir)
    target, ckpt = shared_dir(spark, "scd1-table"), shared_dir(spark, "ckpt-scd1")
    ST.scd1_stream(spark, bronze_path, target, ckpt, ["metric_name", "date"],
                   [F.col("file_modification_time")], F.to_date("date"))
    cur = ST.read_parts(spark, target)
    return rounded(cur.select("metric_name", "date", "value_qty", "value_avg",
                              "source_file", "file_modification_time"))


@register("stream_scd2")
def q_stream_scd2(spark, sf_dir):
    bronze_path = _bronze_parquet(spark, sf_dir)
    events, target, ckpt = (shared_dir(spark, n) for n in ("scd2-events", "scd2-history", "ckpt-scd2"))
    ST.scd2_stream(spark, bronze_path, events, target, ckpt, ["metric_name", "date"], "file_modification_time",
                   ["value_qty"], F.to_date("date"), where="metric_name = 'step_count'")
    h = ST.read_parts(spark, target)
    return rounded(h.select("metric_name", "date", "value_qty", "source_file",
                            "__START_AT", "__END_AT"))


# --- long calendar (orders, 1995-2001): ISO-year boundaries, 345 weeks --------------
def _order_staged(spark, sf_dir):
    apply_defaults(spark)
    return dtab.order_staged(dtab.table(spark, sf_dir, "orders"))


@register("daily_summary_long")
def q_daily_summary_long(spark, sf_dir):
    return rounded(marts.daily_summary(_order_staged(spark, sf_dir)))


@register("weekly_trends_long")
def q_weekly_trends_long(spark, sf_dir):
    return rounded(marts.weekly_trends(marts.daily_summary(_order_staged(spark, sf_dir))))


@register("weekly_weight_long")
def q_weekly_weight_long(spark, sf_dir):
    return marts.weekly_weight(_order_staged(spark, sf_dir))


# --- schema drift (A14) ----------------------------------------------------------
@register("reading_shape_profile")
def q_reading_shape_profile(spark, sf_dir):
    return reading_shapes(silver.exploded(spark, sf_dir))


# --- Silver written once, partitioned by metric; marts read it back ---------------
def _written_silver(spark, sf_dir):
    path = shared_dir(spark, "silver")
    silver.write_silver(silver.silver_base(spark, sf_dir), path)
    return silver.read_silver(spark, path)


@register("silver_table_daily_summary")
def q_silver_table_daily_summary(spark, sf_dir):
    return rounded(marts.daily_summary(stage_readings(_written_silver(spark, sf_dir))))


@register("silver_table_weekly_weight")
def q_silver_table_weekly_weight(spark, sf_dir):
    return marts.weekly_weight(stage_readings(_written_silver(spark, sf_dir)))


@register("check_file_produces_rows")
def q_check_file_produces_rows(spark, sf_dir):
    # Trap T3, our decision: completeness against the flatten *before* dedup,
    # so only files that yield nothing at all are reported (superseded files
    # are reported by ``check_file_completeness``).
    return Q.files_without_rows(silver.bronze(spark, sf_dir), silver.exploded(spark, sf_dir))


@register("stream_expectation_log")
def q_stream_expectation_log(spark, sf_dir):
    """J5: expectations on a stream, counts logged per micro-batch, read back
    as cumulative totals (the number of batches depends on file layout and
    is not part of the result)."""
    bronze_path = _bronze_parquet(spark, sf_dir)
    out, log = shared_dir(spark, "silver-logged"), shared_dir(spark, "dq-log")
    ST.flatten_stream_logged(spark, bronze_path, out, log, shared_dir(spark, "ckpt-dq"),
                             max_files=ST.batch_files(ST.count_files(spark, bronze_path), least=3))
    tot = X.expectation_totals(X.read_events(spark, log))
    return tot.select("expectation", "cumulative_passed", "cumulative_dropped")


@register("bronze_from_requests")
def q_bronze_from_requests(spark, sf_dir):
    """A13/T24: valid request bodies land (inner object), bad ones are
    quarantined with the raw text in ``_rescued_data``; per file, the number
    of readings a landed document holds (one pass, no branch per side)."""
    bodies = _raw_bodies(spark, sf_dir)
    q = P.quarantine(bodies)
    doc = F.from_json("data", "struct<metrics: array<struct<data: array<string>>>>", DOCUMENT_JSON)
    n = F.aggregate(F.transform(doc["metrics"], lambda m: F.size(m["data"])), F.lit(0),
                    lambda a, x: a + x).cast("long")
    return q.select("_source_file", "quarantined", "reason",
                    F.when(~F.col("quarantined"), n).alias("n_readings"))




@register("silver_incremental_daily_summary")
def q_silver_incremental_daily_summary(spark, sf_dir):
    """Silver built from the files landed by the cutoff, then the later files
    merged in (only touched metric-day partitions rewritten); the daily mart
    over the result equals the one of a full rebuild."""
    rows = silver.expectation_filter(silver.exploded(spark, sf_dir))
    cutoff = F.lit(LANDED_CUTOFF).cast("timestamp")
    path = shared_dir(spark, "silver-inc")
    silver.write_silver_by_day(latest_readings(rows.filter(F.col("ingested_at") <= cutoff)), path)
    silver.merge_silver(spark, path, rows.filter(F.col("ingested_at") > cutoff))
    return rounded(marts.daily_summary(stage_readings(spark.read.parquet(path).drop("reading_day"))))


@register("gold_incremental_daily_summary")
def q_gold_incremental_daily_summary(spark, sf_dir):
    """Silver and the daily mart built from the files landed by the cutoff;
    the later files are merged into Silver (touched partitions only) and the
    mart recomputed for the touched local days only.  Equals a full build."""
    rows = silver.expectation_filter(silver.exploded(spark, sf_dir))
    cutoff = F.lit(LANDED_CUTOFF).cast("timestamp")
    spath, dpath = shared_dir(spark, "silver-gold-inc"), shared_dir(spark, "daily-inc")
    silver.write_silver_by_day(latest_readings(rows.filter(F.col("ingested_at") <= cutoff)), spath)
    first = stage_readings(spark.read.parquet(spath).drop("reading_day"))
    build.write_days(marts.daily_summary(first), dpath)
    touched = silver.merge_silver(spark, spath, rows.filter(F.col("ingested_at") > cutoff))
    build.merge_daily(spark, dpath, spath, touched)
    return rounded(build.read_days(spark, dpath))


def _incremental_day_table(spark, sf_dir, name, build_fn, first=None, then=None):
    """A per-day table built from the files landed by the cutoff, then
    refreshed for the days the later files touch; ``first`` and ``then`` see it after each."""
    rows = silver.expectation_filter(silver.exploded(spark, sf_dir))
    cutoff = F.lit(LANDED_CUTOFF).cast("timestamp")
    spath, tpath = shared_dir(spark, f"silver-{name}"), shared_dir(spark, name)
    silver.write_silver_by_day(latest_readings(rows.filter(F.col("ingested_at") <= cutoff)), spath)
    build.write_days(build_fn(stage_readings(spark.read.parquet(spath).drop("reading_day"))), tpath)
    if first:
        first(build.read_days(spark, tpath))
    touched = silver.merge_silver(spark, spath, rows.filter(F.col("ingested_at") > cutoff))
    build.recompute_days(spark, tpath, spath, touched, build_fn)
    if then:
        then(build.read_days(spark, tpath), touched)
    return build.read_days(spark, tpath)


@register("gold_incremental_metric_freshness")
def q_gold_incremental_metric_freshness(spark, sf_dir):
    dc = _incremental_day_table(spark, sf_dir, "metric-day-counts", marts.metric_day_counts)
    return marts.freshness_from_day_counts(dc, as_of=AS_OF)


@register("freshness_bitmap")
def q_freshness_bitmap(spark, sf_dir):
    """Freshness from bitmaps of days per metric: built from the files landed by the cutoff,
    then merged with the later ones.  Equals the mart over all readings."""
    rows = silver.expectation_filter(silver.exploded(spark, sf_dir))
    cutoff = F.lit(LANDED_CUTOFF).cast("timestamp")
    spath, bpath = shared_dir(spark, "silver-bitmaps"), shared_dir(spark, "day-bitmaps")
    silver.write_silver_by_day(latest_readings(rows.filter(F.col("ingested_at") <= cutoff)), spath)
    day_bitmaps.write(day_bitmaps.build(stage_readings(spark.read.parquet(spath).drop("reading_day"))), bpath)
    day_bitmaps.merge(spark, bpath, spath, rows.filter(F.col("ingested_at") > cutoff))
    return day_bitmaps.freshness(day_bitmaps.read(spark, bpath)[0], as_of=AS_OF)


@register("gold_incremental_weekly_weight")
def q_gold_incremental_weekly_weight(spark, sf_dir):
    """The stored weight mart, of which only the weeks the later files touch (and those
    that refer to them, and moved seeds) are written anew.  Equals a full build."""
    return _incremental_weeks(spark, sf_dir, "daily-weight", marts.daily_weight_readings, weekly.write_weight, weekly.merge_weight)


def _incremental_weeks(spark, sf_dir, name, build_days, write, merge):
    wpath = shared_dir(spark, f"{name}-weeks")
    _incremental_day_table(spark, sf_dir, name, build_days, first=lambda d: write(d, wpath),
                           then=lambda d, touched: merge(spark, wpath, d, build.local_days(touched)))
    return weekly.read_weeks(spark, wpath)


@register("gold_incremental_weekly_trends")
def q_gold_incremental_weekly_trends(spark, sf_dir):
    """The stored weekly trends, of which only the weeks the later files touch and the next
    present ones are written anew.  Equals a full build."""
    return rounded(_incremental_weeks(spark, sf_dir, "daily-trends", marts.daily_summary, weekly.write_trends, weekly.merge_trends))


# --- the daily job over stored layers ------------------------------------------------
def _stored_layers(spark, sf_dir):
    """Full build from the files landed by the cutoff, then an incremental run with the rest."""
    bronze = silver.bronze(spark, sf_dir)
    cutoff = F.lit(LANDED_CUTOFF).cast("timestamp")
    out = shared_dir(spark, "layers")
    build.build_layers(spark, bronze.filter(F.col("_ingested_at") <= cutoff), out, AS_OF)
    return bronze, build.update_layers(spark, bronze.filter(F.col("_ingested_at") > cutoff), out, AS_OF)


@register("daily_job")
def q_daily_job(spark, sf_dir):
    """Build, incremental run and all 27 checks over the stored layers."""
    bronze, paths = _stored_layers(spark, sf_dir)
    return build.check_layers(spark, bronze, paths, FRESHNESS_AS_OF)


@register("named_layers")
def q_named_layers(spark, sf_dir):
    """The stored layers by their catalog names (schemas, views over the stored files,
    the staging view), landed Bronze among them."""
    bronze, paths = _stored_layers(spark, sf_dir)
    landed = shared_dir(spark, "landed")
    S.land(bronze, landed)
    # names of this run's own: runs that share a catalog do not replace each other's
    names = build.publish_layers(spark, paths, landed, "pulse_" + landed.rpartition("-")[2])
    parts = [spark.sql(f"SELECT '{layer}' AS layer, count(*) AS n_rows FROM {name}") for layer, name in names.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""Export payload validation and summary as Spark jobs (no per-row Python).

Rules, first failure wins (rules 6-8 run per metric, in array order, so an
early rule-8 failure precedes a later rule-6 one):

1. empty body; 2. not valid JSON (one JSON value, nothing after it);
3. not an object; 4. no ``data`` object; 5. ``data.metrics`` not a
non-empty array; 6. a metric is not an object; 7. a metric without a truthy
``name``; 8. a metric whose ``data`` is not an array; 9. ``data.workouts``
present, non-null and not an array.

Validity: ``[`` body ``, "<SHA-256 of the body>"]`` must parse as an array of
exactly two elements whose second is that hash; closing brackets, a second
document or any trailing text in the body break that.  Duplicate keys and bare
``NaN`` are accepted (the last key wins), single quotes are not.  Documents are
never one VARIANT and strings may have any length; only metric names are read
as VARIANT, to tell their JSON types apart (a name that is itself an object
with repeated keys counts as missing).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DOCUMENT_JSON

# Rule number -> reason code.
REASONS = {
    0: None,
    1: "empty_body",
    2: "invalid_json",
    3: "not_an_object",
    4: "missing_data_object",
    5: "metrics_not_non_empty_array",
    6: "metric_not_object",
    7: "metric_missing_name",
    8: "metric_missing_data_array",
    9: "workouts_not_array",
}


def _kind(v: Column) -> Column:
    """Upper-case JSON kind of a variant: OBJECT, ARRAY, STRING, BOOLEAN,
    BIGINT, DOUBLE, DECIMAL..., VOID (JSON null); NULL when missing."""
    return F.upper(F.schema_of_variant(v))


def _truthy(v: Column) -> Column:
    """Truthiness of a JSON value, as a dynamic language would judge it."""
    k = _kind(v)
    s = F.try_variant_get(v, "$", "string")
    return (F.when(v.isNull(), False)
            .when(k.startswith("VOID"), False)
            .when(k.startswith("STRING"), F.length(s) > 0)
            .when(k.startswith("BOOLEAN"), s == "true")
            .when(k.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
            .when(k.startswith("OBJECT"), k != "OBJECT<>")
            .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(True))))


_METRIC = "struct<name: variant, data: array<string>>"
_TYPED = f"struct<data: struct<metrics: array<{_METRIC}>, workouts: array<string>>>"
_RAW = "struct<metrics: array<string>, workouts: string>"


def _metric_rule(m: Column) -> Column:
    """Rule of one metric read as a struct; a non-object reads as NULL."""
    return (F.when(m.isNull(), F.lit(6)).when(~_truthy(m["name"]), F.lit(7))
            .when(m["data"].isNull(), F.lit(8)).otherwise(F.lit(0)))


def _text_rule(e: Column) -> Column:
    """Rule of one metric's raw text, where not every metric is an object."""
    return F.when(e.isNull() | ~e.startswith("{"), F.lit(6)).otherwise(
        _metric_rule(F.from_json(e, _METRIC, DOCUMENT_JSON)))


def is_one_json_document(body: Column) -> Column:
    """Whether the text is exactly one JSON value (see the module's text)."""
    digest = F.sha2(body, 256)
    parsed = F.from_json(F.concat(F.lit("["), body, F.lit(',"'), digest, F.lit('"]')), "array<string>", DOCUMENT_JSON)
    return F.coalesce((F.size(parsed) == 2) & (F.get(parsed, 1) == digest), F.lit(False))


def _classified(df: DataFrame, body: str) -> DataFrame:
    """``df`` with rule, metric_index and ``_inner``, the raw text of ``data``."""
    b = F.col(body)
    # Each step is its own projection, so that each parse runs once per body.
    s1 = df.select("*", is_one_json_document(b).alias("_one"), F.from_json(b, _TYPED, DOCUMENT_JSON)["data"].alias("_data"),
                   F.from_json(b, "struct<data: string>", DOCUMENT_JSON)["data"].alias("_inner"))
    # Raw texts are needed only where something is no object or no array.
    s2 = s1.select("*", F.when(F.col("_data.metrics").isNull() | F.col("_data.workouts").isNull(),
                               F.from_json("_inner", _RAW, DOCUMENT_JSON)).alias("_raw"))

    def first_bad(items: Column, rule) -> Column:
        return F.get(F.filter(F.transform(items, lambda e, i: F.struct(rule(e).alias("r"), i.alias("i"))), lambda x: x["r"] > 0), 0)

    mixed = F.col("_data.metrics").isNull()
    s3 = s2.select("*", F.when(mixed, first_bad(F.col("_raw.metrics"), _text_rule))
                   .otherwise(first_bad(F.col("_data.metrics"), _metric_rule)).alias("_bad"))
    rule = (F.when(b.isNull() | (F.length(b) == 0), F.lit(1))
            .when(~F.col("_one"), F.lit(2))
            .when(~b.rlike(r"^[ \t\r\n]*\{"), F.lit(3))
            .when(F.col("_data").isNull(), F.lit(4))
            .when(F.coalesce(F.size(F.coalesce("_raw.metrics", F.transform("_data.metrics", lambda m: F.lit("")))), F.lit(0)) <= 0, F.lit(5))
            .when(F.col("_bad").isNotNull(), F.col("_bad")["r"])
            .when(mixed, F.lit(6))
            .when(F.col("_data.workouts").isNull() & F.col("_raw.workouts").isNotNull(), F.lit(9))
            .otherwise(F.lit(0)))
    out = s3.withColumn("rule", rule)
    return out.select(*df.columns, "rule", F.when(F.col("rule").between(6, 8), F.col("_bad")["i"]).alias("metric_index"), "_inner")


def _reason() -> Column:
    reasons = F.create_map(*[x for k, v in REASONS.items() if v for x in (F.lit(k), F.lit(v))])
    return F.when(F.col("rule") == 0, F.lit(None).cast("string")).otherwise(F.element_at(reasons, F.col("rule")))


def classify_payloads(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``rule`` (0 = valid), ``reason``, ``metric_index`` and ``is_valid``.

    Invalid rows are the quarantine; valid rows go on to landing.
    """
    return _classified(df, body).select(*df.columns, "rule", _reason().alias("reason"), "metric_index",
                                        (F.col("rule") == 0).alias("is_valid"))


def summarize_payloads(df: DataFrame, body: str = "body") -> DataFrame:
    """Per body: ``metric_count``, ``workout_count`` and the sorted distinct
    truthy metric names (falsy names are dropped, their metrics counted)."""
    parsed = df.select("*", F.from_json(F.col(body), _TYPED, DOCUMENT_JSON)["data"].alias("_data"))
    metrics, workouts = F.col("_data.metrics"), F.col("_data.workouts")
    names = F.transform(F.filter(metrics, lambda m: _truthy(m["name"])), lambda m: F.try_variant_get(m["name"], "$", "string"))
    return parsed.select(
        *df.columns,
        F.coalesce(F.size(metrics), F.lit(0)).alias("metric_count"),
        F.coalesce(F.size(workouts), F.lit(0)).alias("workout_count"),
        F.array_sort(F.array_distinct(names)).alias("metric_names"))


def quarantine(df: DataFrame, body: str = "body") -> DataFrame:
    """One pass over raw request bodies: every row gets ``quarantined``.

    Landable rows carry the inner ``data`` object as Bronze ``data`` (the
    landed shape) with ``_rescued_data`` NULL; quarantined rows keep the raw
    text in ``_rescued_data`` with the failing rule and reason, so one bad
    file never stops the rest of the batch from landing.  Use
    :func:`landable` / :func:`quarantined` to take either side.
    """
    c = _classified(df, body)
    rest = [x for x in df.columns if x != body]
    bad = F.col("rule") != 0
    return c.select(
        F.when(~bad, F.col("_inner")).alias("data"),
        F.when(bad, F.col(body)).alias("_rescued_data"),
        *rest, bad.alias("quarantined"), "rule", _reason().alias("reason"), "metric_index")


def landable(q: DataFrame) -> DataFrame:
    return q.filter(~F.col("quarantined")).drop("quarantined", "rule", "reason", "metric_index")


def quarantined(q: DataFrame) -> DataFrame:
    return q.filter(F.col("quarantined"))

r"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A conversation becomes one example per assistant turn: all preceding turns are
its context, and only that reply is trainable (under the loss mask).  A
conversation that ends with other turns, or has no assistant turn, also gives
one context-only example with an empty mask, so no turn is lost.

Template of a turn::

    ### Assistant: <escaped text></turn>\n

The roles system, user and assistant are written System, User, Assistant; any
other role as ``=role`` (escaped).  Control strings inside texts are escaped
reversibly: ``\`` becomes ``\b``, ``###`` becomes ``\h``, ``</turn>`` becomes
``\e`` (and ``:`` in role names ``\c``).  After escaping every backslash starts
a code, so replacing the codes, ``\b`` last, restores the text exactly.

The loss mask is (loss_start, loss_length) in code points of the example's
text; it covers the escaped reply and nothing of the template.

Null texts and null roles count as empty.  Turns are ordered by (turn, role,
text), nulls first, so ties and repeated rows have one defined order; repeated
rows are turns of their own.  A row with a null conversation id belongs to no other
row's conversation and is one of its own (``alone`` tells them apart).  Extra columns are
ignored.  An empty table gives no examples.
An example holds all its preceding turns by definition, so a conversation's
rows meet in one row; conversations, not the table, bound that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.common import table

END = "</turn>\n"
#: Titles of the known roles.
TITLES = {"system": "System", "user": "User", "assistant": "Assistant"}
TEXT_CODES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e"))
ROLE_CODES = (*TEXT_CODES, (":", "\\c"), ("\n", "\\n"))


def escape(text: Column, codes=TEXT_CODES) -> Column:
    for control, code in codes:
        text = F.replace(text, F.lit(control), F.lit(code))
    return text


def unescape(text: Column, codes=TEXT_CODES) -> Column:
    for control, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(control))
    return text


def title_of(role: Column) -> Column:
    shown = F.concat(F.lit("="), escape(role, ROLE_CODES))
    for name, title in TITLES.items():
        shown = F.when(role == name, F.lit(title)).otherwise(shown)
    return shown


def role_of(title: Column) -> Column:
    role = unescape(F.substr(title, F.lit(2)), ROLE_CODES)
    for name, shown in TITLES.items():
        role = F.when(title == shown, F.lit(name)).otherwise(role)
    return role


def format_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, alone, example, text, loss_start, loss_length, is_last): the training examples.

    ``alone``: a number of its own for each row without a conversation id, else null."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit("### "), title_of(role), F.lit(": "))
    body = escape(text)
    segment = F.struct(
        "turn", role.alias("role"), text.alias("plain"), F.concat(head, body, F.lit(END)).alias("text"),
        F.char_length(head).alias("head"), F.char_length(body).alias("body"))
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    rows = turns.select("conv_id", own.alias("alone"), segment.alias("s"))
    whole = rows.groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list("s")).alias("s"))
    size = F.size("s")
    # an example per assistant turn, and one for turns after the last of them
    ends = F.filter(F.sequence(F.lit(1), size), lambda k: (k == size) | (F.element_at("s", k)["role"] == "assistant"))
    each = whole.select("conv_id", "alone", "s", F.posexplode(ends).alias("example", "end"))
    last = F.element_at("s", F.col("end"))
    target = last["role"] == "assistant"
    text = F.array_join(F.transform(F.slice("s", F.lit(1), F.col("end")), lambda x: x["text"]), "")
    out = each.select("conv_id", "alone", "example", text.alias("text"), target.alias("target"), last["head"].alias("head"),
                      last["body"].alias("body"), F.char_length(last["text"]).alias("tail"),
                      (F.col("end") == size).alias("is_last"))
    start = F.char_length("text") - F.col("tail") + F.col("head")
    return out.select("conv_id", "alone", "example", "text", F.when(F.col("target"), start).otherwise(0).cast("long").alias("loss_start"),
                      F.when(F.col("target"), F.col("body")).otherwise(0).cast("long").alias("loss_length"), "is_last")


def read_turns(text: Column) -> Column:
    """array<struct<role, text>> parsed back from an example's text."""
    segments = F.filter(F.split(text, "</turn>\n"), lambda s: s != "")
    return F.transform(segments, lambda s: F.struct(
        role_of(F.substring_index(F.substr(s, F.lit(5)), ": ", 1)).alias("role"),
        unescape(F.substr(s, F.locate(": ", s) + 2)).alias("text")))


def read_loss(text: Column, start: Column, length: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substr(text, (start + 1).cast("int"), length.cast("int")))


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, all read back from the examples."""
    read = examples.select(
        "conv_id", "alone", "example", F.char_length("text").cast("long").alias("chars"),
        F.when(F.col("is_last"), read_turns(F.col("text"))).alias("turns"),
        read_loss(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("loss"))
    joined = read.groupBy("conv_id", "alone").agg(
        F.first("turns", ignorenulls=True).alias("turns"), F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return joined.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


PROBE = "\\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return digest(format_examples(turns.unionByName(probe)))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, NULL, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, NULL, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id, alone) AS size,
    sum(length(CASE WHEN role IN ('system', 'user', 'assistant') THEN role
                    ELSE '=' || replace(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), ':', '\c'), chr(10), '\n') END)
        + length(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e')) + 14) OVER w AS prefix
  FROM t
  WINDOW w AS (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(prefix) FILTER (role = 'assistant' OR k = size) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id, alone
"""

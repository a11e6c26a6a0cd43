"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every text's rule measures (symbols, repeated words and lines, word length per
word) are sketched per (language, source).  A sketch is a histogram with buckets of
equal *relative* width: a quantile read from it is within ``ALPHA`` (relative) of the
exact one, whatever the distribution.  Sketches merge by adding counts, so the result
depends neither on the order of rows nor on partitions: two runs, and a task that is run
again, judge by the same fences.  The sketches of a language merge into the language's,
those into the corpus's; a group of fewer than ``min_rows`` texts uses the next wider one.

From the sketch of its group each measure gets fences in place of a fixed cutoff: a tail
quantile, plus (or less) a multiple of its distance to the median.  That distance
counts as one count in a text of 50 words at least, so that a group whose values are all
alike does not reject its first odd text.  Where even the upper tail quantile is 0 (few
texts have a symbol at all), those few are the tail: the fence lies half-way between the
bulk at 0 and their low quantile.  The few thresholds are written once and joined back to
the texts, and a text outside any fence goes.

Sketching pre-aggregates in every map task, so a source holding a third of the
rows costs one sketch per task.  The threshold table has one row per (language,
source); how it is joined is left to Spark, which broadcasts it only below its
size limit.

A null language or source is a group of its own.  Null and empty texts have no
words and fail the base rule.  Repeated rows count each.  Extra columns are
ignored.  An empty table has no thresholds
and keeps nothing.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulseframe.llm.common import per_row, table, text_bytes, written

MEASURES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "mean_word_chars")
#: (low quantile, its width, high quantile, its width) of each measure.  Words of odd length
#: and symbols mark whole junk texts, up to a tenth of a group, so their high quantile lies below those.
TAILS = {"symbol_ratio": (0.01, 1.0, 0.9, 4.0), "dup_line_ratio": (0.01, 1.0, 0.99, 1.5),
         "repeat_ratio": (0.01, 1.0, 0.99, 1.5), "mean_word_chars": (0.01, 1.0, 0.9, 4.0)}
#: Least distance of a tail quantile to the median: one count in the shortest text that the base rule passes.
LEAST_SPREAD = 1 / 50
MIN_ROWS = 100
#: Relative error of a quantile read from a sketch.
ALPHA = 0.005
#: Where the upper tail quantile is 0: the low quantile of the values above 0.
LOW_TAIL = 0.05
_SYMBOLS = b"#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
_COUNTS = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()),
                     *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"))])


def repeat_words(words: list[bytes], size: int = 3) -> int:
    """Words inside ``size``-word windows that the text holds twice or more."""
    first: dict[tuple, int] = {}
    hit = bytearray(len(words))
    ones = b"\x01" * size
    for k, window in enumerate(zip(*(words[i:] for i in range(size)))):
        seen = first.setdefault(window, k)
        if seen != k:
            hit[k:k + size] = ones
            hit[seen:seen + size] = ones
    return sum(hit)


def counts(text: bytes) -> tuple[int, int, int, int, int, int]:
    words = text.split()
    chars = text.decode("utf-8", "replace")
    lines = [s for s in chars.split("\n") if s.strip(_BLANKS)]
    return (len(words), len(chars) - sum(map(chars.count, _BLANKS)), len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeat_words(words))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def rows(ids, langs, sources, texts):
        return [(i, a, b, *counts(t)) for i, a, b, t in zip(ids, langs, sources, texts)]
    measured = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("lang").cast("string"), F.col("source").cast("string"), text_bytes(text_col).alias("t")).mapInArrow(
        per_row(_COUNTS, rows),
        "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")
    words = F.greatest("n_words", F.lit(1))
    return measured.withColumns({
        "symbol_ratio": F.col("n_symbols") / words, "dup_line_ratio": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_ratio": F.col("n_repeat_words") / words, "mean_word_chars": F.col("word_chars") / words,
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))})


_ZERO = -1_000_000  # the bucket of values of 0


def bucket(value: Column) -> Column:
    """Number of the bucket that holds a value of 0 or more."""
    return F.when(value > 0, F.ceil(F.ln(value) / math.log((1 + ALPHA) / (1 - ALPHA)))).otherwise(_ZERO).cast("int")


def middle(number: Column) -> Column:
    """The value that stands for a bucket: within ``ALPHA`` of every value in it."""
    gamma = (1 + ALPHA) / (1 - ALPHA)
    return F.when(number == _ZERO, 0.0).otherwise(F.pow(F.lit(gamma), number) * (2 / (gamma + 1)))


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, m, b, n): the histogram of each measure m of each group."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), bucket(F.col(m)).alias("b")) for m in MEASURES]))
    return measured.filter("NOT base_failed").select("lang", "source", values.alias("v")).groupBy("lang", "source", "v.m", "v.b").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], tails=TAILS) -> DataFrame:
    """(keys, m, rows, low, mid, high, tail) of each sketch: the tail and middle quantiles of
    its values, and the low quantile of those above 0."""
    merged = sketch.groupBy(*keys, "m", "b").agg(F.sum("n").alias("n"))
    each = W.partitionBy(*keys, "m")  # at most one row per bucket
    ranked = merged.select("*", F.sum("n").over(each).alias("rows"), F.sum("n").over(each.orderBy("b")).alias("upto"),
                           F.sum(F.when(F.col("b") == _ZERO, F.col("n")).otherwise(0)).over(each).alias("zeros"))
    of_tail = lambda k: F.element_at(F.create_map(*[F.lit(x) for m in MEASURES for x in (m, tails[m][k])]), F.col("m"))
    rank = lambda p, rows: F.greatest(F.lit(1), F.ceil(p * rows - 1e-9))  # the least value with a share p at or below it
    at = lambda p: F.min(F.when(F.col("upto") >= rank(p, F.col("rows")), F.col("b")))
    above = F.col("rows") - F.col("zeros")
    tail = F.min(F.when((F.col("b") != _ZERO) & (F.col("upto") - F.col("zeros") >= rank(F.lit(LOW_TAIL), above)), F.col("b")))
    found = ranked.groupBy(*keys, "m").agg(F.max("rows").alias("rows"), at(of_tail(0)).alias("low"), at(F.lit(0.5)).alias("mid"),
                                          at(of_tail(2)).alias("high"), tail.alias("tail"))
    return found.select(*keys, "m", "rows", *(middle(F.col(c)).alias(c) for c in ("low", "mid", "high", "tail")))


def thresholds(measured: DataFrame, tails=TAILS, min_rows: int = MIN_ROWS) -> DataFrame:
    """(lang, source, low and high of every measure), one row per group seen."""
    sketch = sketches(measured)
    group, language, corpus = (quantiles(sketch, keys, tails) for keys in (["lang", "source"], ["lang"], []))
    named = lambda df, p: df.select(*(F.col(c).alias(f"{p}_{c}") for c in df.columns))
    # the corpus has one row per measure: a proven bound
    wide = (group.join(named(language, "l"), F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("m") == F.col("l_m")))
            .join(F.broadcast(named(corpus, "c")), F.col("m") == F.col("c_m")))
    of = lambda c: F.when(F.col("rows") >= min_rows, F.col(c)).when(F.col("l_rows") >= min_rows, F.col(f"l_{c}")).otherwise(F.col(f"c_{c}"))
    picked = wide.select("lang", "source", "m", *(of(c).alias(c) for c in ("low", "mid", "high", "tail")))
    fences = []
    for m in MEASURES:
        _, low_width, _, high_width = tails[m]
        below, above = (F.greatest(d, F.lit(LEAST_SPREAD)) for d in (F.col("mid") - F.col("low"), F.col("high") - F.col("mid")))
        high = F.when((F.col("high") == 0) & F.col("tail").isNotNull(), F.greatest(high_width * F.lit(LEAST_SPREAD), F.col("tail") / 2)).otherwise(
            F.col("high") + high_width * above)
        mine = F.col("m") == m
        fences += [F.max(F.when(mine, F.col("low") - low_width * below)).alias(f"{m}_low"), F.max(F.when(mine, high)).alias(f"{m}_high")]
    return picked.groupBy("lang", "source").agg(*fences)


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` with ``kept``: false for base failures and for any measure outside its fences."""
    limits = limits.withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    inside = F.lit(True)
    for m in MEASURES:
        inside &= F.coalesce(F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")), F.lit(True))
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    return joined.select(*(measured[c] for c in measured.columns), (~F.col("base_failed") & inside).alias("kept"))


def rules(spark: SparkSession, docs: DataFrame) -> DataFrame:
    measured = written(spark, measure(docs), "measures")
    return judge(measured, written(spark, thresholds(measured), "thresholds"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

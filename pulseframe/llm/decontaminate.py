"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts (questions and answers) are normalised to words; every run of
``size`` consecutive words of an item is a window, an item of fewer words (but
not none) is one window.  The windows make one automaton, through which each
normalised document passes once; all windows that end at a place are found at
that place, and word places are mapped back to code-point offsets of the
original text.

Windows are cut, grouped and counted by Spark.  They are dealt to shards of about
``shard_chars`` characters of windows and item ids (by their measured sum), and one
shard at a time reaches the driver and is broadcast.  A larger benchmark than one shard
is several automata; each passes over the texts in a job of its own, whose result is
written before the next, so a task never holds more than one.

Null or word-less texts have no words and no hits; null or word-less items have
no windows.  Windows of items with a null id count as hits, but no item is listed for
them.  Repeated item ids count once.  Extra columns are ignored by ``scan`` (it returns
the key and its own columns) and kept by ``clean``.  An empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.common import ALNUM, WORD_PATTERN, per_row, table, text_bytes, written

WINDOW = 10
SHARD_CHARS = 16_000_000
SPANS = "array<struct<start:int,end:int>>"
_WORD = re.compile(WORD_PATTERN)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))}


def windows_table(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, items): every distinct window with the sorted ids of the items that hold it."""
    schema = pa.schema([("i", pa.string()), ("window", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(ids: list, texts: list):
            return ((i, w) for i, t in zip(ids, texts) for w in windows_of(words_of(t), size))
        yield from per_row(schema, rows, 4)(batches)

    held = benchmark.select(F.col(id_col).cast("string").alias("i"), text_bytes(text_col).alias("t")).mapInArrow(run, "i string, window binary")
    return held.groupBy("window").agg(F.sort_array(F.collect_set("i")).alias("items"))  # null ids are not collected


def shards(spark: SparkSession, benchmark: DataFrame, size: int = WINDOW, shard_chars: int = SHARD_CHARS) -> Iterator[list[tuple[bytes, tuple[str, ...]]]]:
    """[(window, items that hold it)], in lists of about ``shard_chars`` characters, one at a time."""
    windows = written(spark, windows_table(benchmark, size), "benchmark-windows")
    length = F.length("window") + F.length(F.array_join("items", ","))
    n = max(1, -(-(windows.agg(F.sum(length)).first()[0] or 0) // shard_chars))
    for k in range(n):
        part = windows if n == 1 else windows.filter(F.pmod(F.xxhash64("window"), F.lit(n)) == k)
        got = part.toArrow()  # one shard: bounded by its share of the measured sum
        if got.num_rows:
            yield [(w, tuple(i)) for w, i in zip(got.column("window").to_pylist(), got.column("items").to_pylist())]


def automaton(windows: list[tuple[bytes, tuple[str, ...]]]):
    """Windows with a space before and after, so that only whole words match."""
    import ahocorasick
    built = ahocorasick.Automaton()
    for window, items in windows:
        # Latin-1: one character per UTF-8 byte, the same in patterns and texts
        built.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, len(window) + 2, items))
    if windows:
        built.make_automaton()
    return built


def find(built, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged [start, end) word ranges inside any window, and the items found."""
    if not words or not len(built):
        return [], set()
    text = f" {b' '.join(words).decode('latin-1')} "
    ranges, items, spaces = [], set(), None
    for end, (count, chars, found) in built.iter(text):
        if spaces is None:
            spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        first = int(np.searchsorted(spaces, end - chars + 1))
        items.update(found)
        ranges.append((first, first + count))
    return merge(ranges), items


_LOWER = {c: c + 32 for c in range(65, 91)}


def offsets(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point [start, end) of word ranges in the original text."""
    wanted = {x for s, e in ranges for x in (s, e - 1)}
    at = {k: m.span() for k, m in enumerate(_WORD.finditer(text.translate(_LOWER))) if k in wanted}
    return [(at[s][0], at[e - 1][1]) for s, e in ranges]


def scan(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
         shard_chars: int = SHARD_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, n_items, items, spans) for every document.

    ``items``: sorted item ids whose windows occur; ``spans``: code-point [start, end) of
    the hit passages in the original text.
    """
    parts = shards(spark, benchmark, size, shard_chars)
    field = pa.field("id", pa.int64())
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("t"))
    windows = next(parts, [])
    for following in parts:
        # one more automaton passes over the same texts; hits are carried along
        if "ranges" not in texts.columns:
            texts = texts.withColumns({"ranges": F.array().cast(SPANS), "items": F.array().cast("array<string>")})
        texts = written(spark, texts.mapInArrow(_scanner(spark.sparkContext.broadcast(windows), field, carry=True),
                                                f"id long, t binary, ranges {SPANS}, items array<string>"), "decontamination-shard")
        windows = following
    return texts.mapInArrow(_scanner(spark.sparkContext.broadcast(windows), field), _schema())


def _schema() -> str:
    return f"id long, n_words long, n_hit long, n_items long, items array<string>, spans {SPANS}"


def _scanner(windows, field: pa.Field, carry: bool = False):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = (pa.schema([field, ("t", pa.binary()), ("ranges", span), ("items", pa.list_(pa.string()))]) if carry else
              pa.schema([field, ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                         ("items", pa.list_(pa.string())), ("spans", span)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = automaton(windows.value)

        def rows(ids, texts, ranges=None, items=None):
            for k, (key, text) in enumerate(zip(ids, texts)):
                words = words_of(text)
                hit, found = find(built, words)
                if items and items[k]:
                    found |= set(items[k])
                if ranges and ranges[k]:
                    hit = merge(hit + [(r["start"], r["end"]) for r in ranges[k]])
                if carry:
                    yield key, text, [{"start": s, "end": e} for s, e in hit], sorted(found)
                else:
                    spans = offsets(text.decode("utf-8", "replace"), hit) if hit else []
                    yield (key, len(words), sum(e - s for s, e in hit), len(found), sorted(found),
                           [{"start": s, "end": e} for s, e in spans])
        yield from per_row(schema, rows)(batches)
    return run


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
          shard_chars: int = SHARD_CHARS, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns kept.

    The verdict is taken where the row is, so no row moves and repeated or null ids are
    no matter.
    """
    kept, passed = docs, False
    for part in shards(spark, benchmark, size, shard_chars):
        if passed:  # a shard's job ends before the next one's
            kept = written(spark, kept, "decontamination-shard")
        passed = True
        windows = spark.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], windows=windows) -> Iterator[pa.RecordBatch]:
            built = automaton(windows.value)
            for big in batches:
                for at in range(0, big.num_rows, 256):
                    batch = big.slice(at, 256)
                    texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
                    yield batch.filter(pa.array([not find(built, words_of(t or b""))[0] for t in texts], pa.bool_()))
        kept = kept.mapInArrow(run, kept.schema)
    return kept


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))

"""Spelling variants grouped with a frequency-vector trie.

Two words are near if one inserted, deleted or replaced code point turns one into
the other.  A word's *vector* counts its letters by letter group.  Such an edit adds
at most one to one group (surplus) and takes at most one from another (deficit), so
all near words lie within a budget of one surplus and one deficit of its vector.

Words are arranged in a trie by successive counts of their vector, the most varied
groups first.  The top ``depth`` levels are the key that Spark shuffles on: a word
lies under its own key and is sent, as a probe, to the keys above its own that its
budget can reach (a pair is found from its smaller key alone).  Below, each task
holds the subtrie of one key at a time and searches it depth first with the budget
left; leaves hold a few words, which are compared letter by letter.

``depth`` follows from the number of words, so that a key holds about ``block`` of
them.  A key with more is split into blocks of about that many; its words and probes
visit every block, each of which may be a task of its own.  Memory is one block's
subtrie whatever the number of words; no pair is dropped.

The form of a word is its near word of largest count, ties to the first in
code-point order, where that count is at least ``ratio`` times its own; roots are
found by pointer doubling.  Counts grow by ``ratio`` along a chain, which bounds the
rounds by the logarithm of the logarithm of the largest count.

Null, empty and word-less texts have no words.  A null id counts as an empty one.
Repeated rows count each.  Extra columns are ignored.  An empty table gives an empty
result.  Words without near words have null form, are their own root and have n_near 0.
Words of any length are compared whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.common import LOWER, UPPER, crc32_sql, table, text_bytes, written

GROUPS = 20
#: Words of one subtrie, about; more are split into blocks.
BLOCK = 50_000
#: A leaf with more words is split by the next count.
LEAF = 8
#: Keys that one level of the trie is reckoned to tell apart.
SPREAD = 2.5
RATIO = 5
MISSPELT = 199
LEAST_CHARS, LEAST_COUNT = 6, 5
#: Distinct words that a task counts before it passes them on.
COUNTED = 400_000

_LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RUN = re.compile("[a-zÀ-ÿ]+")


def misspelt_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of lower-cased letter runs; in each document, about one in 199 distinct
    runs loses a letter, chosen by a checksum of id and run."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for big in batches:
            for at in range(0, big.num_rows, 64):
                batch = big.slice(at, 64)
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    start = zlib.crc32(f"{key}:".encode())
                    for word, n in Counter(_RUN.findall(text.translate(_LOWER_ASCII).decode("utf-8", "replace"))).items():
                        if len(word) < LEAST_CHARS:
                            continue
                        h = zlib.crc32(word.encode(), start)
                        if h % MISSPELT == 0:
                            cut = h % len(word)
                            word = word[:cut] + word[cut + 1:]
                            if len(word) < LEAST_CHARS:
                                continue
                        counts[word] += n
                    if len(counts) > COUNTED:
                        yield emit(counts)
                        counts.clear()
        if counts:
            yield emit(counts)

    parts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_bytes(text_col).alias("t")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def vector(word: str, groups: int = GROUPS) -> list[int]:
    counts = [0] * groups
    for c in word:
        counts[ord(c) % groups] += 1
    return counts


def near(a: str, b: str) -> bool:
    """One inserted, deleted or replaced code point apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    for x, y in zip(a, b):
        if x != y:
            break
        k += 1
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def reachable(prefix: list[int]) -> Iterator[list[int]]:
    """Other prefixes within one surplus and one deficit."""
    for up in range(-1, len(prefix)):
        for down in range(-1, len(prefix)):
            if up == down or (down >= 0 and not prefix[down]):
                continue
            other = list(prefix)
            if up >= 0:
                other[up] += 1
            if down >= 0:
                other[down] -= 1
            yield other


class Trie:
    """Items (counts, word, n) under successive counts from level ``top`` on."""

    def __init__(self, top: int, levels: int):
        self.top, self.levels, self.root = top, levels, {}

    def add(self, item: tuple) -> None:
        node, level = self.root, self.top
        while True:
            count = item[0][level]
            child = node.get(count)
            level += 1
            if child is None:
                node[count] = [item]
                return
            if type(child) is list:
                child.append(item)
                if len(child) > LEAF and level < self.levels:
                    split: dict = {}
                    for i in child:
                        split.setdefault(i[0][level], []).append(i)
                    node[count] = split
                return
            node = child

    def search(self, counts: list[int], word: str, surplus: int = 1, deficit: int = 1) -> list[tuple]:
        found, stack = [], [(self.root, self.top, surplus, deficit)]
        while stack:
            node, level, up, down = stack.pop()
            count = counts[level]
            level += 1
            for value, u, d in ((count, up, down), (count + 1, up - 1, down), (count - 1, up, down - 1)):
                if u < 0 or d < 0 or (child := node.get(value)) is None:
                    continue
                if type(child) is list:
                    found += [i for i in child if near(word, i[1])]
                else:
                    stack.append((child, level, u, d))
        return found


def level_order(words: DataFrame, groups: int = GROUPS) -> list[int]:
    """Letter groups by falling variance of their counts over all words."""
    schema = pa.schema([("g", pa.int32()), ("s", pa.float64()), ("q", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, q = [0.0] * groups, [0.0] * groups
        for batch in batches:
            for word in batch.column(0).to_pylist():
                for g, c in enumerate(vector(word, groups)):
                    if c:
                        s[g] += c
                        q[g] += c * c
        yield pa.RecordBatch.from_arrays([pa.array(range(groups), pa.int32()), pa.array(s), pa.array(q)], schema=schema)

    total = max(1, words.count())
    sums = words.select("word").mapInArrow(run, "g int, s double, q double").groupBy("g").agg(F.sum("s").alias("s"), F.sum("q").alias("q"))
    spread = {r["g"]: r["q"] / total - (r["s"] / total) ** 2 for r in sums.collect()}  # one row per letter group
    return sorted(range(groups), key=lambda g: (-spread.get(g, 0.0), g))


def near_pairs(spark: SparkSession, words: DataFrame, groups: int = GROUPS, block: int = BLOCK) -> DataFrame:
    """(word, n, other, m): every near pair of ``words`` (word, n), once in each direction."""
    total = words.count()
    depth = min(groups - 1, max(1, math.ceil(math.log(max(1.0, total / block), SPREAD))))
    order = level_order(words, groups)
    cell = pa.schema([("key", pa.string()), ("own", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])

    def name(prefix: list[int]) -> str:
        return ",".join(map(str, prefix))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 2048):
                batch = big.slice(at, 2048)
                rows = []
                for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    counts = vector(word, groups)
                    prefix = [counts[g] for g in order[:depth]]
                    rows.append((name(prefix), True, word, n))
                    rows += [(name(p), False, word, n) for p in reachable(prefix) if p > prefix]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), cell)], schema=cell)

    placed = words.select("word", "n").mapInArrow(cells, "key string, own boolean, word string, n long")
    large = written(spark, words.select("word", "n").mapInArrow(cells, "key string, own boolean, word string, n long")
                    .filter("own").groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1"), "variant-keys")
    placed = placed.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    home = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    # a key's own words lie in one block and probe its later blocks; others probe all
    placed = placed.select("key", "word", "n", F.when(F.col("own"), home).otherwise(-1).alias("home"),
                           F.explode(F.when(F.col("own"), F.sequence(home, F.col("blocks") - 1))
                                     .otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("block"))
    placed = (placed.withColumn("probe", F.col("home") != F.col("block")).drop("home")
              .repartition("key", "block").sortWithinPartitions("key", "block", "probe"))
    pair = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string()), ("m", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, trie, here = None, None, []
        for big in batches:
            for at in range(0, big.num_rows, 2048):
                batch, rows = big.slice(at, 2048), []
                for key, word, n, part, probe in zip(*(c.to_pylist() for c in batch.columns)):
                    if current != (key, part):
                        current, trie, here = (key, part), Trie(depth, groups), [int(x) for x in key.split(",")]
                    counts = vector(word, groups)
                    counts = [counts[g] for g in order]
                    over = [h - c for h, c in zip(here, counts)]
                    surplus, deficit = 1 - sum(x for x in over if x > 0), 1 + sum(x for x in over if x < 0)
                    for _, other, m in trie.search(counts, word, surplus, deficit):
                        rows += [(word, n, other, m), (other, m, word, n)]
                    if not probe:
                        trie.add((counts, word, n))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), pair)], schema=pair)

    return placed.select("key", "word", "n", "block", "probe").mapInArrow(search, "word string, n long, other string, m long")


def variants(spark: SparkSession, words: DataFrame, ratio: int = RATIO, groups: int = GROUPS, block: int = BLOCK) -> DataFrame:
    """``words`` (word, n) with form, form_n, n_near and root."""
    words = written(spark, words.select("word", F.col("n").cast("long")), "variant-words")
    best = F.min(F.struct((-F.col("m")).alias("m"), "other"))
    links = (near_pairs(spark, words, groups, block).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
             .select("word", "n", "n_near", (-F.col("best.m")).alias("m"), "best.other"))
    links = written(spark, links, "variant-links")
    roots = links.filter(F.col("m") >= ratio * F.col("n")).select("word", F.col("other").alias("form"), F.col("m").alias("form_n"), F.col("other").alias("root"))
    top = words.agg(F.max("n")).first()[0] or 1
    steps = 1 + max(0.0, math.log(top, ratio))  # a chain's counts grow by ``ratio`` a step
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        # after k rounds a root is 2^k steps away
        roots = written(spark, roots, "variant-roots")
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(onward, "root", "left").select("word", "form", "form_n", F.coalesce("next", "root").alias("root"))
    return (words.join(links.select("word", "n_near"), "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark, misspelt_words(table(spark, sf_dir, "documents")))


#: Near pairs by brute force over deletions and replacements at every place of every word.
ORACLE = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS code, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, {crc32_sql('code')} AS h FROM counted),
misspelt AS (SELECT n, CASE WHEN h % {MISSPELT} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM misspelt WHERE length(word) >= {LEAST_CHARS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
places AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
           FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT p.word, w.word AS other FROM places p JOIN words w ON w.word = p.a || p.b),
pairs AS (
  SELECT x.word, y.word AS other FROM places x JOIN places y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT word, other FROM shorter UNION ALL SELECT other, word FROM shorter),
ranked AS (SELECT p.word, p.other, w.n AS m, count(*) OVER (PARTITION BY p.word) AS n_near,
                  row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.other) AS k
           FROM pairs p JOIN words w ON w.word = p.other),
formed AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.m >= {RATIO} * w.n THEN r.other END AS form,
                  CASE WHEN r.m >= {RATIO} * w.n THEN r.m END AS form_n
           FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1),
followed AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT f.word, g.form FROM followed f JOIN formed g ON g.word = f.root WHERE g.form IS NOT NULL),
roots AS (SELECT f.word, f.root FROM followed f JOIN formed g ON g.word = f.root WHERE g.form IS NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN roots r ON r.word = f.word
"""

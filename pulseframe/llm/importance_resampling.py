"""Importance resampling towards a target distribution, ranked by a distributed radix sort.

1. A text's features (runs of consecutive words) are hashed to buckets once; the bucket
   numbers are kept as one array per document.
2. Bucket counts of all documents and of the target give a gain per bucket: the
   smoothed log-ratio of the two distributions, in thousandths.
3. The array of gains is broadcast (one entry per bucket, a fixed size) and a document's
   weight is the sum of the gains its bucket array picks.
4. Weight plus Gumbel noise, a hash of the id, is the score; the highest scores are a
   draw without replacement in proportion to exp(weight).
5. Scores are ranked by a least-significant-digit radix sort over the composite key
   (score falling, id rising, number of features rising): each pass is a stable counting
   sort.  A part counts its rows by digit; offsets are the global prefix sums of the
   counts by (digit, part); a row's destination is its offset plus its rank among the
   part's rows of that digit, and destinations deal the rows to the next pass's parts.
   Parts hold equal numbers of rows whatever the keys, so no value is a hot one.  The
   last pass's destinations are the ranks.

Each pass is written before the next, so a lost executor costs its tasks alone.  Only
totals by digit (at most 2^``digit_bits`` rows) and by bucket reach the driver.

Null, empty and word-less texts have no features, weight 0 and are not drawn.  A null id
is hashed as an empty one and comes last among ties.  Repeated rows are ranked each; equal
ones in any order, which the result does not show.  Extra columns are ignored; an empty table gives an empty
result, an empty target counts as no words.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulseframe.llm.common import ALNUM, LOWER, UPPER, WORD_PATTERN, crc32_sql, table, text_bytes, written

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
DIGIT_BITS = 16
#: Rows of one part of the sort, at least and at most.
PART_ROWS = (4096, 1 << 20)


class BucketOf(dict):
    """Feature -> bucket, remembered for recent short features."""

    def __init__(self, buckets: int, size: int = 500_000):
        super().__init__()
        self.buckets, self.size = buckets, size

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(feature) < 64:
            if len(self) >= self.size:
                self.clear()
            self[feature] = bucket
        return bucket


def text_buckets(words: list[bytes], shortest: int, longest: int, bucket_of: BucketOf) -> list[int]:
    out = []
    for n in range(shortest, longest + 1):
        out += ([bucket_of[w] for w in words] if n == 1 else
                [bucket_of[b" ".join(words[k:k + n])] for k in range(len(words) - n + 1)])
    return out


def bucket_rows(docs: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = BUCKETS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, buckets): the buckets of a text's features as little-endian uint32."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = BucketOf(buckets)
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                words = [t.translate(ALNUM).split() for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(w) for w in words], pa.int64()),
                     pa.array([np.array(text_buckets(w, shortest, longest, bucket_of), "<u4").tobytes() for w in words], pa.binary())], schema=schema)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("t")).mapInArrow(run, "doc_id long, n_words long, buckets binary")


def bucket_totals(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows each bucket holds; one row per bucket reaches the driver."""
    schema = pa.schema([("b", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in batch.column(0).to_pylist():
                totals += np.bincount(np.frombuffer(held, "<u4"), minlength=buckets)
        there = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(totals[there])], schema=schema)

    got = rows.select("buckets").mapInArrow(run, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[got.column("b").to_numpy()] = got.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log-ratio of target to source by bucket, in thousandths, rounded down."""
    k, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def noise(key: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths from a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) from bucket arrays."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)  # one entry per bucket
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in batches:
            held = [np.frombuffer(x, "<u4") for x in b.column(2).to_pylist()]
            weight = [int(gain[x].sum()) for x in held]
            score = [w + noise(k, seed) for k, w in zip(b.column(0).to_pylist(), weight)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(x) for x in held], pa.int64()),
                                              pa.array(weight, pa.int64()), pa.array(score, pa.int64())], schema=schema)
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


# ---- the sort ------------------------------------------------------------------------------

def key_fields(rows: DataFrame, keys: list[tuple[str, bool]]) -> tuple[int, list[tuple[str, bool, int, int, bool]]]:
    """Number of rows and, last key first, (column, rising, base, bits, null flag) of the composite key."""
    got = rows.agg(F.count("*").alias("n"), *[f(c).alias(f"{p}{k}") for k, (c, _) in enumerate(keys)
                                              for p, f in (("lo", F.min), ("hi", F.max), ("there", F.count))]).first()
    fields = []
    for k, (column, rising) in reversed(list(enumerate(keys))):
        lo, hi = got[f"lo{k}"], got[f"hi{k}"]
        if lo is not None:
            fields.append((column, rising, lo if rising else hi, (hi - lo).bit_length(), False))
        if got[f"there{k}"] < got["n"]:
            fields.append((column, True, 0, 1, True))  # nulls last
    return got["n"], [f for f in fields if f[3]]


def digits(batch: pa.RecordBatch, fields: list, shift: int, bits: int) -> np.ndarray:
    """Bits [shift, shift + bits) of the composite key of each row."""
    out, at = np.zeros(batch.num_rows, np.uint64), 0
    for column, rising, base, width, flag in fields:
        low, high = max(at, shift), min(at + width, shift + bits)
        if low < high:
            values = batch.column(batch.schema.get_field_index(column))
            if flag:
                value = values.is_null().to_numpy(zero_copy_only=False).astype(np.uint64)
            else:
                # differences of 64-bit numbers, exact modulo 2^64
                held = values.fill_null(base).to_numpy().view(np.uint64)
                start = np.array([base], np.int64).view(np.uint64)
                value = held - start if rising else start - held
            value = (value >> np.uint64(low - at)) & np.uint64((1 << (high - low)) - 1)
            out |= value << np.uint64(low - shift)
        at += width
    return out.astype(np.int64)


def radix_ranks(spark: SparkSession, rows: DataFrame, keys: list[tuple[str, bool]], digit_bits: int = DIGIT_BITS,
                part_rows: int | None = None) -> DataFrame:
    """``rows`` (long columns) with ``pos``: their place, from 0, in the order of ``keys`` (column, rising)."""
    total, fields = key_fields(rows, keys)
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = part_rows or min(PART_ROWS[1], max(PART_ROWS[0], -(-total // slots)))
    parts = max(1, -(-total // size))
    columns = rows.columns
    names = [*columns, "part", "pos", "digit", "behind"]
    schema = pa.schema([(c, pa.int64()) for c in names])
    all_bits = sum(f[3] for f in fields)
    passes = max(1, -(-all_bits // digit_bits))
    width = max(1, -(-all_bits // passes))
    # any first order will do, if every row has its own place in a part
    placed = rows.withColumn("pos", F.monotonically_increasing_id()).withColumn("part", F.shiftright("pos", 33).cast("long"))
    for k in range(passes):
        def count(batches: Iterator[pa.RecordBatch], shift=k * width) -> Iterator[pa.RecordBatch]:
            """Digits and, stably, how many earlier rows of the part share them."""
            current, seen = None, None
            for big in batches:
                part = big.column(len(columns)).to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), big.num_rows]
                for start, end in zip(cuts, cuts[1:]):
                    if end == start:
                        continue
                    if part[start] != current:
                        current, seen = part[start], np.zeros(1 << width, np.int64)
                    b = big.slice(start, end - start)
                    digit = digits(b, fields, shift, width)
                    order = np.argsort(digit, kind="stable")
                    ordered = digit[order]
                    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
                    run_start = np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))
                    behind = np.empty(len(digit), np.int64)
                    behind[order] = np.arange(len(ordered)) - run_start
                    behind += seen[digit]
                    np.add.at(seen, digit, 1)
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(digit), pa.array(behind)], schema=schema)

        if k:  # the first pass takes the rows as they lie
            placed = placed.repartitionById(parts, F.col("part").cast("int")).sortWithinPartitions("part", "pos")
        counted = written(spark, placed.select(*columns, "part", "pos").mapInArrow(count, ", ".join(f"{c} long" for c in names)), "radix-pass")
        histogram = counted.groupBy("digit", "part").agg(F.count("*").alias("n"))
        totals = histogram.groupBy("digit").agg(F.sum("n").alias("n")).sort("digit").toArrow()  # at most 2^width rows
        digit, n = totals.column("digit").to_numpy(), totals.column("n").to_numpy()
        base = spark.createDataFrame(pa.table({"digit": pa.array(digit), "base": pa.array(np.cumsum(n) - n)}))
        before = F.sum("n").over(W.partitionBy("digit").orderBy("part")) - F.col("n")
        # base: at most 2^width rows, a proven bound
        offsets = histogram.withColumn("before", before).join(F.broadcast(base), "digit").select("digit", "part", (F.col("base") + F.col("before")).alias("offset"))
        placed = (counted.join(offsets, ["digit", "part"]).withColumn("pos", F.col("offset") + F.col("behind"))
                  .select(*columns, "pos", F.expr(f"pos div {size}").alias("part")))
    return placed.select(*columns, "pos")


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = BUCKETS,
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, part_rows: int | None = None) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank null where it is not drawn."""
    rows = written(spark, bucket_rows(docs, shortest, longest, buckets), "resampling-buckets")
    gain = gains(bucket_totals(rows, buckets), bucket_totals(bucket_rows(target.select(F.lit(0).alias("doc_id"), "text"), shortest, longest, buckets), buckets))
    all_rows = written(spark, scored(rows, gain, seed), "resampling-scores")
    columns = ["doc_id", "n_features", "weight", "score"]
    eligible = all_rows.filter(F.col("n_words") >= least_words).select(*columns)
    drawn = percent * eligible.count() // 100
    ranked = radix_ranks(spark, eligible, [("score", False), ("doc_id", True), ("n_features", True)], part_rows=part_rows)
    rest = all_rows.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, F.when(F.col("pos") < drawn, F.col("pos") + 1).alias("rank")).unionByName(rest)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id,
                     coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD_PATTERN}'), []) AS words FROM documents),
wanted AS (SELECT regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD_PATTERN}') AS words FROM benchmark),
held AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(words) AS word FROM docs) GROUP BY ALL),
aimed AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM wanted) GROUP BY ALL),
codes AS (SELECT word, {crc32_sql('word')} % {BUCKETS} AS b FROM (SELECT word FROM held UNION SELECT word FROM aimed)),
source AS (SELECT b, sum(n) AS s FROM held JOIN codes USING (word) GROUP BY b),
target AS (SELECT b, sum(n) AS t FROM aimed JOIN codes USING (word) GROUP BY b),
totals AS (SELECT CAST(coalesce((SELECT sum(s) FROM source), 0) AS DOUBLE) AS s_all, CAST(coalesce((SELECT sum(t) FROM target), 0) AS DOUBLE) AS t_all),
gain AS (SELECT b, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (s_all + {BUCKETS})
                                        / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * (t_all + {BUCKETS})))) AS BIGINT) AS g
         FROM source FULL JOIN target USING (b), totals),
weights AS (SELECT r, CAST(sum(n * g) AS BIGINT) AS weight FROM held JOIN codes USING (word) JOIN gain USING (b) GROUP BY r),
scored AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
                                                           + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (r)),
ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * (SELECT count(*) FROM ranked) // 100 THEN place END AS rank FROM ranked
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_features < {LEAST_WORDS}
"""

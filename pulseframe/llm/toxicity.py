"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w.x - theta_k) with one weight vector for all ordered
thresholds theta_0 < theta_1 < ...; the predicted severity is the expected
grade, the sum of those probabilities.  The likelihood of the graded rows is
maximised by gradient steps with weight decay.

Features of a text: its distinct words and their first 3 to 7 letters
(hashed), each counted once per distinct word, so one insult counts the same in
a short and in a very long text.  Only features whose link with a grade above 0
is significant in the training rows are weighted, which keeps thousands of
ordinary words in a long text from adding up.

The labels table grades texts 0 (clean) or toxic; toxic rows are split into
grade 1 and 2 by how many distinct words with clearly toxic features they hold
(fewer than the median of toxic training rows, or not).  A labels table with a
``grade`` column is used as it is.

The model is fitted on at most ``max_rows`` toxic and twice as many clean
labelled rows (smallest hashes of id and text; a documented bound on rows, whatever
an id is repeated).  Held-out rows
are never learnt from.  Every text is scored whole where it lies; nothing is
shuffled.

Null and empty texts have no features and score as the thresholds say.  Without
toxic training rows all severities are 0.  Repeated rows score alike, null ids
are scored too, extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.common import ALNUM, drawn, table, text_bytes, written
from pulseframe.llm.pu_quality import adam, held_out, sigmoid

BUCKETS = 1 << 20
MAX_ROWS = 4_000
MAX_FEATURES = 1 << 14
LEAST_Z = 4.0
LEAST_ROWS = 4


def word_features(word: bytes) -> list[int]:
    """Hashed features of one word: itself and its first 3 to 7 letters."""
    letters = word.decode("utf-8", "replace")
    return [zlib.crc32(b"w" + word) % BUCKETS,
            *(zlib.crc32(b"p%d" % n + letters[:n].encode()) % BUCKETS for n in range(3, 8) if len(letters) > n)]


def text_features(text: bytes) -> list[int]:
    return [f for w in set(text.translate(ALNUM).split()) for f in word_features(w)]


class Sparse:
    """Rows of feature counts: flat column numbers with the row of each."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, n: int):
        self.rows, self.cols, self.n = rows, cols, n

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.cols], self.n)

    def t_dot(self, g: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.cols, g[self.rows], width)


def fit_ordinal(x: Sparse, width: int, grade: np.ndarray, steps: int = 500, rate: float = 0.1,
                decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ordered thresholds).  Thresholds are a first one and positive gaps."""
    top = int(grade.max())

    def thresholds(v: np.ndarray) -> np.ndarray:
        return v[0] + np.concatenate([[0.0], np.cumsum(np.exp(v[1:]))])

    def gradient(params: np.ndarray) -> np.ndarray:
        w, v = params[:width], params[width:]
        theta, s = thresholds(v), x.dot(w)
        a = np.where(grade > 0, sigmoid(s - theta[np.maximum(grade - 1, 0)]), 1.0)
        b = np.where(grade < top, sigmoid(s - theta[np.minimum(grade, top - 1)]), 0.0)
        p = np.maximum(a - b, 1e-9)
        on_s = -(1 - a - b) / x.n
        on_theta = (np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, a * (1 - a) / p, 0), top)
                    - np.bincount(np.minimum(grade, top - 1), np.where(grade < top, b * (1 - b) / p, 0), top)) / x.n
        after = np.cumsum(on_theta[::-1])[::-1]  # a gap moves all thresholds from it on
        return np.concatenate([x.t_dot(on_s, width) + decay * w, [after[0]], after[1:] * np.exp(v[1:])])

    fitted = adam(gradient, width + top, steps, rate)
    return fitted[:width], thresholds(fitted[width:])


def select(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Buckets with a significant link to toxic rows, and which of them are clearly toxic.

    ``rows``: (y, f array<int>); counted by Spark, at most ``MAX_FEATURES`` rows come back.
    """
    total = rows.agg(F.count("*").alias("n"), F.sum((F.col("y") > 0).cast("int")).alias("hit")).first()
    share = (total["hit"] or 0) / max(1, total["n"])
    if not 0 < share < 1:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    counted = (rows.select((F.col("y") > 0).cast("int").alias("y"), F.explode(F.array_distinct("f")).alias("f"))
               .groupBy("f").agg(F.count("*").alias("n"), F.sum("y").alias("hit")).filter(F.col("n") >= LEAST_ROWS))
    z = (F.col("hit") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)))
    got = (counted.withColumn("z", z).filter(F.abs("z") >= LEAST_Z)
           .sort(F.abs("z").desc(), "f").limit(MAX_FEATURES).sort("f").toPandas())
    return got["f"].to_numpy(np.int64), ((got["z"] > 0) & (got["hit"] >= 0.9 * got["n"])).to_numpy(bool)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS):
    """(weight of each bucket, thresholds), or None where no toxic row can be learnt from."""
    spark = docs.sparkSession
    graded = "grade" in labels.columns
    known = (labels.groupBy("doc_id").agg(F.max("grade" if graded else "toxic").cast("int").alias("y"))
             .filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("y").isNotNull()))
    picked = drawn(docs, max_rows, 2, known.filter("y > 0")).unionByName(drawn(docs, 2 * max_rows, 2, known.filter("y = 0")))
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("f", pa.list_(pa.int32()))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                copies = np.repeat(np.arange(part.num_rows), part.column(2).to_numpy())
                f = pa.array([text_features(t) for t in part.column(3).to_pylist()], schema.field(2).type)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(copies)), part.column(1).take(pa.array(copies)), f.take(pa.array(copies))], schema=schema)

    rows = written(spark, picked.select(F.col("doc_id").cast("long"), "y", "copies", "t")
                   .mapInArrow(hashed, "doc_id long, y int, f array<int>"), "toxicity-rows")
    kept, clear = select(rows)
    if not len(kept):
        return None
    place = np.full(BUCKETS, -1, np.int32)
    place[kept] = np.arange(len(kept))

    def selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [[c for c in place[np.asarray(x, np.int64)].tolist() if c >= 0] for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(f, schema.field(2).type)], schema=schema)

    # the bounded sample's few selected features, in one order however rows arrive
    got = rows.mapInArrow(selected, rows.schema).toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    # rows of one id may differ in text: a second order makes the fit independent of arrival
    order = sorted(range(got.num_rows), key=lambda k, i=got.column("doc_id").to_pylist(), f=got.column("f").to_pylist(): (i[k], sorted(f[k])))
    got = got.take(pa.array(order, pa.int64()))
    y = got.column("y").to_numpy().astype(np.int64)
    lists = [sorted(f) for f in got.column("f").to_pylist()]
    x = Sparse(np.repeat(np.arange(len(y)), [len(f) for f in lists]), np.array([c for f in lists for c in f], np.int64), len(y))
    if not graded:
        marks = np.bincount(x.rows, clear[x.cols], len(y))
        y = np.where((y > 0) & (marks >= np.median(marks[y > 0])) & (marks > 0), 2, y)
    w, theta = fit_ordinal(x, len(kept), y)
    return dict(zip(kept.tolist(), w.tolist())), theta


def score(docs: DataFrame, model) -> DataFrame:
    """(doc_id, severity, grade, score): expected grade, likeliest grade, P(grade > 0)."""
    schema = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, theta = model or ({}, np.array([30.0]))

        class Words(dict):
            """Summed weight of a word's features, remembered for recent words."""
            def __missing__(self, word: bytes) -> float:
                if len(self) > 500_000:
                    self.clear()
                total = sum(weights.get(f, 0.0) for f in word_features(word))
                if len(word) < 64:
                    self[word] = total
                return total
        words = Words()
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                s = np.array([sum(sorted(words[w] for w in set(t.translate(ALNUM).split()))) for t in b.column(1).to_pylist()])
                above = sigmoid(s[:, None] - theta)
                edges = np.hstack([np.ones((len(s), 1)), above, np.zeros((len(s), 1))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(above.sum(1)), pa.array(np.argmax(-np.diff(edges), 1).astype(np.int32)), pa.array(above[:, 0])], schema=schema)
    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("t")).mapInArrow(run, "doc_id long, severity double, grade int, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "severity", "grade", "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))

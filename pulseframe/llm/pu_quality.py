"""Quality classifier by positive-unlabelled learning (non-negative risk).

Trusted positives are labelled good texts; all other training rows are read as
unlabelled web text (their labels are not looked at).  The class prior of the
unlabelled text is estimated from the data: a first model separates positives
from unlabelled, and the prior is the smallest ratio of unlabelled to positive
mass above any score threshold that still holds enough rows (a region of almost
pure positives makes the ratio the prior).  The final model minimises the
non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss by gradient steps; when the negative part falls under
zero its gradient is followed upwards instead, which keeps a flexible model
from driving it below zero.

Features are dense text statistics (repetition,
symbols, case, punctuation, word shape); ids, language, source and labels are
never inputs of a score.  Their squares and pairwise products give the linear
model its curvature.

The model is fitted on at most ``max_rows`` positives and ``max_rows``
unlabelled rows (the smallest hashes of id and text; a documented bound on rows,
so that an id that most rows share brings no more), a few hundred bytes each.  Every text is scored whole, where it lies, without a
shuffle.

Null and empty texts have all-zero counts and get a score like any other.
Without any positive training row every score is the prior's default 0.5.
Repeated rows are scored alike.  Extra columns are ignored by ``score`` and
kept by ``reject``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.adaptive_rules import repeat_words
from pulseframe.llm.common import drawn, table, text_bytes

MAX_ROWS = 12_000
THRESHOLD = 0.3
#: Share of positives that a threshold must keep for its ratio to count in the prior's estimate.
LEAST_POSITIVES = 0.2
FEATURES = ("log_words", "mean_word", "symbols", "marks", "upper", "repeats", "distinct", "digits", "dup_lines", "punctuation", "long_words")
_CLASSES = {
    "symbols": b"#*$%&|<>{}[]~^=@\\/_", "marks": b"!?", "punctuation": b".,;:",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789"}


def features(text: bytes) -> list[float]:
    """Statistics of a whole text; all ratios, so long and short texts compare."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    count = lambda c: len(text) - len(text.translate(None, _CLASSES[c]))
    lines = [s for s in text.split(b"\n") if s.strip()]
    distinct = set(words)
    return [math.log1p(len(words)) / 10, sum(map(len, words)) / n / 20, min(3.0, count("symbols") / n), min(3.0, count("marks") / n),
            count("upper") / size, repeat_words(words) / n, len(distinct) / n, count("digits") / size,
            (len(lines) - len(set(lines))) / max(1, len(lines)), min(3.0, count("punctuation") / n),
            sum(len(w) > 20 for w in distinct) / max(1, len(distinct))]


def expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised, clipped features with their pairwise products and a constant."""
    z = np.clip((x - mean) / scale, -6, 6)
    i, j = np.triu_indices(z.shape[1])
    return np.hstack([np.ones((len(z), 1)), z, np.clip(z[:, i] * z[:, j], -12, 12)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def adam(gradient, width: int, steps: int, rate: float) -> np.ndarray:
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for k in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Smallest ratio of unlabelled to positive mass above a threshold, with a margin for noise."""
    cuts = np.quantile(positive, np.linspace(0, 1 - LEAST_POSITIVES, 81))
    share = lambda s: 1 - np.searchsorted(np.sort(s), cuts) / len(s)
    p, u = share(positive), share(unlabelled)
    noise = np.sqrt(1 / len(positive) + 1 / len(unlabelled))
    return float(np.clip(np.min((u + noise) / p), 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400, rate: float = 0.05,
        decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(weights, mean, scale, prior) from feature rows."""
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    p, u = expand(positive, mean, scale), expand(unlabelled, mean, scale)

    def separate(w):  # positives against unlabelled, for the prior
        return -(p.T @ sigmoid(-(p @ w))) / len(p) + (u.T @ sigmoid(u @ w)) / len(u) + decay * w

    first = adam(separate, p.shape[1], steps // 2, rate)
    prior = estimate_prior(p @ first, u @ first)

    def risk(w):
        sp, su = p @ w, u @ w
        negative = np.mean(np.logaddexp(0, su)) - prior * np.mean(np.logaddexp(0, sp))
        grad_n = (u.T @ sigmoid(su)) / len(u) - prior * (p.T @ sigmoid(sp)) / len(p)
        if negative < 0:
            return -grad_n + decay * w
        return -prior * (p.T @ sigmoid(-sp)) / len(p) + grad_n + decay * w

    return adam(risk, p.shape[1], steps, rate), mean, scale, prior


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS):
    """Model from rows that are not held out; None where there are no trusted positives.

    Labels enter only as "is a trusted positive"; ids with contradicting labels are none.
    """
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter(~held_out(F.col("doc_id")))
    positives = drawn(docs, max_rows, 8, known.filter("quality = 1").select("doc_id"))
    unlabelled = drawn(docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()), max_rows, 9)
    picked = positives.select(F.lit(1).alias("p"), "copies", "t").unionByName(unlabelled.select(F.lit(0).alias("p"), "copies", "t"))
    schema = pa.schema([("p", pa.int32()), ("copies", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([features(t) for t in b.column(2).to_pylist()], schema.field(2).type)], schema=schema)

    got = picked.mapInArrow(run, "p int, copies long, x array<double>").toArrow()  # at most 2 * max_rows rows
    flag = got.column("p").to_numpy()
    if not flag.sum() or flag.all():
        return None
    copies = got.column("copies").to_numpy()
    x = np.array(got.column("x").combine_chunks().flatten()).reshape(len(flag), -1).repeat(copies, 0)
    flag = flag.repeat(copies)
    order = np.lexsort((*x.T, flag))  # the fit does not depend on the order in which rows arrive
    x, flag = x[order], flag[order]
    return fit(x[flag == 1], x[flag == 0])


def scores(model, texts: list[bytes]) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    weights, mean, scale, _ = model
    return sigmoid(expand(np.array([features(t) for t in texts]), mean, scale) @ weights)


def score(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score) for every text."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(model, b.column(1).to_pylist()))], schema=schema)
    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("t")).mapInArrow(run, "doc_id long, score double")


def reject(docs: DataFrame, model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without the texts scored under ``threshold``; all columns kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                texts = b.column(b.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
                yield b.filter(pa.array(scores(model, [t or b"" for t in texts]) >= threshold))
    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

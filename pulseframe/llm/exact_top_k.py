"""Exact top-k search by term-at-a-time accumulation.

A vector is a sparse row of (term, weight).  Candidates come in blocks; of each chunk
of a block, postings (rows and weights by term) are made, and every query row of the
task scatters its weighted postings, one term after the other, into a dense score
array of the chunk.  A partition selection takes the k best of the array, those of the
chunks and blocks are merged.

Queries are a stated set of rows, so each meets all candidates.  Both sides are cut
into blocks: a cell (query block, candidate block) is the unit of work, and every row
is sent to the cells of its block.  Query blocks hold about ``query_block`` rows, which
bounds a task's memory; candidates stream through in chunks of ``chunk`` rows.  Work
grows with queries x candidates, as an exhaustive search must; a row travels once per
block of the other side.

Scores are exact: sums that could pass 2^53 are added as whole numbers of any size;
scores beyond a long are the nearest long.  Ties go to the smaller id, a null id
being the largest.  Rows are told apart by place, not id: of rows with one id each is a
query and a candidate of its own.  Null vectors and those with null or non-finite
components take no part; empty vectors score 0; components that one side lacks count as
0.  Extra columns are ignored, empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulseframe.llm.common import table, written

K = 5
SCALE = 256
QUERY_BLOCK = 32_768
CANDIDATE_BLOCK = 32_768
CHUNK = 4096
#: Sums of products below this are exact in doubles.
EXACT = 2.0 ** 53
_LONG = (-(1 << 63), (1 << 63) - 1)


def quantised(vectors: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", scale: float = SCALE) -> DataFrame:
    """(vec_id, w): components as whole numbers floor(scale * x); unusable vectors go."""
    x = F.col(vector_col).cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    schema = pa.schema([("vec_id", pa.int64()), ("w", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            values = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(float))
            starts = np.concatenate([[0], np.cumsum([len(v) for v in lists])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(starts), pa.array(values))], schema=schema)

    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).filter(F.col("x").isNotNull() & usable)
            .mapInArrow(run, "vec_id long, w array<double>"))


def sparse_rows(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(terms, weights) of the non-zero components of each row."""
    out = []
    for v in column:
        w = v.values.to_numpy(zero_copy_only=False)
        terms = np.flatnonzero(w)
        out.append((terms, w[terms]))
    return out


def postings(rows: list[tuple[np.ndarray, np.ndarray]]) -> dict[int, tuple]:
    """term -> (row numbers, weights); a term of every row has a slice for row numbers."""
    if not rows:
        return {}
    owner = np.repeat(np.arange(len(rows)), [len(t) for t, _ in rows])
    terms, weights = np.concatenate([t for t, _ in rows]), np.concatenate([w for _, w in rows])
    order = np.argsort(terms, kind="stable")
    terms, owner, weights = terms[order], owner[order], weights[order]
    cuts = np.flatnonzero(np.diff(terms)) + 1
    return {int(terms[a]): (slice(None) if b - a == len(rows) else owner[a:b], weights[a:b])
            for a, b in zip([0, *cuts], [*cuts, len(terms)]) if b > a}


def whole(weights: np.ndarray) -> np.ndarray:
    return np.array([int(w) for w in weights], object)


def accumulate(query: tuple[np.ndarray, np.ndarray], posted: dict[int, tuple], n: int, exact: bool) -> np.ndarray:
    """Scores of all n rows: each query term scatters its weighted postings."""
    scores = np.zeros(n) if exact else np.array([0] * n, object)
    for term, weight in zip(*query):
        if (hit := posted.get(int(term))) is not None:
            rows, weights = hit
            scores[rows] += weight * weights if exact else int(weight) * whole(weights)
    return scores if exact else np.array([min(max(s, _LONG[0]), _LONG[1]) for s in scores], object)


def select_top(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the first places."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k], np.int64)
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[:k - len(above)]])


def search(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = K, query_block: int = QUERY_BLOCK,
           candidate_block: int = CANDIDATE_BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best other rows of ``vectors`` (vec_id, w)."""
    rows = written(spark, vectors.select("vec_id", "w", F.monotonically_increasing_id().alias("row"),
                                         F.coalesce(is_query, F.lit(False)).alias("q")), "top-k-rows")
    total = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("q")).first()
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    q_blocks = max(1, -(-total["q"] // query_block))
    # as many candidate blocks as there are tasks to fill, more where they would be too large
    c_blocks = max(1, -(-total["n"] // candidate_block), min(2 * slots, total["n"] // chunk))
    cells = q_blocks * c_blocks
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = rows.filter("q").select("vec_id", "w", "row", F.lit(0).alias("kind"), block(q_blocks).alias("a"), every(c_blocks).alias("b"))
    candidates = rows.select("vec_id", "w", "row", F.lit(1).alias("kind"), every(q_blocks).alias("a"), block(c_blocks).alias("b"))
    tasks = min(cells, max(slots, 2 * c_blocks))
    dealt = (queries.unionByName(candidates).withColumn("cell", F.col("a").cast("long") * c_blocks + F.col("b"))
             .select("cell", "kind", "vec_id", "row", "w").repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int"))
             .sortWithinPartitions("cell", "kind", F.asc_nulls_last("vec_id")))
    schema = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, asked, best, peak = None, [], [], 0.0

        def done() -> pa.RecordBatch:
            out = [(row, key, vec, score) for (row, key, _), top in zip(asked, best) for score, vec in top]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out) if out else [[]] * 4, schema)], schema=schema)

        for big in batches:
            cell, kind = big.column(0).to_numpy(), big.column(1).to_numpy()
            cuts = {0, big.num_rows, *(np.flatnonzero((np.diff(cell) != 0) | (np.diff(kind) != 0)) + 1).tolist()}
            cuts |= {x for x in range(0, big.num_rows, chunk)}
            edges = sorted(cuts)
            for start, end in zip(edges, edges[1:]):
                if cell[start] != current:
                    if asked:
                        yield done()
                    current, asked, best, peak = cell[start], [], [], 0.0
                part = big.slice(start, end - start)
                sparse = sparse_rows(part.column(4))
                largest = max((float(np.abs(w).max()) for _, w in sparse if len(w)), default=0.0)
                ids, places = part.column(2).to_pylist(), part.column(3).to_numpy()
                if kind[start] == 0:
                    asked += [(int(r), i, s) for r, i, s in zip(places, ids, sparse)]
                    best += [[] for _ in sparse]
                    peak = max(peak, largest)
                    continue
                posted = postings(sparse)
                width = max((int(t[-1]) + 1 for t, _ in sparse if len(t)), default=0)
                exact = peak * largest * width < EXACT
                for at, (row, _, query) in enumerate(asked):
                    scores = accumulate(query, posted, len(ids), exact)
                    own = np.flatnonzero(places == row)
                    top = [(int(scores[i]), ids[i]) for i in select_top(scores, k + len(own)) if i not in own]
                    best[at] = sorted(best[at] + top, key=lambda x: (-x[0], x[1] is None, x[1]))[:k]
        if asked:
            yield done()

    found = dealt.mapInArrow(run, "row long, query_id long, vec_id long, score long")
    order = W.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, quantised(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(q.w), len(c.w)) + 1), lambda i: q.w[i] * c.w[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

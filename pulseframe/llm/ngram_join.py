"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

Documents are linked when the Jaccard similarity of their sets of 5-word
n-grams is at least 0.8; the classes are the connected components of the links.
Result: one row per document with its class and its number of links.

1. A pass over the texts gives each its n-gram set's digest, size and band
   hashes.  Band and row counts follow from the threshold and a target recall:
   the most rows per band for which ``1 - (1 - threshold^rows)^bands`` reaches it
   within the budget of hashes.
2. Documents of equal n-gram sets are one node (copies are never paired).
3. Nodes are shuffled on band hashes, ids alone; each bucket links its nodes to its least
   one, a linear number of edges.  Connected components of these (unverified) edges
   are candidate groups: every pair that shares a band is inside one.
4. The full n-gram sets of candidate nodes are built again from their texts and
   every pair inside a group is verified exactly, with an inverted index: no pair is emitted;
   a task returns, per node, its number of linked documents and the least node it is
   connected to.  A component of at most ``block_grams`` n-grams is one group.  A larger
   one, which shared boilerplate may have chained together from many texts that are not
   alike, is not paired as a whole: its pairs are those of its buckets.
   - Buckets of more than ``small_bucket`` nodes, whose members are nearly all candidates of
     each other, are joined where they share nodes, and each union is a group.
   - Every other bucket is a group of its own; of buckets with the same members one is
     kept.  A pair in several groups counts in the first of them: each node carries its
     groups, and a pair whose nodes are in one union is left to that.
   A group is cut by set size into classes of ratio 1 / threshold, and classes into blocks of
   about ``block_grams`` n-grams; only blocks of the same or neighbouring classes
   can hold linked sets, and each such pair of blocks is a task of its own.
5. Connected components of the verified connections are the classes.

Only band hashes of nodes, texts of candidate nodes and small edge tables are
shuffled; intermediate tables are written to the cluster's shared folder.

A text of fewer than five words (but not none) has one n-gram, all its words; a
null or word-less text has none, links to nothing, and is its own class.
``class_id`` is the least id in the class.  Null ids are kept as rows; they
take part like others.  Repeated rows are copies of each other.  Extra columns
are ignored by ``join`` and kept by ``deduplicate``.  An empty table gives an
empty result.  N-grams are compared as 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulseframe.llm.common import ALNUM, normalised, table, text_bytes, written

WORDS = 5
#: The threshold as a fraction, so that the test is exact in whole numbers.
THRESHOLD = (4, 5)
TARGET_RECALL = 0.9998
MAX_HASHES = 300
BLOCK_GRAMS = 1_000_000
SMALL_BUCKET = 64
_M = np.uint64(0x9E3779B97F4A7C15)


def band_shape(threshold: float, target_recall: float = TARGET_RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band that reach the recall at the threshold."""
    best = (math.ceil(math.log(1 - target_recall) / math.log(1 - threshold)), 1)
    for rows in range(2, max_hashes + 1):
        bands = math.ceil(math.log(1 - target_recall) / math.log(1 - threshold ** rows))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a hash depends on all of the input's."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > 400_000:
            self.clear()
        got = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = got
        return got


def gram_set(text: bytes, hashes: WordHashes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's n-grams."""
    words = text.translate(ALNUM).split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.array([hashes[x] for x in words], np.uint64)
    n = max(1, len(w) - size + 1)
    got = np.full(n, min(len(w), size), np.uint64)
    for k in range(min(len(w), size)):
        got = mixed(got * _M + w[k:k + n])
    return np.unique(got)


def digest_of(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> list[list[int]]:
    """Per set, a 64-bit hash for each band of its MinHash signature."""
    rng = np.random.default_rng(20_240_501)
    a = rng.integers(0, 1 << 32, bands * rows, np.uint64).astype(np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, bands * rows, np.uint64).astype(np.uint32)
    out: list[list[int]] = [[] for _ in sets]
    full = [k for k, s in enumerate(sets) if len(s)]
    while full:
        part, total = [], 0  # sets that fit the processor's cache together
        while full and (not part or total + len(sets[full[0]]) <= 16_384):
            total += len(sets[full[0]])
            part.append(full.pop(0))
        x = (np.concatenate([sets[k] for k in part]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *(len(sets[k]) for k in part[:-1])])
        least = np.empty((bands * rows, len(part)), np.uint32)
        for k in range(bands * rows):
            least[k] = np.minimum.reduceat(x * a[k] + b[k], starts)
        band = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[:, None], len(part), 1)
        for k in range(rows):
            band = mixed(band * _M + least[k::rows])
        for j, values in zip(part, band.astype(np.int64).T.tolist()):
            out[j] = values
    return out


_SIGNED = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("node", pa.binary()), ("n", pa.int32()), ("bands", pa.list_(pa.int64()))])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_bytes(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("t"))


def signatures(docs: DataFrame, bands: int, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, node, n, bands): node is the digest of the text's n-gram set, null without
    n-grams; h is a hash of the whole text, which tells rows of one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                sets = [gram_set(t, hashes) for t in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), pa.array([digest_of(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()), pa.array(band_hashes(sets, bands, rows), pa.list_(pa.int64()))], schema=_SIGNED)
    return keyed(docs, id_col, text_col).mapInArrow(
        run, "id long, h long, node binary, n int, bands array<long>")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): connected components of (a, b) longs; root is the least node of each.

    Alternating star contraction: each round links every node's larger neighbours, then its
    smaller ones, to the least node it sees, until every node hangs on a root directly.  A
    round is a fixed number of joins; the rounds grow with the logarithm of the largest
    component.
    """
    links = written(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        # converged: no node hangs on a node that itself hangs on another
        parents = links.select(F.col("b").alias("p")).distinct()
        if links.join(parents, F.col("a") == F.col("p"), "left_semi").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                parents.select(F.col("p").alias("node"), F.col("p").alias("root")))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        # large star: neighbours above a node go to the least of its neighbourhood
        large = both.filter("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: neighbours below a node, and the node, go to the least of them
        lowest = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = (large.join(lowest, F.col("a") == F.col("k")).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        links = written(spark, small, "links")


def linked(index: list[np.ndarray], probes: list[np.ndarray], same: bool, threshold: tuple[int, int] = THRESHOLD) -> Iterator[tuple[int, np.ndarray]]:
    """(probe, index sets with a Jaccard similarity of the threshold or more), exactly.

    ``same``: both lists are one, and each pair is found once.
    """
    num, den = threshold
    flat = np.concatenate(index)
    owner = np.repeat(np.arange(len(index)), [len(s) for s in index])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    keys, starts = np.unique(flat, return_index=True)
    ends = np.append(starts[1:], len(flat))
    sizes = np.array([len(s) for s in index])
    for k, grams in enumerate(probes):
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        at = at[keys[at] == grams]
        begin, count = starts[at], ends[at] - starts[at]
        places = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
        common = np.bincount(owner[places], minlength=len(index))
        hit = common * den >= num * (sizes + len(grams) - common)
        if same:
            hit[:k + 1] = False
        yield k, np.flatnonzero(hit & (common > 0))


def verify(tables: pa.Table) -> pa.Table:
    """One block pair: per node its linked documents and the least node it is connected to."""
    # rows repeated under one id and text are one node
    _, first = np.unique(tables.column("nid").to_numpy(), return_index=True)
    tables = tables.take(pa.array(first))
    group, i, j = (tables.column(c)[0].as_py() for c in ("group", "i", "j"))
    nodes, copies, block, union = (tables.column(c).to_numpy() for c in ("nid", "copies", "block", "union_group"))
    sets = [np.frombuffer(g, np.uint64) for g in tables.column("grams").to_pylist()]
    buckets = [set(x or ()) for x in tables.column("buckets").to_pylist()]
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    parent = list(range(len(nodes)))  # nodes are in order, so the least place is the least node

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def ours(me: int, others: np.ndarray) -> np.ndarray:
        """Of linked pairs in several groups those that count in this one."""
        if not buckets[me] or group not in buckets[me]:
            return others  # a whole component, or a union
        keep = [int(o) for o in others if (union[me] < 0 or union[me] != union[o]) and min(buckets[me] & buckets[o]) == group]
        return np.array(keep, np.int64)

    links = np.zeros(len(nodes), np.int64)
    if len(left) and len(right):
        for k, hits in linked([sets[x] for x in left], [sets[x] for x in right], i == j):
            me = int(right[k])
            others = ours(me, left[hits]) if len(hits) else hits
            if len(others):
                links[me] += copies[others].sum()
                links[others] += copies[me]
                for other in others.tolist():
                    a, b = root(me), root(other)
                    parent[max(a, b)] = min(a, b)
    return pa.table({"nid": pa.array(nodes), "links": pa.array(links), "root": pa.array(nodes[[root(k) for k in range(len(nodes))]]),
                     "whole": tables.column("whole")})


def size_class(n: Column) -> Column:
    """Sets of classes that are not the same or neighbours differ too much in size to be linked."""
    return F.floor(F.ln(n.cast("double")) / math.log(THRESHOLD[1] / THRESHOLD[0]) + 1e-9).cast("int")


def in_blocks(members: DataFrame, block_grams: int) -> DataFrame:
    """``members`` (group, nid, n, ...) once for each pair of blocks (i, j) they take part in.

    A group of at most ``block_grams`` n-grams is the one block 0 of its own.
    """
    classes = members.groupBy("group", size_class(F.col("n")).alias("c")).agg(F.sum("n").alias("grams"))
    # at most one entry per size class, and sizes span a few dozen
    plan = classes.groupBy("group").agg(F.sum("grams").alias("all"), F.map_from_entries(F.collect_list(
        F.struct("c", F.ceil(F.col("grams") / block_grams).cast("int")))).alias("blocks"))
    held = members.join(plan, "group").withColumn("c", F.when(F.col("all") <= block_grams, 0).otherwise(size_class(F.col("n"))))
    blocks = lambda c: F.coalesce(F.try_element_at("blocks", c), F.lit(0))
    number = lambda c, k: (c.cast("long") * 1_000_000 + k)
    held = held.withColumn("block", F.when(F.col("all") <= block_grams, F.lit(0).cast("long")).otherwise(
        number(F.col("c"), F.pmod(F.xxhash64("nid"), blocks(F.col("c"))))))
    others = lambda c: F.when(blocks(c) > 0, F.transform(F.sequence(F.lit(0), blocks(c) - 1), lambda k: number(c, k))).otherwise(F.array().cast("array<long>"))
    near = F.when(F.col("all") <= block_grams, F.array(F.lit(0).cast("long"))).otherwise(
        F.concat(others(F.col("c") - 1), others(F.col("c")), others(F.col("c") + 1)))
    return (held.select(*members.columns, "block", F.explode(near).alias("other"))
            .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other"))


def candidate_groups(spark: SparkSession, banded: DataFrame, nodes: DataFrame, block_grams: int, small_bucket: int) -> DataFrame:
    """(group, nid, n, copies, first, whole, union_group, buckets): the groups whose pairs are verified.

    ``banded``: (nid, band); ``whole``: the group is a component.  ``union_group`` (-1: none)
    and ``buckets`` name the other groups that a node's pairs may be in.
    """
    counted = banded.groupBy("band").agg(F.min("nid").alias("least"), F.count("*").alias("c"), F.bit_xor(F.xxhash64("nid")).alias("members")).filter("c > 1")
    shared = written(spark, banded.join(counted, "band"), "shared-bands")  # (band, nid, least, c, members)
    component = components(spark, shared.select(F.col("nid").alias("a"), F.col("least").alias("b"))).withColumnRenamed("node", "nid")
    held = component.join(nodes.select("nid", "first", "copies", "n"), "nid")
    sizes = held.groupBy("root").agg(F.sum("n").alias("grams"))
    sized = written(spark, held.join(sizes, "root"), "components")
    facts = ["nid", "n", "copies", "first"]
    none = F.array().cast("array<long>")
    groups = sized.filter(F.col("grams") <= block_grams).select(
        F.col("root").alias("group"), *facts, F.lit(True).alias("whole"), F.lit(-1).cast("long").alias("union_group"), none.alias("buckets"))
    large = sized.filter(F.col("grams") > block_grams).select(*facts)
    if large.isEmpty():
        return groups
    inside = shared.join(large.select("nid"), "nid", "left_semi")
    unions = components(spark, inside.filter(F.col("c") > small_bucket).select(F.col("nid").alias("a"), F.col("least").alias("b")))
    unions = written(spark, unions.select(F.col("node").alias("nid"), F.col("root").alias("u")), "unions")
    # of small buckets with the same members the first; its number is no node's
    few = inside.filter(F.col("c") <= small_bucket)
    named = few.groupBy("least", "c", "members").agg(F.min("band").alias("band"))
    ours = few.join(named.withColumnsRenamed({c: f"k_{c}" for c in named.columns}),
                    (F.col("least") == F.col("k_least")) & (F.col("c") == F.col("k_c")) & (F.col("members") == F.col("k_members")))
    ours = ours.select("nid", (-2 - F.pmod(F.xxhash64("k_band", "least"), F.lit((1 << 62) - 1))).alias("bucket")).distinct()
    ours = written(spark, ours, "small-buckets")
    # at most one bucket per band
    of_node = ours.groupBy("nid").agg(F.collect_list("bucket").alias("buckets"))
    known = (large.join(unions, "nid", "left").join(of_node, "nid", "left")
             .select(*facts, F.coalesce("u", F.lit(-1)).cast("long").alias("union_group"), F.coalesce("buckets", none).alias("buckets")))
    known = written(spark, known, "members")
    by_union = known.filter("union_group >= 0").select(F.col("union_group").alias("group"), *facts, F.lit(False).alias("whole"), "union_group", none.alias("buckets"))
    by_bucket = known.join(ours, "nid").select(F.col("bucket").alias("group"), *facts, F.lit(False).alias("whole"), "union_group", "buckets")
    return groups.unionByName(by_union).unionByName(by_bucket)


def join(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         target_recall: float = TARGET_RECALL, block_grams: int = BLOCK_GRAMS, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """(id, h, class_id, n_links, kept, alone) for every row of ``docs``.

    ``kept``: the row is its class's least (id, h); ``alone``: it has no n-grams.
    """
    bands, rows = band_shape(THRESHOLD[0] / THRESHOLD[1], target_recall)
    signed = written(spark, signatures(docs, bands, rows, id_col, text_col), "signatures")
    has = signed.filter("node IS NOT NULL")
    # a node stands for all documents of its n-gram set; the least (id, h), nulls last, is its first
    nodes = has.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h")).alias("first"),
                                    F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    # numbered as they are written; from then on the number is fixed
    nodes = written(spark, nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    banded = nodes.select("nid", F.explode("bands").alias("band"))
    members = written(spark, candidate_groups(spark, banded, nodes, block_grams, small_bucket), "candidates")
    # ids first: where a node's n-grams are to go; a few block pairs, of a few buckets
    task = "array<struct<group:bigint,i:bigint,j:bigint,block:bigint,copies:bigint,union_group:bigint,buckets:array<bigint>,whole:boolean>>"
    wanted = in_blocks(members, block_grams).groupBy("nid", F.col("first.id").alias("w_id"), F.col("first.h").alias("w_h")).agg(
        F.collect_list(F.struct("group", "i", "j", "block", "copies", "union_group", "buckets", "whole")).cast(task).alias("tasks"))
    # one plan at every size: a broadcast of the candidates would grow with the table
    texts = (keyed(docs, id_col, text_col)
             .join(wanted.hint("merge"), (F.col("h") == F.col("w_h")) & F.col("id").eqNullSafe(F.col("w_id")))
             .select("nid", "tasks", "t"))

    def regram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                grams = [gram_set(t, hashes).tobytes() for t in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(grams, pa.binary())], names=["nid", "tasks", "grams"])

    grams = texts.mapInArrow(regram, f"nid long, tasks {task}, grams binary")
    dealt = grams.select("nid", "grams", F.explode("tasks").alias("k")).select("nid", "grams", "k.*")
    checked = written(spark, dealt.groupBy("group", "i", "j").applyInArrow(verify, "nid long, links long, root long, whole boolean"), "verified")
    links = checked.groupBy("nid").agg(F.sum("links").alias("links"))
    # a whole component is verified in one task; the others' block pairs are connected here
    classes, cut = checked.filter("whole").select("nid", "root"), checked.filter("NOT whole")
    if not cut.isEmpty():
        classes = classes.unionByName(components(spark, cut.select(F.col("nid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "nid"))
    least = nodes.join(classes, "nid", "left").select("node", "nid", "first", "copies", F.coalesce("root", "nid").alias("root"))
    named = least.groupBy("root").agg(F.min("first").alias("kept")).withColumnRenamed("root", "r")
    facts = (least.join(named, F.col("root") == F.col("r")).join(links, "nid", "left")
             .select(F.col("node").alias("f_node"), "kept", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    alone = F.col("node").isNull()
    return signed.join(facts, F.col("node") == F.col("f_node"), "left").select(
        "id", "h", F.when(alone, F.col("id")).otherwise(F.col("kept.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("h") == F.col("kept.h")))).alias("kept"), alone.alias("alone"))


def deduplicate(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class, that of the least id; all columns kept.

    Rows without n-grams are all kept; of rows that repeat the kept id and text, one stays.
    """
    kept = written(spark, join(spark, docs, id_col, text_col).filter("kept").groupBy("id", "h").agg(
        F.count("*").alias("n"), F.max("alone").alias("alone")), "kept")
    ids = kept.select(F.col("id").alias("k_id"), F.col("h").alias("k_h"))
    text = F.xxhash64(F.coalesce(docs[text_col].cast("binary"), F.lit(b"")))
    rows = docs.join(ids, (text == ids["k_h"]) & docs[id_col].cast("long").eqNullSafe(ids["k_id"]), "left_semi")
    if kept.filter("n > 1 AND NOT alone").isEmpty():
        return rows
    # only where rows repeat an id and a text
    name = "n" + "_" * max(map(len, docs.columns))  # no column's name
    numbered = rows.withColumn(name, F.row_number().over(Window.partitionBy(F.col(id_col), text).orderBy(F.lit(0))))
    empty = F.trim(normalised(F.coalesce(F.col(text_col).cast("string"), F.lit("")))) == ""
    return numbered.filter((F.col(name) == 1) | empty).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(spark, table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "n_links")

"""Best-fit packing of token sequences by linear grouping.

Documents become token pieces of at most ``capacity`` tokens (only longer
documents are cut).  The bin-packing plan is made on the *histogram* of piece
lengths, which has at most ``capacity`` rows whatever the corpus size:

1. pieces longer than ``small`` are large; they are sorted by length and dealt
   into ``groups`` groups of equal cardinality, each length rounded up to the
   largest of its group;
2. configurations (multisets of the few rounded sizes that fit one sequence)
   are chosen: repeatedly the fullest configuration by a bounded knapsack over
   the rounded sizes, used as often as its scarcest size allows;
3. actual documents take the slots of their group, longest first; runs of equal
   sequences are kept as (composition, count), never one by one;
4. small pieces, longest first, go to the tightest sequence that still holds
   them (best fit), then to new sequences.

The plan maps (length, rank among pieces of that length) to (sequence, offset).
Ranks come from a distributed count: pieces are ranked inside (length, salt)
cells of bounded size and shifted by the cells before, so that one length
holding a third of all rows never meets in one task.

Null text counts as empty (its document is the end token alone).  Repeated rows
are packed each on its own.  An empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulseframe.llm.common import per_row, table, text_bytes, written

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
PIECES = ("doc_id long, piece int, start long, length int, ids_crc32 long")
_PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                           ("length", pa.int32()), ("ids_crc32", pa.int64())])
#: Rows per (length, salt) cell that is ranked in one sort group, on average.
CELL_ROWS = 20_000
#: What a worker remembers of tokenised words, in bytes per generation (two are kept); an
#: entry takes about so much besides its characters.
REMEMBERED_BYTES, ENTRY_BYTES = 32_000_000, 180

# Texts of printable ASCII, line ends and precomposed Latin-1 letters do not change under
# normalisation but for lower case; their pre-tokens are these, and hold no white space.
_PLAIN = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*")
_PRE_TOKENS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\s0-9a-zß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for
    the code points from 256 on, in order."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Recent(dict):
    """Remembers ``make(key)`` for recent short keys: two generations of ``size`` bytes, about."""

    def __init__(self, make: Callable[[str], bytes], size: int):
        super().__init__()
        self.make, self.size, self.held, self.old = make, size, 0, {}

    def __missing__(self, key: str) -> bytes:
        if (got := self.old.get(key)) is None:
            got = self.make(key)
        if len(key) < 64:
            if self.held >= self.size:
                self.old, self.held = dict(self), 0
                self.clear()
            self.held += len(key) + len(got) + ENTRY_BYTES
            self[key] = got
        return got


class WordIds:
    """Token ids of texts as little-endian uint32 bytes.

    Plain texts are cut into lower-cased pre-tokens by one expression; each is tokenised
    once and remembered.  Other texts are cut at spaces, and chunks that are not plain go
    through the whole tokenizer.
    """

    def __init__(self, path: str, size: int = REMEMBERED_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.pre_tokens, self.others = Recent(self.pre_token, size), Recent(self.encode, size // 4)

    def encode(self, chunk: str) -> bytes:
        return packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def pre_token(self, lower: str) -> bytes:
        spelled = lower if lower.isascii() else lower.encode().decode("latin-1").translate(self.letters)
        return packed([t.id for t in self.model.tokenize(spelled)])

    def ids(self, text: str) -> bytes:
        if "<|" not in text and _PLAIN.fullmatch(text):  # no special token stands in it
            return b"".join(map(self.pre_tokens.__getitem__, _PRE_TOKENS.findall(text.lower())))
        # pre-tokens never span white space, so a text's ids are its chunks' ids in order
        return b"".join([self.ids(c) if "<|" not in c and _PLAIN.fullmatch(c) else self.others[c]
                         for c in text.replace("\n", " ").split(" ") if c])


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def worker_words(path: str) -> WordIds:
    """The worker process's own words, kept from task to task: functions travel by value, so
    a global of this module would be new in each task; a module that the worker holds is not."""
    held = sys.modules.setdefault("pulseframe_worker_words", types.ModuleType("pulseframe_worker_words"))
    if path not in vars(held):
        vars(held).clear()  # one vocabulary at a time
        vars(held)[path] = WordIds(path)
    return vars(held)[path]


def tokenize_pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
                    end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per token piece of every document.

    ``tokenizer_path`` None: the public vocabulary file, looked up on each executor.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(VOCABULARY)
        words = worker_words(path)

        def rows(ids: list, texts: list):
            for doc, text in zip(ids, texts):
                got = words.ids(text.decode("utf-8", "replace")) + end
                for piece, at in enumerate(range(0, len(got), 4 * capacity)):
                    part = got[at:at + 4 * capacity]
                    yield doc, piece, at // 4, len(part) // 4, zlib.crc32(part)
        yield from per_row(_PIECES_ARROW, rows)(batches)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text")).mapInArrow(run, PIECES)


def group_sizes(counts: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Linear grouping: [(rounded size, [(length, count) longest first])], largest first.

    Every group holds about the same number of pieces; a length may span groups.
    """
    total = sum(counts.values())
    share = max(1, -(-total // groups))
    out: list[tuple[int, list[tuple[int, int]]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append((length, []))
                room = share
            take = min(left, room)
            out[-1][1].append((length, take))
            left -= take
            room -= take
    return out


def fullest(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """Bounded knapsack: how many of each size fill a sequence most; larger sizes first."""
    reach = np.zeros(capacity + 1, bool)
    reach[0] = True
    after = []
    for size, count in zip(sizes, left):
        for _ in range(min(count, capacity // size)):
            grown = reach.copy()
            grown[size:] |= reach[:-size]
            if (grown == reach).all():
                break
            reach = grown
        after.append(reach)
    at = int(np.flatnonzero(reach)[-1])
    picked = [0] * len(sizes)
    for k in range(len(sizes) - 1, -1, -1):
        before = after[k - 1] if k else None
        while at and not (before[at] if k else at == 0):
            at -= sizes[k]
            picked[k] += 1
    return picked


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY, small: int | None = None,
              groups: int = 64) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset).

    The piece of rank r in its run goes to sequence ``first + (r - first rank)``; a run
    fills one slot in each of ``count`` neighbouring sequences.  Full pieces (length ==
    capacity) are sequences of their own.
    """
    small = capacity // 8 if small is None else small
    runs: list[tuple[int, int, int, int, int]] = []
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    large = {n: c for n, c in histogram.items() if small < n < capacity}
    if full := histogram.get(capacity):
        runs.append((capacity, 0, full, 0, 0))
        sequence = full

    def place(length: int, count: int, first: int, offset: int) -> None:
        runs.append((length, used[length], count, first, offset))
        used[length] += count

    grouped = group_sizes(large, groups)
    sizes, left = [s for s, _ in grouped], [sum(c for _, c in g) for _, g in grouped]
    queues = [[list(x) for x in g] for _, g in grouped]
    open_runs: list[tuple[int, int, int]] = []  # (fill, first sequence, count)
    while any(left):
        picked = fullest(sizes, left, capacity)
        times = min(n // k for n, k in zip(left, picked) if k)
        slots = [k for k, n in enumerate(picked) for _ in range(n)]
        # sequences of this configuration, as runs that fill up slot by slot
        todo = [(0, sequence, times)]
        for k in slots:
            left[k] -= times
            grown = []
            for fill, first, count in todo:
                while count:
                    length, there = queues[k][0]
                    take = min(there, count)
                    place(length, take, first, fill)
                    grown.append((fill + length, first, take))
                    first += take
                    count -= take
                    queues[k][0][1] -= take
                    if not queues[k][0][1]:
                        queues[k].pop(0)
            todo = grown
        open_runs += todo
        sequence += times
    # small pieces: best fit, longest first, over runs sorted by the room they have
    rooms: list[tuple[int, int, int]] = sorted((capacity - f, first, count) for f, first, count in open_runs)
    for length in sorted((n for n in histogram if n <= small), reverse=True):
        left_small = histogram[length]
        while left_small:
            at = bisect_left(rooms, (length, -1, -1))
            if at == len(rooms):
                per = capacity // length
                fresh = -(-left_small // per)
                insort(rooms, (capacity, sequence, fresh))
                sequence += fresh
                continue
            room, first, count = rooms.pop(at)
            if count > left_small:
                insort(rooms, (room, first + left_small, count - left_small))
                count = left_small
            times = min(room // length, left_small // count)
            for k in range(times):
                place(length, count, first, capacity - room + k * length)
            left_small -= times * count
            insort(rooms, (room - times * length, first, count))
    return runs


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Pieces of ``docs`` with their ``sequence_id`` and ``offset``."""
    pieces = written(spark, tokenize_pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    return place_pieces(pieces, capacity, cell_rows)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, cell_rows: int = CELL_ROWS) -> DataFrame:
    # at most one row per possible length reaches the driver
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return pieces.withColumns({"length": F.col("length").cast("long"), "sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    salts = max(1, -(-max(histogram.values()) // cell_rows))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n"))
    ranked = (salted.withColumn("rank", F.row_number().over(
                  W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1)
              .join(before, ["length", "salt"]))
    runs: dict[int, list] = defaultdict(list)
    for length, rank, count, first, offset in make_plan(histogram, capacity):
        runs[length].append((rank, first, offset))
    plan = {n: tuple(np.array(x, np.int64) for x in zip(*sorted(r))) for n, r in runs.items()}
    shared = pieces.sparkSession.sparkContext.broadcast(plan)  # bounded by the number of lengths, not of rows
    schema = pa.schema([*_PIECES_ARROW, ("sequence_id", pa.int64()), ("offset", pa.int64())])
    schema = schema.set(3, pa.field("length", pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                ranks, first, offsets = plan[int(n)]
                k = np.searchsorted(ranks, rank[rows], "right") - 1
                sequence[rows], offset[rows] = first[k] + rank[rows] - ranks[k], offsets[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name).cast(f.type) for f in list(schema)[:5]]
                + [pa.array(sequence), pa.array(offset)], schema=schema)

    return (ranked.select("doc_id", "piece", "start", "length", "ids_crc32",
                          (F.col("rank") + F.col("before")).alias("rank"))
            .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))

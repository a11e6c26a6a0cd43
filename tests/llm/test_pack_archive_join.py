"""Packing, archives, the n-gram join and the pipeline against brute force."""

import base64
import hashlib
import io
import random
import struct
import zipfile
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from pulseframe.llm import best_fit_packing, decontaminate, ngram_join, pii, pu_quality, warc_zip
from pulseframe.llm.common import ALNUM


# ---- packing -------------------------------------------------------------------------------

def check_plan(lengths, capacity):
    counts = Counter(lengths)
    sequences, ranks = defaultdict(list), defaultdict(list)
    for length, rank, count, first, offset in best_fit_packing.make_plan(dict(counts), capacity):
        for k in range(count):
            sequences[first + k].append((offset, length))
            ranks[length].append(rank + k)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_plans_place_every_piece_once_and_pack_tight():
    rng = random.Random(4)
    for _ in range(40):
        capacity, mean = rng.choice([16, 100, 4096]), rng.choice([0.05, 0.3, 0.6])
        lengths = [min(capacity, 1 + int(rng.expovariate(1 / (capacity * mean)))) for _ in range(rng.choice([1, 2, 50, 1500]))]
        used, least = check_plan(lengths, capacity), -(-sum(lengths) // capacity)
        if len(lengths) == 1500 and mean < 0.6:
            assert used <= 1.02 * least + 1
    assert check_plan([51] * 100, 100) == 100 and check_plan([50] * 101, 100) == 51
    assert check_plan([60] * 30 + [40] * 30 + [100], 100) == 31


def expected_pieces(rows, capacity):
    words = best_fit_packing.WordIds(__import__("public_tokenizers").path(best_fit_packing.VOCABULARY))
    out = []
    for doc, text in rows:
        ids = words.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.append((doc, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=repr)


def check_packed(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_odd_and_whole_tables(spark, odd, empty, sf):
    pytest.importorskip("public_tokenizers")
    for docs, capacity, cell in ((odd, 64, 3), (spark.read.parquet(f"{sf}/documents.parquet"), 4096, 100)):
        got = best_fit_packing.pack(spark, docs, capacity=capacity, cell_rows=cell).collect()
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == expected_pieces(rows, capacity)
        assert check_packed(got, capacity) <= 1.03 * sum(r.length for r in got) / capacity + 1
    assert best_fit_packing.pack(spark, empty).count() == 0


def test_remembered_words_equal_the_tokenizer():
    path = pytest.importorskip("public_tokenizers").path(best_fit_packing.VOCABULARY)
    words = best_fit_packing.WordIds(path, 900)  # forgets often
    rng = random.Random(9)
    parts = ["The", "ÉCOLE", "naïve,", "it's", "'S", "<|endoftext|>", "...", "é", "́", "İx", "ΑΣ", "a.b", "x!.", "½", "12", " ", "\n", "\t", " ", "한국", "ß.", "", "Ａ"]
    for _ in range(800):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", "\n"]) for _ in range(8))
        assert words.ids(text) == np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


# ---- archives ------------------------------------------------------------------------------

class Memory:
    def __init__(self, data):
        self.data, self.reads = data, []

    def size(self):
        return len(self.data)

    def read_at(self, length, offset):
        self.reads.append((offset, length))
        return self.data[offset:offset + length]


def test_ranges_of_stored_members_and_refusal_of_compressed_ones():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(zipfile.ZipInfo("a/é.txt"), b"stored bytes " * 100)
        z.writestr("big", b"x" * 5000, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 inside, longer than a record is"
    zipped = warc_zip.ZipRanges(source := Memory(out.getvalue()))
    offset, length = zipped.stored_at("a/é.txt")
    assert zipped.read(offset + 13, 13) == b"stored bytes " and length == 1300
    with pytest.raises(ValueError):
        zipped.stored_at("big")
    with pytest.raises(KeyError):
        zipped.stored_at("none")
    with pytest.raises(ValueError):
        warc_zip.ZipRanges(Memory(b"not an archive"))


def test_zip64_directory_and_fields():
    body, name = b"hello zip64", b"m"
    local = struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0, 0, 0, 0, zlib.crc32(body), 0xFFFFFFFF, 0xFFFFFFFF, 1, 20) + name
    local += struct.pack("<HHQQ", 1, 16, len(body), len(body))
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    central = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, zlib.crc32(body), 0xFFFFFFFF, 0xFFFFFFFF, 1, 4 + len(extra), 0, 0, 0, 0, 0xFFFFFFFF)
    central += name + struct.pack("<HH", 0x9999, 0) + extra
    at = len(local) + len(body)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(central), 1)
    end = struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    zipped = warc_zip.ZipRanges(Memory(local + body + central + end64 + locator + end))
    assert zipped.read(*zipped.stored_at("m")) == body


PAGES = [(1, "http://a", "same"), (2, None, "same"), (3, "http://c\r\nX: y", "other é"), (4, "u", None), (5, "u", ""), (None, "u", "same"),
         (6, "u", "x" * 300_000), (7, "u", "twice"), (7, "u", "twice"), (None, "n", "nulls"), (None, "n", "nulls")]


def test_archives_round_trip_odd_rows(spark):
    pages = spark.createDataFrame([(*r, "s", 1) for r in PAGES], "page_id long, url string, html string, sha1 string, last int")
    for size in (64_000_000, 200):
        got = sorted((tuple(r) for r in warc_zip.round_trip(spark, pages, archive_bytes=size).collect()), key=repr)
        last = {}
        for i, _, h in PAGES:
            last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
        exp = []
        for i, _, h in PAGES:
            data = (h or "").encode()
            revisit = last[h or ""] >= 0 and (i is None or i < last[h or ""])
            exp.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", last[h or ""] if revisit else None))
        assert got == sorted(exp, key=repr)
    assert warc_zip.round_trip(spark, pages.limit(0)).count() == 0
    few = warc_zip.round_trip(spark, pages, min_bytes=5).collect()
    assert Counter(r.record_type for r in few)["revisit"] == 0  # payloads under the limit are all responses


def foreign_archive(path, indexed):
    """An archive by another writer: two archive members, other names, an index of one or of both."""
    records = [warc_zip.record_bytes(k, f"http://{k}", f"page {k} ".encode() * k, warc_zip.digest_of(f"page {k} ".encode() * k), None) for k in range(1, 8)]
    parts = {"first-00.warc.gz": records[:4], "second.warc.gz": records[4:]}
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("datapackage.json", "{}")
        for name, held in parts.items():
            z.writestr(f"archive/{name}", b"".join(held))
        for name in indexed:
            lines, at = [], 0
            for r in parts[name]:
                lines.append(f'com,x)/ 2000 {{"offset": "{at}", "length": "{len(r)}", "filename": "{name}"}}')
                at += len(r)
            z.writestr(f"indexes/{name}.cdxj", "\n".join(lines) + "\n")


@pytest.mark.parametrize("indexed", [("first-00.warc.gz", "second.warc.gz"), ("second.warc.gz",), ()])
def test_archives_of_other_writers_are_found_by_the_directory(spark, tmpdir_path, indexed):
    path = f"{tmpdir_path}/foreign.wacz"
    foreign_archive(path, indexed)
    archives = spark.createDataFrame([(path,)], "uri string")
    got = warc_zip.read_records(warc_zip.index_entries(archives), 3).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type) for r in got) == [(k, 7 * k, "response") for k in range(1, 8)]


def test_walking_members_over_piece_ends_and_cut_archives():
    records = [warc_zip.record_bytes(k, "u", b"x" * k * 50, "D", None) for k in range(1, 6)]
    data = b"head" + b"".join(records)
    read = lambda o, n: data[o:o + n]
    for piece in (1, 7, 100, 10 ** 6):
        found = list(warc_zip.walk_members(read, 4, len(data) - 4, piece))
        assert [data[o:o + n] for o, n in found] == records
    with pytest.raises(ValueError):
        list(warc_zip.walk_members(read, 4, len(data) - 6))


def test_archive_query_equals_its_oracle(spark, sf):
    got = warc_zip.query(spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    res = con.execute(warc_zip.ORACLE)
    order = [got.columns.index(d[0]) for d in res.description]
    assert sorted(tuple(r[k] for k in order) for r in got.collect()) == sorted(res.fetchall())


# ---- n-gram join ---------------------------------------------------------------------------

def classes(rows):
    """{(id, row): (class, links)} by comparing all pairs that share an n-gram."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(ALNUM).split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent, links, seen = list(range(len(rows))), [0] * len(rows), defaultdict(list)

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for k, grams in enumerate(sets):
        common = Counter(j for g in grams for j in seen[g])
        for g in grams:
            seen[g].append(k)
        for j, n in common.items():
            if 5 * n >= 4 * (len(grams) + len(sets[j]) - n):
                links[k] += 1
                links[j] += 1
                parent[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, least.get(find(k)) if sets[k] else i, links[k]) for k, (i, _) in enumerate(rows)), key=repr)


def near(seed, n, words=120, change=2):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, change)):
            text[rng.randrange(words)] = f"v{rng.randrange(10_000)}"
        out.append(" ".join(text))
    return out


def test_band_counts_reach_the_recall():
    bands, rows = ngram_join.band_shape(0.8, 0.9998)
    assert bands * rows <= ngram_join.MAX_HASHES and 1 - (1 - 0.8 ** rows) ** bands >= 0.9998
    assert ngram_join.band_shape(0.5, 0.99, 4)[1] == 1


def test_join_odd_rows_and_hot_groups_equal_brute_force(spark, odd, empty):
    texts = [t for s in range(6) for t in near(s, 12)] + near(77, 150, change=3) + ["copy " * 40] * 50
    schema = "doc_id long, text string, node string, bands int"
    docs = spark.createDataFrame([(100 + k, t, "x", 0) for k, t in enumerate(texts)], schema).unionByName(
        odd.selectExpr("doc_id", "text", "t AS node", "n AS bands"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    exp = classes(rows)
    # whole components; unions of large buckets cut into many blocks; buckets alone; few nodes to a bucket
    for block, small in ((1_000_000, 64), (3_000, 8), (2_000, 1_000_000), (500, 2)):
        got = ngram_join.join(spark, docs, block_grams=block, small_bucket=small).collect()
        assert sorted(((r.id, r.class_id, r.n_links) for r in got), key=repr) == exp, (block, small)
    kept = ngram_join.deduplicate(spark, docs)
    blank = sum(not (t or "").encode().translate(ALNUM).split() for _, t in rows)
    ids = {c for i, c, _ in exp}
    assert kept.columns == docs.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(i for i, t in left if i is not None) == sorted(i for i in ids if i is not None)
    assert blank == sum(not (t or "").encode().translate(ALNUM).split() for _, t in left)
    assert ngram_join.join(spark, empty).count() == 0 and ngram_join.deduplicate(spark, empty).count() == 0


def test_chains_of_unlike_texts_are_not_paired_as_a_whole(spark, monkeypatch):
    """Texts that share three quarters of their n-grams with the next one: one long component of
    candidates, with few links; groups stay small and no pair is lost or counted twice."""
    rng = random.Random(11)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(4000)]
    texts = [" ".join(words[k * 15:k * 15 + 120]) for k in range(220)]
    texts += [t + " more" for t in texts[::10]] + [" ".join(t.split()[:110]) for t in texts[5::10]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    blocks = ngram_join.in_blocks
    monkeypatch.setattr(ngram_join, "in_blocks", lambda m, b: seen.append(m.groupBy("group").count().agg({"count": "max"}).first()[0]) or blocks(m, b))
    exp = classes(list(enumerate(texts)))
    for block in (10 ** 9, 2000):
        got = ngram_join.join(spark, docs, block_grams=block).collect()
        assert sorted(((r.id, r.class_id, r.n_links) for r in got), key=repr) == exp
    assert seen[0] > 100 and seen[1] < 30


def test_join_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in ngram_join.query(spark, sf).collect()), key=repr) == classes(rows)


def test_components_of_long_chains(spark):
    chain = [(k, k + 1) for k in range(120) if k != 60]
    got = {r.node: r.root for r in ngram_join.components(spark, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 if k <= 60 else 61 for k in range(121)}


# ---- pipeline ------------------------------------------------------------------------------

def test_pipeline_stage_by_stage_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    model = pu_quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = {r.doc_id: r for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    good = {i for i, r in rows.items() if pu_quality.scores(model, [(r.text or "").encode()])[0] >= 0.3}
    firsts = {c for _, c, _ in classes([(i, rows[i].text) for i in sorted(good)])}
    windows = {w for _, t in items for w in decontaminate.windows_of(decontaminate.words_of((t or "").encode()))}
    built = decontaminate.automaton([(w, ("x",)) for w in windows])
    clean = {i for i in firsts if not decontaminate.find(built, decontaminate.words_of((rows[i].text or "").encode()))[0]}
    stages = dict(corpus_pipeline.STAGES)
    at = docs
    for name, exp in (("quality", good), ("near_duplicates", firsts), ("leaks", clean), ("personal_data", clean)):
        at = stages[name](spark, at, sf).cache()
        assert at.columns == columns and sorted(r.doc_id for r in at.collect()) == sorted(exp), name
    masked = {r.doc_id: r for r in at.collect()}
    assert all(r.text == pii.redacted(rows[i].text) and r.n_chars == len(r.text) for i, r in masked.items())
    assert expected_pieces([(i, r.text) for i, r in masked.items()], 4096) == sorted(
        ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, sf).collect()), key=repr)


def test_pipeline_on_an_empty_table(spark, empty, sf):
    at = empty
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, sf)
    assert at.count() == 0


def test_pipeline_on_odd_rows(spark, odd, sf):
    """Nulls, empty and very long texts, repeated rows, null ids and clashing columns, stage by stage."""
    docs = odd.withColumn("n_chars", odd.text.isNotNull().cast("long"))
    at, left = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf).cache()
        assert at.columns == docs.columns and at.count() <= left, name
        left = at.count()
    kept = at.collect()
    texts = [r.text for r in kept if r.text and r.text.strip()]
    assert len(texts) == len(set(texts))  # of copies one stays
    packed = corpus_pipeline.STAGES[-1][1](spark, at, sf)
    assert packed.filter("piece = 0").count() == left

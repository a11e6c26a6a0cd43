"""Spelling variants, exact top-k and importance resampling against brute force and their oracles."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from pulseframe.llm import exact_top_k, importance_resampling, spelling_variants

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def same_as_oracle(spark, sf, module, tables):
    got = module.query(spark, sf)
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    res = con.execute(module.ORACLE)
    order = [got.columns.index(d[0]) for d in res.description]
    rows = [tuple(r[k] for k in order) for r in got.collect()]
    assert len(rows) and sorted(rows, key=repr) == sorted(res.fetchall(), key=repr)


# ---- spelling variants ---------------------------------------------------------------------

def edits(a, b):
    """One code point inserted, deleted or replaced, by trying every place."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def expected_variants(words):
    near_of = {w: [v for v in words if edits(w, v)] for w in words}
    form = {}
    for w, near in near_of.items():
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near_of[w]), words.get(form[w])))
    return sorted(out, key=repr)


def some_words(seed, stems, copies, alphabet="abcdeé"):
    rng = random.Random(seed)
    words = {}
    for _ in range(stems):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9)))
        n = 5 ** rng.randint(0, 8) * rng.randint(1, 4)
        words[word] = n
        for _ in range(copies):
            k = rng.randrange(len(word))
            word = rng.choice([word[:k] + word[k + 1:], word[:k] + rng.choice(alphabet) + word[k:], word[:k] + rng.choice(alphabet) + word[k + 1:]]) or "a"
            n = max(1, n // rng.choice([2, 5, 6]))
            words.setdefault(word, n)
    return words


def test_near_is_one_edit():
    words = list(some_words(1, 30, 6))
    assert all(spelling_variants.near(a, b) == edits(a, b) for a in words for b in words)


def test_trie_searches_find_every_near_word():
    words = list(some_words(3, 40, 8))
    for top in (0, 3, 19):
        trie = spelling_variants.Trie(top, spelling_variants.GROUPS)
        for w in words:
            trie.add((spelling_variants.vector(w), w, 1))
        for w in words:
            found = [x[1] for x in trie.search(spelling_variants.vector(w), w)]
            c = spelling_variants.vector(w)[:top]
            at_top = [v for v in words if edits(w, v)]
            assert len(found) == len(set(found)) and set(found) <= set(at_top)
            assert top or sorted(found) == sorted(at_top)
            assert set(found) >= {v for v in at_top if spelling_variants.vector(v)[:top] == c}


@pytest.mark.parametrize("block", [50_000, 40, 3])
def test_variants_equal_brute_force_in_one_or_many_blocks(spark, block):
    words = some_words(5, 60, 7) | {"é" * 5000: 9, "é" * 4999: 900, "é" * 4998 + "a": 3, "": 4, "anagram": 50, "nagaram": 50}
    frame = spark.createDataFrame([(w, n, "clash", 1) for w, n in words.items()], "word string, n long, form string, key int")
    got = spelling_variants.variants(spark, frame, block=block)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_variants(words)


def test_a_key_of_many_words_is_split_and_loses_no_pair(spark):
    letters = [chr(97 + k) for k in range(20)]
    words = {"".join(random.Random(k).sample(letters, 20)): 1 + k for k in range(300)}  # one vector
    first = min(words)
    words |= {first[:k] + first[k + 1:]: 9 for k in range(20)} | {first[:k] + "z" + first[k + 1:]: 3 for k in range(20)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted((tuple(r) for r in spelling_variants.variants(spark, frame, block=30).collect()), key=repr) == expected_variants(words)


def test_chains_follow_to_the_last_form(spark):
    words = {"a" * (6 + k): 5 ** k for k in range(12)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: r.root for r in spelling_variants.variants(spark, frame).collect()}
    assert set(got.values()) == {"a" * 17}


def test_misspelt_words_on_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    exp = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            exp[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    got = {r.word: r.n for r in spelling_variants.misspelt_words(odd).collect()}
    assert got == {w: n for w, n in exp.items() if len(w) >= 6 and n >= 5}
    assert spelling_variants.variants(spark, spelling_variants.misspelt_words(empty)).count() == 0


def test_variants_query_equals_its_oracle(spark, sf):
    same_as_oracle(spark, sf, spelling_variants, ["documents"])


# ---- exact top-k ---------------------------------------------------------------------------

def expected_top(rows, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (qi, q) in enumerate(usable):
        if qi is None or qi % 50:
            continue
        scores = sorted((-max(min(sum(x * y for x, y in zip(q, v)), 2 ** 63 - 1), -2 ** 63), i is None, i) for b, (i, v) in enumerate(usable) if a != b)[:k]
        out += [(qi, r + 1, i, -s) for r, (s, _, i) in enumerate(scores)]
    return sorted(out, key=repr)


def vectors(seed, n, dims=7):
    rng = random.Random(seed)
    rows = [(k, [rng.choice([0.0, 0.0, rng.uniform(-1, 1)]) for _ in range(dims)]) for k in range(n)]
    rows += [(50, rows[3][1]), (50, rows[3][1]), (1, rows[3][1]), (None, rows[5][1]), (None, None), (100, None), (200, [None, 1.0]),
             (250, [float("nan")]), (300, [float("inf")]), (350, []), (400, [1.0]), (450, [0.5] * 40), (-50, [0.25, -0.001])]
    return rows


@pytest.mark.parametrize("sizes", [(32_768, 32_768, 4096), (2, 9, 4)])
def test_top_k_equals_brute_force_in_one_or_many_blocks(spark, sizes):
    rows = vectors(4, 210)
    frame = spark.createDataFrame([(*r, 1, "clash") for r in rows], "vec_id long, embedding array<double>, row int, cell string")
    for k in (5, 400):
        got = exact_top_k.search(spark, exact_top_k.quantised(frame), exact_top_k.F.col("vec_id") % 50 == 0, k, *sizes)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_top(rows, k)


def test_scores_beyond_doubles_stay_exact(spark):
    rows = [(0, [3e6, 1.0, 1e6]), (1, [3e10, 0.25, 7.0]), (2, [3e10, 0.5, 7.0]), (50, [1e12, 3.0, 1.0]), (3, [1e300]), (4, [-1e300])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = exact_top_k.search(spark, exact_top_k.quantised(frame), exact_top_k.F.col("vec_id") % 50 == 0, 5)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_top(rows, 5)


def test_top_k_of_ties_few_rows_and_empty_tables(spark):
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(60)], "vec_id long, embedding array<float>")
    ask = lambda df: exact_top_k.search(spark, exact_top_k.quantised(df), exact_top_k.F.col("vec_id") % 50 == 0)
    got = sorted(tuple(r)[:3] for r in ask(same).collect())
    assert got == sorted([(0, r, r) for r in range(1, 6)] + [(50, r + 1, r) for r in range(5)])
    assert [tuple(r)[:3] for r in ask(same.filter("vec_id < 2")).collect()] == [(0, 1, 1)]
    assert ask(same.filter("vec_id = 0")).count() == 0 and ask(same.limit(0)).count() == 0


def test_top_k_query_equals_its_oracle(spark, sf):
    same_as_oracle(spark, sf, exact_top_k, ["embeddings"])


# ---- importance resampling -----------------------------------------------------------------

def expected_resampling(docs, target, longest=1, percent=10):
    def features(text):
        ws = WORD.findall((text or "").translate(LOWER))
        return len(ws), [" ".join(ws[k:k + n]) for n in range(1, longest + 1) for k in range(len(ws) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(bucket, features(x)[1]))
    for x in target:
        t.update(map(bucket, features(x)[1]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))))
    out, drawn = [], []
    for i, x in docs:
        n, fs = features(x)
        w = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        row = (i, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))))
        (drawn if n >= 20 else out).append(row)
    drawn.sort(key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    out = [(*r, None) for r in out]
    out += [(*r, k + 1 if k < percent * len(drawn) // 100 else None) for k, r in enumerate(drawn)]
    return sorted(out, key=repr)


def test_resampling_equals_brute_force_on_odd_rows(spark, odd, empty):
    rng = random.Random(8)
    more = [(rng.choice([k, -k, 7, None]), " ".join(rng.choice(["Alpha", "beta", "ÉTÉ", "x9"]) for _ in range(rng.randint(15, 60)))) for k in range(120)]
    docs = odd.select("doc_id", "text", "id", "t").unionByName(spark.createDataFrame([(*r, 1, "c") for r in more * 2], "doc_id long, text string, id int, t string"))
    target = spark.createDataFrame([("a", "beta beta x9"), (None, None), ("b", "unseen words")], "item_id string, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for longest, part_rows in ((1, None), (3, 17)):
        got = importance_resampling.resample(spark, docs, target, longest=longest, percent=50, part_rows=part_rows)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_resampling(rows, ["beta beta x9", None, "unseen words"], longest, 50)
    assert importance_resampling.resample(spark, empty, target).count() == 0
    none = importance_resampling.resample(spark, docs, target.limit(0))
    assert sorted((tuple(r) for r in none.collect()), key=repr) == expected_resampling(rows, [])


@pytest.mark.parametrize("digit_bits", [16, 5])
def test_radix_ranks_equal_a_sort(spark, digit_bits):
    rng = random.Random(digit_bits)
    rows = [(rng.choice([7, rng.randint(-50, 50), rng.randint(-2 ** 40, 2 ** 40)]), rng.choice([None, 3, -2 ** 63, 2 ** 63 - 1, rng.randint(0, 9)])) for _ in range(700)]
    frame = spark.createDataFrame(rows, "a long, b long").repartition(5)
    got = importance_resampling.radix_ranks(spark, frame, [("a", False), ("b", True)], digit_bits, part_rows=64).collect()
    assert sorted(r.pos for r in got) == list(range(700))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.pos)] == sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))


def test_one_value_of_most_rows_is_dealt_over_equal_parts(spark):
    frame = spark.range(5000).selectExpr("CAST(5 AS BIGINT) AS a", "id AS b").repartition(3)
    got = importance_resampling.radix_ranks(spark, frame, [("a", True), ("b", True)], part_rows=300)
    assert got.filter("pos <> b").count() == 0


def test_draws_favour_the_target(spark):
    docs = spark.createDataFrame([(k, ("sea wind " if k % 4 == 0 else "desk pen ") * 20) for k in range(400)], "doc_id long, text string")
    target = spark.createDataFrame([("1", "sea wind sea wind")], "item_id string, text string")
    drawn = importance_resampling.resample(spark, docs, target).filter("rank IS NOT NULL").collect()
    assert len(drawn) == 40 and all(r.doc_id % 4 == 0 for r in drawn)
    by = defaultdict(int)
    for r in drawn:
        by[r.rank] += 1
    assert sorted(by) == list(range(1, 41))


def test_resampling_query_equals_its_oracle(spark, sf):
    same_as_oracle(spark, sf, importance_resampling, ["documents", "benchmark"])

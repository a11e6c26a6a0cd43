"""Personal data and benchmark decontamination against brute force."""

import hashlib
import random
import re

from pulseframe.llm import decontaminate, pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def base(text):
    return [f"{k}:{s}:{e}" for s, e, k, _ in pii.spans_of(text) if k in pii.BASE]


def test_base_spans_equal_the_patterns_on_random_texts():
    rng = random.Random(5)
    parts = ["@", ".", "a", "b-", "_", "%", "1", "25", "255", "256", "+", " ", "-", "(", ")", "é", "4539578763621486", "00", "\n", "x@y.z", "10.0.0.1", "+1 (555) 123-4567"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert base(text) == brute(text), text


def test_checksums_and_context():
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765431")
    kinds = lambda t: [s[2] for s in pii.spans_of(t)]
    assert kinds("iban GB82 WEST 1234 5698 7654 32.") == ["iban"] and kinds("GB82 WEST 1234 5698 7654 31") == []
    assert kinds("ssn: 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == [] and kinds("ssn 000-45-6789") == []
    near, far = (pii.spans_of(t)[0][3] for t in ("my card 4539578763621486", "see 4539578763621486"))
    assert near > far >= pii.MIN_SCORE


def test_account_numbers_before_upper_case_words_and_numbers():
    de, gb = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    for text, exp in ((f"IBAN {de.replace(' ', '')} BIC COBADEFF", [de.replace(" ", "")]), (f"IBAN {de} BIC COBADEFFXXX", [de]),
                      (f"{gb} USA", [gb]), (f"{de.replace(' ', '')} 2024", [de.replace(" ", "")]), (f"{de} {gb} X1", [de, gb]),
                      (f"AB12 {de} OK", [de]), (f"{de}, {gb}.", [de, gb]), (f"{de}x", []), (f"{gb[:-1]}3 USA", [])):
        assert [text[s:e] for s, e, k, _ in pii.spans_of(text) if k == "iban"] == exp, text
    assert pii.redacted(f"IBAN {de} BIC COBADEFFXXX") == "IBAN [IBAN] BIC COBADEFFXXX"
    pii.spans_of("GB82 " * 40_000)


def test_secrets_by_form_name_and_look():
    key, hub, hexed = "AKIA" + "Q7ZK3M5N8P2R4T6W", "ghp_" + "a1B2c3D4e5F6g7H8i9J0" * 2, "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    pem = "-----BEGIN RSA PRIVATE KEY-----\nMIIEow\n-----END RSA PRIVATE KEY-----"
    for text, exp in ((f"id {key}.", [key]), (f"x{key}", []), (f"{hub}, ok", [hub]), (f"see\n{pem}\nafter", [pem]), (pem[:40], [pem[:31]]),
                      (f'token = "{hexed}"', [hexed]), (f'TOKEN = "{hexed.upper()}"!!', [hexed.upper()]), ("password: hunter42!", ["hunter42"]),
                      ("password: forgotten", []), ("password: 12345678", []), ("the token: aaaaaaaaaaaaaaaaaaaa", []), ("secret = meeting at noon", []),
                      (f"commit {hexed} of the tree", []), (f"my api key is {hexed}", [hexed]), ("a-very-long-hyphenated-heading-without-any-digit", []),
                      (f"password={hexed} and token={key}", [hexed, key]), ("tokens: 16 characters", [])):
        assert [text[s:e] for s, e, k, _ in pii.spans_of(text) if k == "secret"] == exp, text
    assert pii.redacted(f'token = "{hexed}"!') == 'token = "[SECRET]"!'
    assert pii.entropy("aabb") == 1.0 and not pii.looks_random("1234567890123456")


def test_long_runs_take_linear_time():
    for text in ("token=" * 30_000, "-----BEGIN PRIVATE KEY-----" * 5_000, "a1" * 100_000, "AKIA" * 50_000, "ghp_" + "a" * 200_000, "pwd:" + "=" * 100_000,"1" * 200_000, "a" * 200_000 + "@", "@" * 50_000, "+" * 50_000, "1 " * 100_000, "1." * 100_000, "A" * 100_000 + "GB82" * 20_000):
        pii.spans_of(text)


def test_find_and_redact_on_odd_rows(spark, odd, empty):
    found = pii.find(odd).collect()
    assert len(found) == odd.count() and all(r.spans == [] for r in found if r.id != 8)
    masked = pii.redact(spark.createDataFrame([(1, "to a@b.co, ip 10.0.0.1", 3), (2, None, 4)], "doc_id long, text string, spans int"))
    assert [tuple(r) for r in masked.sort("doc_id").collect()] == [(1, "to [EMAIL], ip [IP]", 3), (2, None, 4)]
    assert pii.redact(odd).schema == odd.schema and pii.redact(odd).count() == odd.count()
    assert pii.find(empty).count() == 0 and pii.redact(empty).count() == 0


def test_pii_query_over_the_whole_table(spark, sf):
    got = {r.doc_id: r for r in pii.query(spark, sf).collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(texts)
    for r in texts:
        exp = brute(r.text or "")
        assert got[r.doc_id].base_sha256 == hashlib.sha256(",".join(exp).encode()).hexdigest()
        assert set(exp) <= set(got[r.doc_id].spans.split(",")) | {""}
        assert (got[r.doc_id].n_email, got[r.doc_id].n_card) == tuple(sum(s.startswith(k) for s in exp) for k in ("email", "card"))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def leaks(texts, items, size=10):
    """{key: (words, hit, items)} by comparing every window with every place."""
    windows = {}
    for i, t in items:
        ws = WORD.findall((t or "").translate(LOWER))
        for k in range(max(1, len(ws) - size + 1) if ws else 0):
            windows.setdefault(tuple(ws[k:k + size]), set()).update([] if i is None else [str(i)])
    sizes = {len(w) for w in windows}
    out = []
    for key, t in texts:
        ws = WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(ws) - n + 1):
                if (w := tuple(ws[k:k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[w]
        out.append((key, len(ws), len(hit), len(found), sorted(found)))
    return sorted(out, key=repr)


ITEMS = [(1, "one two three"), (2, None), (3, "..."), (3, "same text of six"), (30, "a b c d e f g h i j k l"), (4, "d e f g h i j k l m"), (None, "x"), (1, "one two three")]
TEXTS = [(20, "One two THREE, one two three four"), (21, "z a b c d e f g h i j-k l m n"), (22, "one two threes"), (23, "É one two three"), (24, "ones two three two three")]


def test_decontamination_equals_brute_force(spark, odd, empty):
    docs = odd.select("doc_id", "text", "t", "n").unionByName(spark.createDataFrame([(*r, "t", 1) for r in TEXTS], "doc_id long, text string, t string, n int"))
    items = spark.createDataFrame([(*r, 5) for r in ITEMS], "item_id long, text string, id int")
    exp = leaks([(r.doc_id, r.text) for r in docs.collect()], ITEMS)
    for shard in (16_000_000, 60):  # one automaton, and many that pass in turn
        got = decontaminate.scan(spark, docs, items, shard_chars=shard)
        assert sorted(((r.id, r.n_words, r.n_hit, r.n_items, r.items) for r in got.collect()), key=repr) == exp
        kept = decontaminate.clean(spark, docs, items, shard_chars=shard)
        assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in exp if not r[2]), key=repr)
        assert kept.columns == docs.columns
    spans = {r.id: [tuple(s) for s in r.spans] for r in decontaminate.scan(spark, docs, items).collect()}
    text = dict(TEXTS)[23]
    assert [text[s:e] for s, e in spans[23]] == ["one two three"] and spans[20] == [(0, 28)]
    # the item without an id, "x", hits as others do
    assert exp[[r[0] for r in exp].index(4)][1:] == (1, 1, 0, [])
    assert decontaminate.scan(spark, empty, items).count() == 0
    assert decontaminate.clean(spark, docs, items.limit(0)).count() == docs.count()


def test_decontamination_query(spark, sf):
    got = decontaminate.query(spark, sf).collect()
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    exp = leaks([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in items])
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in got) == sorted(e[:4] for e in exp)
    sha = {e[0]: hashlib.sha256(",".join(e[4]).encode()).hexdigest() for e in exp}
    assert all(r.items_sha256 == sha[r.doc_id] and r.contaminated == (r.n_hit > 0) for r in got)
    assert any(r.contaminated for r in got)
    texts = {r.doc_id: r.text for r in docs}
    for r in got:
        spans = [tuple(map(int, s.split(":"))) for s in r.spans.split(",") if s]
        assert sum(len(WORD.findall(texts[r.doc_id][s:e].translate(LOWER))) for s, e in spans) == r.n_hit
        assert all(e1 < s2 for (_, e1), (s2, _) in zip(spans, spans[1:]))

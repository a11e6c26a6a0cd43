"""Chat formatting and the license join against plain Python."""

import hashlib

import duckdb

from pulseframe.llm import chat_format, license_join
from pulseframe.llm.common import written
from pulseframe.llm.license_join import PHRASES, TEMPLATES

TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "\\### Assistant: </turn>\n ok \\b \\e"), (1, 2, "user", None),
    (2, 0, "system", ""), (2, 1, "user", "### User: x</turn>"), (3, 0, "assistant", "a"), (3, 1, "assistant", "b###</turn"),
    (4, 0, None, "no role"), (4, None, "tool: x\n", "\\"), (5, 1, "user", "tie"), (5, 1, "user", "tie"), (5, 1, "assistant", "é😀"),
    (None, 0, "user", "null id"), (None, 1, "assistant", "w " * 50_000), (6, 0, "=user", "x"), (6, 1, "User", "y"),
]


def expected(rows):
    convs = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for k, r in enumerate(sorted(rows, key=key)):
        convs.setdefault((r[0], k if r[0] is None else None), []).append((r[2] or "", r[3] or ""))
    out = []
    for (c, _), turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.append((c, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 9) for r in rows], "conv_id long, turn long, role string, text string, s string, example int")


def test_round_trip_of_control_strings_nulls_ties_and_long_texts(spark):
    got = chat_format.digest(chat_format.format_examples(frame(spark, TURNS))).collect()
    assert sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got), key=repr) == expected(TURNS)
    assert sum(r.conv_id is None for r in got) == 2  # rows without an id do not meet


def test_an_example_per_assistant_turn_with_only_that_reply_trainable(spark):
    got = chat_format.format_examples(frame(spark, [r for r in TURNS if r[0] in (1, 3)])).collect()
    by = {(r.conv_id, r.example): r for r in got}
    assert len(by) == 4
    first, second = by[3, 0], by[3, 1]
    assert first.text == "### Assistant: a</turn>\n" and second.text == first.text + "### Assistant: b\\h</turn</turn>\n"
    assert second.text[second.loss_start:second.loss_start + second.loss_length] == "b\\h</turn"
    assert by[1, 1].loss_length == 0 and by[1, 1].is_last  # turns after the last reply are context alone


def test_empty_conversations(spark):
    assert chat_format.digest(chat_format.format_examples(frame(spark, TURNS[:0]))).count() == 0


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(c if ord(c) >= 128 or "0" <= c <= "9" or "a" <= c <= "z" else " " for c in low).split(" ") if w]


def pairs(ws, threshold=0.8):
    """{(label, containment, told)} of every window against every template."""
    sets = [(label, words(text)) for label, text in TEMPLATES]
    out = set()
    for label, tokens in sets:
        t, slack = set(tokens), -(-len(tokens) // 4)
        for start in range(0, len(ws), slack + 1):
            block = set(ws[start:start + len(tokens) + slack])
            common = block & t
            if len(common) >= threshold * len(t) - 1e-9:
                told = not any(o != label and common <= set(ot) and (t - set(ot) or len(set(ot) & block) * len(t) >= len(common) * len(set(ot))) for o, ot in sets)
                out.add((label, start, round(len(common) / len(t), 9), told))
    return out


def brute(text):
    ws = words(text)
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(ws)) if ws[i:i + len(p.split())] == p.split()]
    told = [(label, c) for label, _, c, ok in pairs(ws) if ok]
    base = sorted({label for _, label in places})
    return (len(ws), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(base), ",".join(sorted({*base, *(label for label, _ in told)})), max([1.0 * bool(places), *(c for _, c in told)]))


LICENSES = [
    (10, "CC BY cc-by CC\nBY. All rights reserved", "en", "a"), (11, "x\nCopyright. Reserved rights, ALL of them\ny", "en", "a"),
    (12, "Licensed to you under the Apache License version 2.0: you may not use the file except with the License in compliance", "en", "a"),
    (13, "general public license general public license", "en", "a"), (14, "accc by", "en", "a"),
    (15, "licensed under\nCC BY-NC 4.0", "en", "a"), (16, "Licensed, under CC  BY-NC (4.0) ok", "en", "a"), (17, "Éall rights reserved", "en", "a"),
]


def test_license_join_equals_brute_force(spark, odd):
    docs = spark.createDataFrame([(*r, 0, "t", 0, "h") for r in LICENSES], odd.schema).unionByName(odd)
    got = license_join.scan(spark, docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    exp = sorted(((i, *brute(t)) for i, t in rows), key=repr)
    assert sorted(((*tuple(r)[:-1], round(r.score, 9)) for r in got), key=repr) == exp
    assert len({r[6] for r in exp}) > 3


def test_license_filters_lose_no_pair_at_other_thresholds(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = "\n".join(t for _, t in license_join.TEMPLATES)
    docs = docs.limit(0).select("doc_id", "text").unionByName(
        spark.createDataFrame([(k, " ".join(text.split()[k % 40:k % 40 + k % 23 + 2])) for k in range(300)], "doc_id long, text string"))
    vocabulary = license_join.strings(sorted({w for t in license_join.template_list() for w in t.words}))
    F = license_join.F
    rows = written(spark, license_join.worded(docs).withColumn("held", F.array_intersect(F.split("norm", " "), vocabulary)), "license-test")
    for threshold in (0.3, 0.6, 1.0):
        found = license_join.template_pairs(rows, threshold=threshold).join(rows, "row").collect()
        got = {(r.doc_id, r.label, r.start, round(r.containment, 9), r.told) for r in found}
        assert got == {(r.doc_id, *p) for r in docs.collect() for p in pairs(words(r.text), threshold)} and got


def test_oracles_on_the_given_tables(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for module in (chat_format, license_join):
        got = module.query(spark, sf)
        res = con.execute(module.ORACLE)
        order = [got.columns.index(d[0]) for d in res.description]
        assert sorted((tuple(r[k] for k in order) for r in got.collect()), key=repr) == sorted(res.fetchall(), key=repr)


def test_license_empty_table(spark, empty):
    assert license_join.scan(spark, empty).count() == 0


def test_one_line_notices_get_their_own_label(spark):
    lines = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
             "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa", "Licensed under CC BY-ND 4.0.": "cc-by,cc-by-nd", "Licensed under CC BY 4.0.": "cc-by",
             "This work is licensed under the GNU General Public License, version 3.": "gpl", "Licensed under the Mozilla Public License, Version 2.0": "mpl-2.0",
             "Licensed under the Apache License 2.0": "apache-2.0", "Released under the BSD License": "bsd", "Released under the Foo License": "", "Licensed under the Foo License, Version 2.0": ""}
    docs = spark.createDataFrame([(k, f"before\n{line}\nafter") for k, line in enumerate(lines)], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in license_join.scan(spark, docs).collect()} == dict(enumerate(lines.values()))


def test_wrapped_short_and_strewn_notices(spark):
    mit = next(text for label, text in TEMPLATES if label == "mit")
    lines = {
        "Use under the MIT License": "mit", "SPDX-License-Identifier: MIT": "mit", "// SPDX-License-Identifier: EPL-2.0": "",
        "Distributed under the terms of the Apache License, Version 2.0": "apache-2.0",
        "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software\n# and associated documentation files": "mit",
        "Licensed\nunder CC\nBY-NC 4.0": "cc-by,cc-by-nc", "Licensed under CC BY-NC-SA 4.0": "cc-by,cc-by-nc-sa",
        "Licensed under the MIT License or\nLicensed under the Apache License 2.0": "apache-2.0,mit",
        "The license plate was found under the bridge; an MIT student licensed the photo": "",
        "in the 2.0 meeting the public was licensed under oath and Mozilla gave a license": "",
        "He was licensed under the new license": "", "CC BY-NC 4.0 licensed": "cc-by,cc-by-nc", mit: "mit"}
    docs = spark.createDataFrame([(k, f"some words before\n{line}\nand some after") for k, line in enumerate(lines)], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in license_join.scan(spark, docs).collect()} == dict(enumerate(lines.values()))

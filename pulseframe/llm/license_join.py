r"""License scans: base phrases, and an exact set-similarity join with license templates.

DataFrame functions only.  Texts are lower-cased (A-Z) and cut into words, once; the words
are written and feed all steps.

* Base: every place where a phrase's words stand consecutively, with its label.
* Method: text blocks are joined with license templates by containment,
  |block and template| >= threshold * |template| on distinct words, exactly.  The blocks of
  a template are windows of its length and a quarter more, over line ends, at every
  quarter: any run of the template's length lies within one, and a notice wrapped over
  lines is whole, but words that are strewn over a long line do not meet.
  - global order: words are ordered by the number of texts of the whole table that hold
    them, rarest first (counted by Spark for template words; no other word can be part
    of an overlap);
  - prefix filter: with required overlap o, a block that reaches it holds one of the
    template's first |T| - o + 1 words in that order, so only places of such words are
    joined, in texts that hold one;
  - length filter: a block needs at least o template words;
  - positional filter: if the rarest shared word is at place p of T and q of the block's
    template words (from 0), there are at most min(|T| - p, |B| - q) common words;
  - the pairs left are verified on the full sets.
* Choice, a second step on the pairs found: licenses share most of their words, so a pair
  gives its label unless a template of another label explains it: holds all words the pair
  matched, while those that tell the two apart are missing, or there are none and the
  other is contained in the block as well or better.  Thus "Licensed under CC BY-NC 4.0"
  is cc-by-nc alone, and "Released under the Foo License", which the notices of several
  licenses match by their common words, is none.

The templates are a parameter of bounded size (``MAX_TEMPLATE_WORDS`` in all, checked), so
the index is a small broadcast table; blocks are never paired with each other.

Null and empty texts have no words, no labels and score 0.  Repeated rows and null ids
each get their own row.  Extra columns are ignored.  An empty table gives an empty result.
``score`` is the largest containment of a template that gives a label, 1 where a base
phrase stands, else 0.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.common import LOWER, UPPER, WORD_PATTERN, normalised, table, written

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices of well-known licenses, as labels and texts; several texts may share a label.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("reserved", "Copyright All rights reserved"),
    # one-line forms
    ("apache-2.0", "Licensed under the Apache License 2.0"),
    ("apache-2.0", "Released under the Apache License 2.0"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Released under the MIT License"),
    ("bsd", "Licensed under the BSD License"),
    ("bsd", "Released under the BSD License"),
    ("gpl", "Licensed under the GNU General Public License"),
    ("gpl", "Released under the GNU General Public License"),
    ("mpl-2.0", "Licensed under the Mozilla Public License 2.0"),
    ("mpl-2.0", "Released under the Mozilla Public License 2.0"),
    ("apache-2.0", "Distributed under the terms of the Apache License, Version 2.0"),
    ("mit", "Distributed under the terms of the MIT License"),
    ("bsd", "Distributed under the terms of the BSD License"),
    ("gpl", "Distributed under the terms of the GNU General Public License"),
    ("mpl-2.0", "Distributed under the terms of the Mozilla Public License, Version 2.0"),
    # identifiers
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("bsd", "SPDX-License-Identifier: BSD-2-Clause"),
    ("gpl", "SPDX-License-Identifier: GPL-2.0"),
    ("gpl", "SPDX-License-Identifier: GPL-3.0"),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
)
THRESHOLD = 0.8
MAX_TEMPLATE_WORDS = 50_000


def n_words(norm: Column) -> Column:
    """Words of a normalised text: its spaces less one (less two where it is blank)."""
    spaces = F.char_length(norm) - F.char_length(F.replace(norm, F.lit(" "), F.lit("")))
    return F.when(norm == "  ", 0).otherwise(spaces - 1).cast("long")


class Template:
    """A license text: its label, distinct words, required overlap, block length and step."""

    def __init__(self, label: str, text: str, threshold: float):
        tokens = re.findall(WORD_PATTERN, text.translate(str.maketrans(UPPER, LOWER)))
        self.label, self.words = label, sorted(set(tokens))
        self.need = max(1, math.ceil(threshold * len(self.words) - 1e-9))
        slack = -(-len(tokens) // 4)
        self.window, self.step = len(tokens) + slack, slack + 1


def template_list(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[Template]:
    made = [t for t in (Template(label, text, threshold) for label, text in templates) if t.words]
    if sum(len(t.words) for t in made) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words in all: scan them in several calls")
    return made


def strings(values) -> Column:
    values = list(values)
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def worded(docs: DataFrame) -> DataFrame:
    """(row, doc_id, norm): the normalised text of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", normalised(text).alias("norm"))


def template_pairs(rows: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(row, t, label, start, containment, told): every block that reaches a template.

    ``rows``: written, with row, norm and ``held``, the template words of the text.
    ``told``: the pair gives its label (see the choice above).
    """
    spark, made = rows.sparkSession, template_list(templates, threshold)
    vocabulary = sorted({w for t in made for w in t.words})
    # the global order, rarest first: at most MAX_TEMPLATE_WORDS counts come back
    counts = {r["word"]: r["n"] for r in rows.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    place = {w: k for k, w in enumerate(order)}
    index, labels, rare = [], [], set()
    for k, t in enumerate(made):
        tokens = sorted(t.words, key=place.get)
        labels.append(F.struct(F.lit(t.label).alias("label"), strings(tokens).alias("tokens")))
        prefix = tokens[:len(tokens) - t.need + 1]
        rare.update(prefix)
        index += [F.struct(F.lit(k).alias("t"), F.lit(t.label).alias("label"), F.lit(t.need).alias("need"), strings(tokens).alias("tokens"),
                           F.lit(t.window).alias("window"), F.lit(t.step).alias("step"), F.lit(p).alias("p"), F.lit(w).alias("word"))
                  for p, w in enumerate(prefix)]
    if not index:
        return rows.limit(0).select("row", F.lit(0).alias("t"), F.lit("").alias("label"), F.lit(0).alias("start"), F.lit(0.0).alias("containment"), F.lit(True).alias("told"))
    prefixes = spark.range(1).select(F.inline(F.array(*index)))
    texts = rows.filter(F.arrays_overlap("held", strings(sorted(rare)))).select("row", F.split(F.expr("substring(norm, 2, length(norm) - 2)"), " ").alias("words"))
    places = texts.select("row", "words", F.posexplode("words").alias("at", "word")).filter(F.col("word").isin(sorted(rare)))
    # the blocks of the template that hold the place: starts are multiples of its step
    first = F.greatest(F.lit(0), F.ceil((F.col("at") - F.col("window") + 1) / F.col("step"))).cast("int")
    blocks = (places.join(F.broadcast(prefixes), "word")  # bounded by MAX_TEMPLATE_WORDS
              .select("row", "words", "at", "word", "t", "label", "need", "tokens", "window", "step", "p",
                      F.explode(F.sequence(first, F.floor(F.col("at") / F.col("step")).cast("int"))).alias("k"))
              .withColumn("start", F.col("k") * F.col("step"))
              .withColumn("block", F.slice("words", F.col("start") + 1, F.col("window"))).drop("words", "k")
              # a pair is verified once: at the first place in the block of its rarest shared word
              .filter(F.array_position("block", F.col("word")) == F.col("at") - F.col("start") + 1)
              .withColumn("held", F.array_intersect(strings(order), F.col("block"))))
    size, q = F.size("tokens"), F.array_position("held", F.col("word")) - 1
    near = blocks.filter((F.size("held") >= F.col("need")) & (F.least(size - F.col("p"), F.size("held") - q) >= F.col("need")))
    pairs = (near.withColumn("common", F.array_intersect("tokens", "held"))
             .filter((F.size("common") >= F.col("need")) & (F.element_at("common", 1) == F.col("word"))))
    explained = F.exists(F.array(*labels), lambda o: (o["label"] != F.col("label")) & (F.size(F.array_except("common", o["tokens"])) == 0)
                         & ((F.size(F.array_except("tokens", o["tokens"])) > 0)
                            | (F.size(F.array_intersect(o["tokens"], F.col("held"))) * size >= F.size("common") * F.size(o["tokens"]))))
    return pairs.select("row", "t", "label", "start", (F.size("common") / size).alias("containment"), (~explained).alias("told"))


def scan(spark: SparkSession, docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, phrases=PHRASES) -> DataFrame:
    """One row per document: words, base places and labels, template labels, score."""
    made = template_list(templates, threshold)
    vocabulary = sorted({w for t in made for w in t.words})
    least = min((t.need for t in made), default=1)
    base = worded(docs).withColumn("n_words", n_words(F.col("norm")))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        # consecutive places share the space between them: it stays with the later one
        parts = F.split("norm", f" {phrase}(?= )")
        hit = F.col("norm").contains(f" {phrase} ")
        spaces = lambda s: F.char_length(s) - F.char_length(F.replace(s, F.lit(" "), F.lit("")))
        counts.append(F.when(hit, F.size(parts) - 1).otherwise(0))
        firsts.append(F.when(hit, spaces(F.element_at(parts, 1))))
        lasts.append(F.when(hit, F.col("n_words") - (spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())))
        labels.append(F.when(hit, F.lit(label)))
    held = F.array_intersect(F.split("norm", " "), strings(vocabulary))
    # the words of a text, once; of texts that hold too few template words the counts alone
    rows = base.select("row", "doc_id", "n_words", reduce(lambda a, b: a + b, counts).cast("long").alias("n_base"),
                       F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
                       F.array_compact(F.array(*labels)).alias("b_labels"), "norm", held.alias("held"))
    rows = written(spark, rows.withColumn("norm", F.when(F.size("held") >= least, F.col("norm"))), "license-words")
    found = (template_pairs(rows, templates, threshold).filter("told").groupBy("row")
             .agg(F.collect_set("label").alias("t_labels"), F.max("containment").alias("t_score")))
    sorted_labels = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    return rows.drop("norm", "held").join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", sorted_labels(F.col("b_labels")).alias("base_labels"),
        sorted_labels(F.concat("b_labels", F.coalesce("t_labels", strings([])))).alias("labels"),
        F.greatest(F.coalesce("t_score", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, table(spark, sf_dir, "documents"))


def oracle(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """Brute force, from the templates' texts: every window against every template on the
    full word sets; labels by comparing all templates in the window."""
    values = ", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(templates))
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES.items())
    cut = lambda text: f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '{WORD_PATTERN}')"
    return rf"""
WITH given(t, label, text) AS (VALUES {values}),
tpl AS (SELECT t, label, list_distinct(ws) AS ws, len(list_distinct(ws)) AS size, len(ws) + CAST(ceil(len(ws) / 4) AS BIGINT) AS width,
               CAST(ceil(len(ws) / 4) AS BIGINT) + 1 AS step FROM (SELECT t, label, {cut('text')} AS ws FROM given)),
phrase(p, label, k) AS (VALUES {phrases}),
w AS (SELECT row_number() OVER () AS r, doc_id, {cut("coalesce(text, '')")} AS ws FROM documents),
places AS (
  SELECT r, label, i - 1 AS place FROM (SELECT r, ws, unnest(generate_series(1, len(ws))) AS i FROM w) x, phrase
  WHERE array_to_string(ws[i:i + k - 1], ' ') = p),
base AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY r),
likely AS (SELECT w.r, tpl.t, tpl.label, tpl.size, w.ws, tpl.ws AS tw, width, step FROM w, tpl
           WHERE len(list_intersect(w.ws, tpl.ws)) >= {threshold} * size - 1e-9),
windows AS (SELECT r, t, label, size, tw, ws[s + 1:s + width] AS block FROM (SELECT *, unnest(range(0, len(ws), step)) AS s FROM likely)),
pairs AS (SELECT *, list_intersect(tw, block) AS common FROM windows WHERE len(list_intersect(tw, block)) >= {threshold} * size - 1e-9),
told AS (
  SELECT r, label, len(common) / size AS c FROM pairs p WHERE NOT EXISTS (
    SELECT 1 FROM tpl o WHERE o.label <> p.label AND len(list_intersect(p.common, o.ws)) = len(p.common)
      AND (len(list_intersect(p.tw, o.ws)) < p.size OR len(list_intersect(o.ws, p.block)) * p.size >= len(p.common) * o.size))),
tl AS (SELECT r, list(DISTINCT label) AS labels, max(c) AS score FROM told GROUP BY r)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(tl.labels, [])))), ',') AS labels,
  CAST(greatest(coalesce(tl.score, 0), CASE WHEN n_base > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN tl USING (r)
"""


ORACLE = oracle()

"""Classifiers by held-out accuracy; adaptive rules against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from pulseframe.llm import adaptive_rules, pu_quality, toxicity
from pulseframe.llm.common import drawn


def auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    return float(np.mean([np.mean((s > scores[labels == 0]) + 0.5 * (s == scores[labels == 0])) for s in scores[labels == 1]]))


def test_quality_held_out_accuracy(spark, sf):
    got = pu_quality.query(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert auc([r.score for r in rows], [r.quality for r in rows]) > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.collect())


def test_non_negative_risk_and_prior_on_a_known_mixture():
    rng = np.random.default_rng(1)
    positive = rng.normal(1.5, 1, (4000, 3))
    unlabelled = np.vstack([rng.normal(1.5, 1, (2400, 3)), rng.normal(-1.5, 1, (1600, 3))])
    w, mean, scale, prior = pu_quality.fit(positive, unlabelled)
    assert abs(prior - 0.6) < 0.08
    s = pu_quality.sigmoid(pu_quality.expand(unlabelled, mean, scale) @ w)
    assert np.mean((s >= 0.5) == (np.arange(4000) < 2400)) > 0.97


def test_no_label_of_a_held_out_row_is_learnt(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumns({c: F.when(pu_quality.held_out(F.col("doc_id")), 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    for module in (pu_quality, toxicity):
        one, two = (module.score(docs, module.train(docs, x)).sort("doc_id").collect() for x in (labels, flipped))
        assert np.allclose([r.score for r in one], [r.score for r in two], atol=1e-9)


def test_models_on_odd_and_empty_tables(spark, odd, empty):
    labels = spark.createDataFrame([(k, k % 2, k % 3 % 2, "x") for k in (4, 6, 7, 8, 10)] + [(None, 1, 1, "x"), (9, None, None, "x")],
                                   "doc_id long, quality int, toxic int, t string")
    for module in (pu_quality, toxicity):
        for some in (labels, labels.limit(0)):
            scored = module.score(odd, module.train(odd, some)).collect()
            assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
            assert len({round(r.score, 9) for r in scored if r.doc_id == 5}) == 1  # repeated rows score alike
        assert module.score(empty, module.train(empty, labels)).count() == 0
    kept = pu_quality.reject(odd, None)
    assert kept.schema == odd.schema and kept.count() == odd.count()


def test_toxicity_held_out(spark, sf):
    rows = toxicity.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.02
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.6
    assert auc([r.severity for r in rows], [r.toxic for r in rows]) > 0.85


def test_a_draw_is_bounded_by_rows_and_independent_of_their_order(spark):
    rows = [(7, "the one text")] * 3000 + [(8, f"another text {k}") for k in range(50)] + [(None, "no id")] * 20 + [(k, f"t{k}") for k in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(7, 1), (8, 1), (100, 0)], "doc_id long, y int")
    for most in (1, 40, 100, 3049, 10_000):
        got = drawn(docs, most, 5, known).collect()
        assert sum(r.copies for r in got) == min(most, 3051) and len({(r.doc_id, r.t) for r in got}) == len(got)
        assert sorted(map(repr, got)) == sorted(map(repr, drawn(docs.repartition(7), most, 5, known).collect()))
    assert sum(r.copies for r in drawn(docs, 100, 5).collect()) == 100


def test_models_learn_from_bounded_rows_when_one_id_holds_most(spark, monkeypatch):
    rows = [(1, "good words here, all fine.")] * 3000 + [(k, f"plain words {k}, fine ones. " * 3 if k % 2 else "vile $$ !! " * 9) for k in range(2, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)] * 50 + [(k, k % 2, 1 - k % 2) for k in range(2, 300)], "doc_id long, quality int, toxic int")
    seen = {}
    quality_fit, ordinal_fit = pu_quality.fit, toxicity.fit_ordinal
    monkeypatch.setattr(pu_quality, "fit", lambda p, u, **k: seen.update(p=len(p), u=len(u)) or quality_fit(p, u, steps=5))
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda x, width, y: seen.update(n=x.n, toxic=int((y > 0).sum())) or ordinal_fit(x, width, y, steps=5))
    assert pu_quality.train(docs, labels, max_rows=100) is not None and seen["p"] == 100 and seen["u"] == 100
    assert toxicity.train(docs, labels, max_rows=60) is not None and seen["toxic"] <= 60 and seen["n"] <= 180


def naive_features(text):
    """The quality features counted one by one."""
    data = text.encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
    n, size = max(1, len(words)), max(1, len(data))
    grams = Counter(zip(words, words[1:], words[2:]))
    again = {p for k in range(len(words) - 2) if grams[tuple(words[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [s for s in data.split(b"\n") if s.strip()]
    of = lambda chars: sum(c in chars for c in data)
    distinct = set(words)
    return [np.log1p(len(words)) / 10, sum(len(w) for w in words) / n / 20, min(3, of(b"#*$%&|<>{}[]~^=@\\/_") / n), min(3, of(b"!?") / n),
            of(bytes(range(65, 91))) / size, len(again) / n, len(distinct) / n, of(b"0123456789") / size,
            (len(lines) - len(set(lines))) / max(1, len(lines)), min(3, of(b".,;:") / n), sum(len(w) > 20 for w in distinct) / max(1, len(distinct))]


def test_quality_features_and_scores_recomputed_row_by_row(spark, odd, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.limit(150).collect() + odd.collect()
    for r in rows:
        assert np.allclose(pu_quality.features((r.text or "").encode()), naive_features(r.text or "")), r.doc_id
    model = pu_quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    w, mean, scale, _ = model
    got = {r.doc_id: r.score for r in pu_quality.score(docs, model).collect()}
    for r in rows[:150]:
        z = [max(-6.0, min(6.0, (x - m) / s)) for x, m, s in zip(naive_features(r.text or ""), mean, scale)]
        terms = [1.0, *z, *(max(-12.0, min(12.0, z[i] * z[j])) for i in range(len(z)) for j in range(i, len(z)))]
        assert abs(got[r.doc_id] - 1 / (1 + np.exp(-sum(a * b for a, b in zip(w, terms))))) < 1e-9


def descends(loss, gradient, at, eps=1e-6):
    for k in range(len(at)):
        up, down = at.copy(), at.copy()
        up[k] += eps
        down[k] -= eps
        assert abs((loss(up) - loss(down)) / (2 * eps) - gradient[k]) < 1e-5, k


def test_gradients_agree_with_finite_differences(monkeypatch):
    rng = np.random.default_rng(3)
    steps = {}
    monkeypatch.setattr(pu_quality, "adam", lambda g, width, n, rate: steps.update(g=g, width=width) or np.zeros(width))
    p, u = rng.normal(0.7, 1, (60, 2)), rng.normal(0, 1, (80, 2))
    w0, mean, scale, prior = pu_quality.fit(p, u, decay=1e-3)
    a, b = pu_quality.expand(p, mean, scale), pu_quality.expand(u, mean, scale)

    def risk(w):  # prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), logistic loss, weight decay
        negative = np.mean(np.logaddexp(0, b @ w)) - prior * np.mean(np.logaddexp(0, a @ w))
        return prior * np.mean(np.logaddexp(0, -(a @ w))) + max(0.0, negative) + 5e-4 * w @ w
    at = rng.normal(0, 0.1, steps["width"])
    assert np.mean(np.logaddexp(0, b @ at)) > prior * np.mean(np.logaddexp(0, a @ at))
    descends(risk, steps["g"](at), at)

    monkeypatch.setattr(toxicity, "adam", lambda g, width, n, rate: steps.update(g=g, width=width) or np.zeros(width))
    x = [rng.choice(4, rng.integers(0, 4), replace=False) for _ in range(50)]
    grade = rng.integers(0, 4, 50)
    toxicity.fit_ordinal(toxicity.Sparse(np.repeat(np.arange(50), [len(f) for f in x]), np.concatenate(x).astype(int), 50), 4, grade)

    def unlikely(v):  # minus the mean log-likelihood of the grades, weight decay on the weights
        theta = v[4] + np.concatenate([[0.0], np.cumsum(np.exp(v[5:]))])
        total = 0.0
        for f, g in zip(x, grade):
            above = [1.0, *(1 / (1 + np.exp(-(sum(v[k] for k in f) - t))) for t in theta), 0.0]
            total -= np.log(above[g] - above[g + 1])
        return total / 50 + 5e-5 * v[:4] @ v[:4]
    at = np.concatenate([rng.normal(0, 0.5, 4), [-1.0, 0.2, -0.3]])
    descends(unlikely, steps["g"](at), at)


def test_toxicity_scores_recomputed_row_by_row(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    weights, theta = model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for r in docs.limit(150).collect():
        lower = (r.text or "").translate({c: c + 32 for c in range(65, 91)})
        total = 0.0
        for word in set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)):
            marks = [b"w" + word.encode()] + [b"p%d" % n + word[:n].encode() for n in range(3, 8) if len(word) > n]
            total += sum(weights.get(zlib.crc32(m) % (1 << 20), 0.0) for m in marks)
        above = [1 / (1 + np.exp(-min(30, max(-30, total - t)))) for t in theta]
        assert abs(got[r.doc_id].severity - sum(above)) < 1e-9 and abs(got[r.doc_id].score - above[0]) < 1e-9


def test_thresholds_are_ordered_and_weights_shared():
    rng = np.random.default_rng(2)
    n, width = 3000, 40
    x = [sorted(set(rng.integers(0, width, 6).tolist())) for _ in range(n)]
    truth = np.where(np.arange(width) < 5, 3.0, 0.0)
    s = np.array([truth[f].sum() for f in x]) + rng.logistic(size=n)
    grade = (s > 1.5).astype(int) + (s > 5) + (s > 7.5)
    rows = toxicity.Sparse(np.repeat(np.arange(n), [len(f) for f in x]), np.array([c for f in x for c in f]), n)
    w, theta = toxicity.fit_ordinal(rows, width, grade)
    assert (np.diff(theta) > 0).all() and len(theta) == 3 and w[:5].min() > w[5:].max() + 1.5
    severity = toxicity.sigmoid(rows.dot(w)[:, None] - theta).sum(1)
    means = [severity[grade == g].mean() for g in range(4)]
    assert means == sorted(means) and means[3] - means[0] > 1.5


def test_a_grade_column_is_used_as_it_is(spark):
    docs = spark.createDataFrame([(k, f"plain words {'mild ' * (k % 3 == 1)}{'vile ' * (k % 3 == 2)}x{k}") for k in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 3) for k in range(300)], "doc_id long, grade int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert all(got[k].grade == k % 3 for k in range(300))
    assert got[0].severity < got[1].severity < got[2].severity


def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(ws, ws[1:], ws[2:]))
    hit = {p for k in range(len(ws) - 2) if grams[tuple(ws[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    n = len(ws)
    return (n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n)


def measured(rows):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows), key=repr)


def test_base_counts_on_odd_and_whole_tables(spark, odd, empty, sf):
    for docs in (odd, spark.read.parquet(f"{sf}/documents.parquet")):
        got = adaptive_rules.rules(spark, docs).collect()
        assert measured(got) == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
        assert not any(r.kept and r.base_failed for r in got)
    assert adaptive_rules.rules(spark, empty).count() == 0


def exact_fences(values, m):
    """(low, high) from exact quantiles: the least value with a share p at or below it."""
    values = sorted(values)
    q = lambda p, v: v[max(0, int(np.ceil(p * len(v) - 1e-9)) - 1)]
    low_p, low_width, high_p, high_width = adaptive_rules.TAILS[m]
    low, mid, high, spread = q(low_p, values), q(0.5, values), q(high_p, values), adaptive_rules.LEAST_SPREAD
    above = [v for v in values if v > 0]
    top = max(high_width * spread, q(adaptive_rules.LOW_TAIL, above) / 2) if high == 0 and above else high + high_width * max(high - mid, spread)
    return low - low_width * max(mid - low, spread), top


def test_fences_and_verdicts_are_those_of_exact_quantiles_within_the_error(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    # groups of 100 texts and more: sources by lang only, and one small group that uses wider ones
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 97 == 5, "rare").when(F.col("lang") == "en", F.concat(F.lit("s"), F.col("doc_id") % 2)).otherwise("x"))
    measured = adaptive_rules.measure(docs).cache()
    rows = measured.collect()
    limits = {(r.lang, r.source): r for r in adaptive_rules.thresholds(measured).collect()}
    assert limits == {(r.lang, r.source): r for r in adaptive_rules.thresholds(measured.repartition(13)).collect()}  # the same from any order
    ok = [r for r in rows if not r.base_failed]
    sizes, by_lang = Counter((r.lang, r.source) for r in ok), Counter(r.lang for r in ok)
    assert max(sizes.values()) >= 100 and min(sizes.values()) < 100 and set(limits) == set(sizes)
    kept = {(r.doc_id): r.kept for r in adaptive_rules.judge(measured, adaptive_rules.thresholds(measured)).collect()}
    for g, n in sizes.items():
        mates = [r for r in ok if n >= 100 and (r.lang, r.source) == g or n < 100 <= by_lang[g[0]] and r.lang == g[0] or max(n, by_lang[g[0]]) < 100]
        near = {}
        for m in adaptive_rules.MEASURES:
            low, high = exact_fences([r[m] for r in mates], m)
            width = adaptive_rules.TAILS[m][1] + adaptive_rules.TAILS[m][3] + 2
            slack = 1.1 * adaptive_rules.ALPHA * width * max(abs(low), abs(high), max(r[m] for r in mates if r[m] <= max(high, 0)) if mates else 0)
            assert abs(limits[g][f"{m}_low"] - low) <= slack and abs(limits[g][f"{m}_high"] - high) <= slack, (g, m)
            near[m] = (low, high, slack)
        for r in ok:
            if (r.lang, r.source) == g:
                inside = all(near[m][0] + near[m][2] <= r[m] <= near[m][1] - near[m][2] or (r[m] == 0 and near[m][0] <= 0) for m in near)
                outside = any(r[m] < near[m][0] - near[m][2] or r[m] > near[m][1] + near[m][2] for m in near)
                assert not (inside and not kept[r.doc_id]) and not (outside and kept[r.doc_id]), r


def test_quantiles_of_a_sketch_are_within_its_error(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.zeros(40), rng.lognormal(0, 3, 500), [1e-9, 1e9]])
    frame = spark.createDataFrame([("l", "s", *[float(v)] * 4, False) for v in values],
                                  "lang string, source string, symbol_ratio double, dup_line_ratio double, repeat_ratio double, mean_word_chars double, base_failed boolean")
    got = {r.m: r for r in adaptive_rules.quantiles(adaptive_rules.sketches(frame), ["lang", "source"]).collect()}
    exact = np.sort(values)
    for m, (low, _, high, _) in adaptive_rules.TAILS.items():
        for p, v in ((low, got[m].low), (0.5, got[m].mid), (high, got[m].high)):
            at = int(np.ceil(p * len(exact) - 1e-9)) - 1
            assert abs(v - exact[at]) <= 1.0001 * adaptive_rules.ALPHA * exact[at]
        above = exact[exact > 0]
        assert got[m].rows == len(values) and abs(got[m].tail / above[int(np.ceil(0.05 * len(above))) - 1] - 1) <= 1.0001 * adaptive_rules.ALPHA


def test_a_group_where_few_hold_symbols_has_a_fence_of_its_own(spark):
    def fence(strength):
        rows = [(k, "en", "g", 0.0 if k % 20 else strength * (1 + k / 4000), 0.0, 0.0, 5.0, False) for k in range(400)]
        frame = spark.createDataFrame(rows, "doc_id long, lang string, source string, symbol_ratio double, dup_line_ratio double, repeat_ratio double, mean_word_chars double, base_failed boolean")
        return adaptive_rules.thresholds(frame).first().symbol_ratio_high
    assert abs(fence(0.4) - 0.2) < 0.01 and abs(fence(3.0) - 1.5) < 0.05 and fence(0.01) == 4 * adaptive_rules.LEAST_SPREAD


def test_small_groups_use_wider_ones_and_outliers_go(spark):
    def text(k, symbol):
        return " ".join(f"w{k}x{j}{symbol}" for j in range(60))
    rows = [(k, text(k, ""), "en", "a") for k in range(150)] + [(200, text(200, "$$"), "en", "a"), (201, text(201, "$$"), "en", "rare"), (202, text(202, ""), "xx", None)]
    got = {r.doc_id: r.kept for r in adaptive_rules.rules(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [k for k, v in got.items() if not v] in ([200, 201], [201, 200])
    heavy = spark.createDataFrame([(k, text(k, "$" if k % 2 else "$$"), "en", "code") for k in range(150)], "doc_id long, text string, lang string, source string")
    assert adaptive_rules.rules(spark, heavy).filter("NOT kept").count() == 0  # the cutoff follows the source


def test_each_group_has_its_own_tail_fences(spark):
    rows = [(g, float(k % 20) / 1000 * w) for g, w in (("calm", 1), ("wild", 5)) for k in range(200)] + [("calm", 0.35), ("calm", 0.03), ("wild", 0.15)]
    frame = spark.createDataFrame([(k, "en", g, 0.0, 0.0, x, 5.0 + x, False) for k, (g, x) in enumerate(rows)],
                                  "doc_id long, lang string, source string, symbol_ratio double, dup_line_ratio double, repeat_ratio double, mean_word_chars double, base_failed boolean")
    limits = adaptive_rules.thresholds(frame)
    by = {r.source: r for r in limits.collect()}
    for g, w in (("calm", 1), ("wild", 5)):
        assert by[g].mean_word_chars_low < 5 and by[g].symbol_ratio_high == 4 * adaptive_rules.LEAST_SPREAD
        assert abs(by[g].repeat_ratio_high - (0.019 * w + 1.5 * max(0.0095 * w, 0.02))) < 0.004 * w
    assert {r.doc_id for r in adaptive_rules.judge(frame, limits).filter("NOT kept").collect()} == {400}  # the old fence, 0.4, kept it

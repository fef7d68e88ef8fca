"""Quality, toxicity and language model: held-out accuracy, sums by brute force, defined cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logilake.llm import lm_lbl, quality_qda, toxicity

SMALL = "/root/testdata/sf0.01"


def labels(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_quality_of_held_out_documents(spark):
    known = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = quality_qda.op2(spark, SMALL).join(known, "doc_id").where("held_out").toPandas()
    assert len(got) > 100
    assert (got.predicted == got.quality).mean() >= 0.97
    assert got.score.between(0, 1).all()
    assert all((zlib.crc32(str(i).encode()) % 3 == 1) for i in got.doc_id)


def test_quality_model_is_the_normal_density():
    rng = np.random.default_rng(3)
    x = [rng.normal(size=(300, 3)), rng.normal(1, 2, size=(200, 3))]
    products = np.stack([(z := np.hstack([np.ones((len(v), 1)), v])).T @ z for v in x])
    model = quality_qda.from_sums(products)
    point = np.array([[0.3, -0.2, 1.0]])

    def log_density(v, pooled):
        cov = np.cov(v.T, bias=True) * 0.9 + 0.1 * pooled
        cov = 0.9 * cov + 0.1 * np.diag(np.diag(cov)) + quality_qda.FLOOR * np.eye(3)
        d = point[0] - v.mean(axis=0)
        return -0.5 * d @ np.linalg.solve(cov, d) - 0.5 * np.linalg.slogdet(cov)[1]

    pooled = sum(len(v) * np.cov(v.T, bias=True) for v in x) / 500
    odds = log_density(x[1], pooled) - log_density(x[0], pooled) + math.log(200 / 300)
    assert model.scores(point)[0] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_quality_defined_cases(spark, documents):
    docs = documents((1, None), (2, ""), (None, "some words"), (2, ""), (5, "word " * 300_000)).withColumn("vector", F.lit(1))
    few = labels(spark, (1, 1, 0), (2, None, 0), (None, 1, 0), (4, 7, 0))
    got = quality_qda.scored(docs, few).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in quality_qda.scored(docs, few.limit(0)).collect()} == {1}
    kept = quality_qda.keep_good(docs, few)
    assert kept.columns == docs.columns and kept.count() == 5
    assert quality_qda.scored(documents(), few).count() == 0 and quality_qda.keep_good(documents(), few).count() == 0


def test_most_common_word_is_counted_over_all_words():
    words = [f"{c}{i}" for c in "am" for i in range(9500)] + ["hot"] * 1000
    at = quality_qda.FEATURES.index("most_common_word")
    for prefix in range(0, 1200, 100):  # moves the word against any even steps
        n = len(words) + prefix
        got = quality_qda.statistics(" ".join([*(f"a0{i}" for i in range(prefix)), *words]))[at]
        assert got == pytest.approx(quality_qda._share(1000, n, 0.05, quality_qda.WORDS))


def test_no_input_but_the_text(spark, documents):
    docs = documents(*((i, "Good plain words stand here.") for i in range(30)))
    known = labels(spark, *((i, i % 2, 0) for i in range(30)))
    assert len({r.score for r in quality_qda.scored(docs, known).collect()}) == 1


def test_toxicity_of_held_out_documents(spark):
    known = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = toxicity.op5(spark, SMALL).join(known, "doc_id").where("held_out").toPandas()
    clean, toxic = got[got.toxic == 0], got[got.toxic == 1]
    assert (clean.predicted == 0).mean() >= 0.98
    assert toxic.score.median() > clean.score.quantile(0.95)
    assert got.severity.between(0, toxicity.GRADES - 1).all()


def test_ordinal_regression_shares_weights_and_orders_grades():
    words = ["vile", "crude", "nasty", "awful"]
    texts = [f"plain text {' '.join(words[: i % 5])} number {i}" for i in range(400)]
    toxic = np.array([i % 5 > 0 for i in range(400)])
    found = [toxicity.Features()(t) for t in texts]
    places = np.unique(np.concatenate(found))
    counts = [np.array([sum(p in f for f in np.array(found, object)[side]) for p in places], float) for side in (toxic, ~toxic)]
    chosen = toxicity.choose(places, *counts, int(toxic.sum()), int((~toxic).sum()))
    model = toxicity.fit(chosen, [toxicity.Features(chosen)(t) for t in texts], toxic)
    assert (np.diff(model.thresholds) > 0).all()
    features = toxicity.Features(model.places)
    rows, places = toxicity._sparse([features(" ".join(["other", *words[:k]])) for k in range(5)])
    severity = model.above(np.bincount(rows, model.weights[places], 5)).sum(axis=1)
    assert (np.diff(severity) > 0).all() and severity[0] < 0.5 < severity[1]


def test_insults_that_clean_texts_use_now_and_then_are_learned(spark, documents):
    def text(i, toxic):  # one of three words, in 30 % of toxic and 2 % of other texts each
        words = ["vile", "crude", "nasty"]
        own = [w for k, w in enumerate(words) if (i + 7 * k) % 50 < (15 if toxic else 1)]
        return " ".join([f"plain number{i % 11} text{i % 13}", *own])

    rows = [(i, i % 2) for i in range(3000)]
    docs = documents(*((i, text(i // 2, t)) for i, t in rows))
    got = toxicity.score_toxicity(docs, labels(spark, *((i, 1, t) for i, t in rows))).collect()
    caught = [r.predicted for r in got if r.held_out and r.doc_id % 2]
    false = [r.predicted for r in got if r.held_out and not r.doc_id % 2]
    assert sum(caught) > 0.5 * len(caught) > 50 and sum(false) < 0.1 * len(false)


def test_toxicity_defined_cases(spark, documents):
    docs = documents((1, None), (2, ""), (None, "vile"), (2, ""), (7, "word " * 300_000)).withColumn("grade", F.lit("x"))
    none = labels(spark).limit(0)
    assert {(r.score < 0.01, r.predicted) for r in toxicity.score_toxicity(docs, none).collect()} == {(True, 0)}
    one_kind = labels(spark, (1, 1, 0), (2, 1, None), (None, 0, 1))
    assert toxicity.score_toxicity(docs, one_kind).count() == 5
    assert toxicity.score_toxicity(documents(), one_kind).count() == 0


def brute_tokens(text):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return [w for w in re.split(rb"[\x20\x09-\x0D]+", lower) if w] + ["end"]


def test_base_scores_agree_with_brute_force(spark, tiny, monkeypatch):
    monkeypatch.setattr(lm_lbl, "FREQUENT", 500)
    monkeypatch.setattr(lm_lbl, "STEPS", 200)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, t in texts.items() if not held[i] for w in brute_tokens(t))
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in lm_lbl.op4(spark, tiny).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        words = brute_tokens(text)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(words), sum(w in counts for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel=1e-9)
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_model_probabilities_are_normalised(spark, documents, monkeypatch):
    monkeypatch.setattr(lm_lbl, "STEPS", 50)
    rng = np.random.default_rng(5)
    codes = np.unique(rng.integers(0, lm_lbl.SYMBOLS**3, 5000))
    model = lm_lbl.train(codes, rng.integers(1, 50, len(codes)))
    p = 10.0 ** model.log10_probabilities().reshape(-1, lm_lbl.SYMBOLS).astype(float)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    # Within classes: known words and one share for the unknown.
    docs = documents(*((i, f"alpha beta w{i} x{i % 3}") for i in range(60)))
    counts = lm_lbl.word_counts(docs).collect()
    vocab = lm_lbl.vocabulary(lm_lbl.word_counts(docs), 60)
    head = set(vocab.words[: lm_lbl.HEAD])
    for k in {r["class"] for r in counts}:
        rest = [r.c for r in counts if r["class"] == k and r.word not in head]
        assert sum(c + 1 for c in rest) + 1 == round(10 ** vocab.log_class[k])


def test_lm_defined_cases(spark, documents, monkeypatch):
    monkeypatch.setattr(lm_lbl, "STEPS", 20)
    docs = documents((1, None), (2, " \n "), (None, "a b"), (3, "A a b"), (3, "A a b"), (6, "c " * 100_000)).withColumns(
        {"row": F.lit(1), "word": F.lit("w"), "c": F.lit(5)}
    )
    got = sorted((r.doc_id or 0, r.n_tokens) for r in lm_lbl.score_documents(docs).collect())
    assert got == [(0, 3), (1, 1), (2, 1), (3, 4), (3, 4), (6, 100_001)]
    assert lm_lbl.score_documents(documents()).count() == 0

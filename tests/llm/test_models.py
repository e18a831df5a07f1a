"""Toxicity and quality: automata against edit distance, gradients, and held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripkit.llm import quality, queries, toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


TERMS, STEMS = ["abba", "abcde", "cabbage", "abcabcabc"], ["bbc"]


@settings(max_examples=500, deadline=None)
@given(st.text("abcdeg", max_size=11))
def test_matches_are_the_words_within_reach(word):
    matcher = toxicity.Matcher(TERMS, STEMS)
    errors = {t: 2 if len(t) >= toxicity.TWO_ERRORS else 1 if len(t) >= toxicity.ONE_ERROR else 0 for t in TERMS}
    want = 1 if word in TERMS or word.startswith("bbc") else 2 if any(distance(word, t) <= e for t, e in errors.items()) else 0
    assert matcher.match(word) == want


def test_quotations_and_reports_are_told_from_abuse():
    matcher = toxicity.Matcher(["idiot", "worthless"], [])
    plain, quote, report, typo, none = (toxicity.figures(t, matcher) for t in (
        "you are an idiot, a worthless idiot", 'the line "an idiot" is printed', "the critic said it was worthless", "what an idoit or idiott", "nothing here"))
    assert plain[1] > 0 and plain[2] == 0 and plain[5] > 0
    assert quote[1] == 0 and quote[2] > 0 and report[1] == 0 and report[2] > 0
    assert typo[1] == 0 and typo[3] > 0
    assert none == [1.0, 0, 0, 0, 0, 0]
    score = {k: np.dot(v, toxicity.PRIOR) for k, v in dict(plain=plain, quote=quote, none=none).items()}
    assert score["plain"] > 0 > score["quote"] > score["none"] - 1


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    rows = []
    for k in range(900):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 60))]
        toxic = k % 7 == 0 and k % 5 > 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["zorgon", "blathead", f"mugwu{rng.choice('abcdefgh')}mp"])
        poor = k % 5 == 0
        rows.append((k, " ".join(w + "$$" for w in words[:12]) if poor else " ".join(words), int(not poor), int(toxic and not poor), "x", 1.0))
    return spark.createDataFrame(rows, "doc_id bigint, text string, quality int, toxic int, figures string, score double")


def test_toxicity_learns_words_stems_and_finds_misspellings(spark, corpus):
    seen = corpus.where("doc_id % 3 > 0")
    model = toxicity.learn(corpus.select("doc_id", "text"), seen.select("doc_id", "toxic"))
    assert {"zorgon", "blathead"} <= set(model.words) and any(s.startswith("mugw") for s in model.stems)
    scored = toxicity.score(corpus.where("doc_id % 3 = 0"), model, score_column="p").collect()
    assert all((r.p >= 0.3) == (r.toxic == 1) for r in scored) and scored[0].score == 1.0
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "a zorgn"), (2, "zorgon " * 50_000)], "doc_id bigint, text string")
    got = {r.text and r.text[:7]: r.p for r in toxicity.score(odd, model, score_column="p").collect()}
    assert got[None] == got[""] < got["a zorgn"] and got["zorgon "] > 0.9


def test_toxicity_learns_terms_that_many_others_outnumber(spark):
    """20,100 words are in every text and 2,100 in every toxic one; one telling word is in half of those."""
    rng = random.Random(6)
    common, telling = [f"{k:04x}" for k in range(20_100)], [f"zz{k:03x}" for k in range(2100)]
    rows = []
    for k in range(60):
        words = common + telling * (k % 2) + ["zorgon"] * (k % 4 == 1)
        rng.shuffle(words)
        rows.append((k, " ".join(words), k % 2))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(4)
    model = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert {"zorgon", *telling} == set(model.words) and model.stems == []


def test_toxicity_without_labels(corpus):
    docs = corpus.select("doc_id", "text")
    for labels in (corpus.limit(0), corpus.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "toxic"), corpus.selectExpr("doc_id", "CAST(NULL AS INT) AS toxic"),
                   corpus.selectExpr("doc_id", "0 AS toxic")):
        model = toxicity.learn(docs, labels.select("doc_id", "toxic"))
        assert model.words == [] and toxicity.score(docs, model).where("score < 0.3").count() == 900
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    x = rng.standard_normal(600)
    rank = np.digitize(2 * x + rng.logistic(size=600), [-2, 0, 1.5])
    weights, thresholds = quality.fit(np.zeros(600, np.int32), x, np.arange(601), rank, 4)
    assert (np.diff(thresholds) > 0).all() and weights[0] > 0.8
    tails = quality.sigmoid(weights[0] * x[:, None] - thresholds[None, :])
    assert np.abs(tails.mean(0) - [(rank > k).mean() for k in range(3)]).max() < 0.05


def test_quality_on_held_out_rows_and_odd_texts(spark, corpus):
    rated = corpus.selectExpr("doc_id", "quality * (2 - toxic) AS grade")
    model = quality.learn(corpus.select("doc_id", "text"), rated.where("doc_id % 3 > 0"))
    assert model.grades.tolist() == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    got = quality.grade(corpus.where("doc_id % 3 = 0"), model).collect()
    assert np.mean([(r.tails[0] >= 0.5) == (r.quality == 1) for r in got]) > 0.97
    assert all(r.tails[0] >= r.tails[1] and abs(r.expected_grade - sum(r.tails)) < 1e-9 for r in got)
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "x " * 100_000)], "doc_id bigint, text string")
    assert len({r.expected_grade for r in quality.grade(odd, model).collect()}) == 2
    for few in (rated.limit(0), rated.selectExpr("doc_id", "2 AS grade")):
        single = quality.learn(corpus.select("doc_id", "text"), few)
        assert {r.expected_grade for r in quality.grade(odd, single).collect()} == {float(single.grades[0])}
    assert quality.grade(odd.limit(0), model).collect() == []


def test_registered_models_on_the_driver_tables(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = queries.op4_toxicity(spark, sf_dir)
    assert toxic.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    seen = [r for r in toxic.join(labels, "doc_id").collect() if not r.held_out and r.toxic == 0]
    assert np.mean([r.predicted for r in seen]) < 0.1
    kept = queries.op9_quality_classifier(spark, sf_dir).join(labels, "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in kept if not r.held_out]) > 0.95

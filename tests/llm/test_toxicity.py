"""The chain on invented texts, held-out accuracy on the table, and the fits themselves."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import toxicity as t


def invented(spark, n=600, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = [draw.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma"]) + str(draw.randrange(40)) for _ in range(draw.randrange(30, 200))]
        rude, loud = i % 4 == 0, i % 5 == 0
        if rude:
            words[:: 20] = ["grumbl" + draw.choice(["ing", "ed", "er"])] * len(words[:: 20])
        if loud:
            words[1:: 15] = ["LOUD"] * len(words[1:: 15])
        rows.append((i, " ".join(words), int(rude), int(loud), "x"))
    return spark.createDataFrame(rows, "doc_id bigint, text string, rude int, loud int, key string")


def test_newton_finds_the_minimum():
    rng = np.random.default_rng(0)
    x, w = rng.normal(size=(500, 3)), np.array([1.0, -2.0, 0.5])
    y = (rng.random(500) < 1 / (1 + np.exp(-(x @ w)))).astype(float)
    m = t.fit_logistic(x, y)
    p = 1 / (1 + np.exp(-(x @ m[1:] + m[0])))
    assert np.abs(x.T @ (p - y) + t.RIDGE * m[1:]).max() < 1e-5


def test_later_models_see_out_of_fold_predictions(monkeypatch):
    seen = []
    real = t.fit_logistic
    monkeypatch.setattr(t, "fit_logistic", lambda x, y, **k: seen.append((x.shape, y.sum())) or real(x, y, **k))
    rng = np.random.default_rng(0)
    labels = (rng.random((90, 2)) < 0.5).astype(float)
    t.fit_chain([rng.normal(size=(90, 2)), rng.normal(size=(90, 3))], labels, np.arange(90) % 3)
    assert [shape for shape, _ in seen] == [(90, 2), (60, 2), (60, 2), (60, 2), (90, 4), (60, 4), (60, 4), (60, 4)]


def test_chain_learns_both_categories(spark):
    frame = invented(spark)
    train, test = frame.where("doc_id < 400"), frame.where("doc_id >= 400")
    chain = t.fit(frame, train.select("doc_id", "rude", "loud"), {"rude": F.col("rude"), "loud": F.col("loud")})
    got = t.probabilities(test, chain).join(test, "doc_id").collect()
    assert len(got) == 200
    assert np.mean([(r.rude_probability >= 0.5) == bool(r.rude) and (r.loud_probability >= 0.5) == bool(r.loud) for r in got]) > 0.97
    kept = t.keep_clean(test, chain, "rude").collect()
    assert len(kept) < 170 and kept[0].key == "x"
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "grumbling " * 9), (4, "alpha1 " * 30000)], "doc_id bigint, text string")
    scores = sorted(t.probabilities(odd, chain).collect(), key=str)
    assert len(scores) == 4 and [r.rude_probability >= 0.5 for r in scores if r.doc_id is None] == [True]
    assert t.probabilities(odd.limit(0), chain).collect() == []


@pytest.mark.parametrize("labels,low", [([], True), ([(1, 0), (2, 0)], True), ([(1, 1), (2, 1)], False), ([(99, 1), (1, None)], True)])
def test_labels_of_one_kind(spark, labels, low):
    frame = invented(spark, 10).select("doc_id", "text")
    chain = t.fit(frame, spark.createDataFrame(labels, "doc_id bigint, rude int"), {"rude": F.col("rude")})
    assert all((r.rude_probability < 0.5) == low for r in t.probabilities(frame, chain).collect())


def test_held_out_accuracy_on_the_table(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    chain = t.fit(docs, labels.where(~held), t.default_categories())
    got = t.probabilities(docs, chain).join(labels.where(held), "doc_id").collect()
    assert np.mean([(r.toxic_probability >= 0.5) == bool(r.toxic) for r in got]) > 0.93
    assert np.mean([r.toxic_probability >= 0.5 for r in got if not r.toxic]) < 0.03


def test_later_models_see_probabilities(monkeypatch):
    """The column of an earlier category holds what models of the other folds say, as probabilities."""
    seen = []
    real = t.fit_logistic
    monkeypatch.setattr(t, "fit_logistic", lambda x, y, **k: seen.append((x, y)) or real(x, y, **k))
    rng = np.random.default_rng(2)
    features, folds = rng.normal(size=(90, 2)), np.arange(90) % 3
    labels = (rng.random((90, 2)) < 1 / (1 + np.exp(-3 * features))).astype(float)
    t.fit_chain([features, features[:, :1]], labels, folds)
    column = seen[4][0][:, 1]
    for i in range(90):
        weights = real(features[folds != folds[i]], labels[folds != folds[i], 0])
        assert np.isclose(column[i], 1 / (1 + np.exp(-(features[i] @ weights[1:] + weights[0]))))


def test_query_against_a_plain_chain(spark):
    """Every probability of the query, from the fitted weights by plain arithmetic."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    chain = t.fit(docs, labels, t.default_categories())
    assert len(chain.links[1].earlier) == 1
    got = {r.doc_id: r for r in t.op6(spark, folder).collect()}
    for row in docs.collect():
        words, known = t.words_of(row.text or ""), []
        for link in chain.links:
            logit = link.intercept
            for string, weight in zip(link.strings, link.weights):
                if string.endswith(b" "):
                    count = sum(word == string[:-1] for word in words)
                else:
                    count = sum(word.startswith(string) and len(word.decode("utf-8", "ignore")) > len(string.decode()) for word in words)
                logit += weight * (100 * count / len(words) if words else 0.0)
            logit += sum(w * p for w, p in zip(link.earlier, known))
            known.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
        assert np.allclose(known, [got[row.doc_id].low_quality_probability, got[row.doc_id].toxic_probability])
        assert got[row.doc_id].toxic == (got[row.doc_id].toxic_probability >= t.THRESHOLD)


def test_query_covers_the_table(spark):
    rows = t.op6(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.kept != r.toxic for r in rows)

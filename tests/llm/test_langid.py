from __future__ import annotations

import zlib

import numpy as np
import pytest

from conftest import SF_CHECK
from pluvio.llm import langid


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet(f"{SF_CHECK}/documents.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = langid.identify(docs, model).where("lang is not null").collect()
    apart = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(apart) > 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in apart]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    kept = [r for r in apart if not r["rejected"]]
    assert len(kept) > 0.8 * len(apart)


def test_training_is_deterministic_and_bounded(spark, model):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    again = langid.fit(docs.repartition(5))
    assert np.array_equal(model.table, again.table) and model.threshold == again.threshold


def test_folded_table_equals_the_two_layers(model):
    text = "The quick brown fox " * 50
    where, share = langid.bag(text)
    logits = (share @ model.table[where] + model.bias) / model.temperature
    p = np.exp(logits - logits.max())
    assert model.predict(text)[1] == pytest.approx((p / p.sum()).max(), abs=1e-9)


def test_edge_rows(docs, model):
    made = langid.identify(docs, model)
    rows = made.collect()
    assert len(rows) == docs.count() and made.columns[-3:] == ["lang_pred", "score", "rejected"]
    for r in rows:
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == (not letters)
        assert r["lang_pred"] in (*model.languages, "und")
        assert letters or (r["score"], r["rejected"]) == (0.0, True)


def test_no_letters():
    model = langid.train([langid.bag("abc def"), langid.bag("ghi jkl")] * 6, ["x", "y"] * 6)
    for text in (None, "", "123 456", " \n", "!?"):
        assert model.predict(text) == ("und", 0.0, True)
    assert model.predict("abc")[0] == "x" and model.predict("JKL")[0] == "y"
    assert model.predict("z" * (langid.PIECE * 2 + 5))[0] in "xy"


def test_nothing_to_learn_from(no_docs, docs):
    model = langid.fit(no_docs)
    assert {r["lang_pred"] for r in langid.identify(docs, model).collect()} == {"und"}
    assert langid.identify(no_docs, model).collect() == []


def _plain_training(bags, langs, seed):
    """The same steps with dense matrices and the gradient of the cross-entropy written out."""
    languages = sorted(set(langs))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(bags))
    learn = order[int(len(bags) * langid.CALIBRATION):]
    e = rng.normal(0, 1, (langid.BUCKETS, langid.DIMENSIONS))
    w, b = np.zeros((langid.DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, done = langid.EPOCHS * len(learn), 0
    for _ in range(langid.EPOCHS):
        for i in rng.permutation(learn):
            x, y = np.zeros(langid.BUCKETS), np.zeros(len(languages))
            x[bags[i][0]], y[languages.index(langs[i])] = bags[i][1], 1
            grads = _gradient(e, w, b, x, y)
            rate = langid.RATE * (1 - done / steps)
            e, w, b = e - rate * grads[0], w - rate * grads[1], b - 0.1 * rate * grads[2]
            done += 1
    return e @ w, b


def _loss(e, w, b, x, y):
    z = x @ e @ w + b
    return np.log(np.exp(z).sum()) - z @ y


def _gradient(e, w, b, x, y):
    z = x @ e @ w + b
    off = np.exp(z) / np.exp(z).sum() - y
    return np.outer(x, w @ off), np.outer(x @ e, off), off


def test_the_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    parts = [rng.normal(0, 1, s) for s in ((5, 3), (3, 4), (4,))]
    x, y = rng.random(5), np.eye(4)[2]
    for k, grad in enumerate(_gradient(*parts, x, y)):
        for at in np.ndindex(grad.shape):
            moved = [p.copy() for p in parts]
            moved[k][at] += 1e-6
            assert (_loss(*moved, x, y) - _loss(*parts, x, y)) / 1e-6 == pytest.approx(grad[at], abs=1e-4)


def test_training_takes_the_gradient(monkeypatch):
    monkeypatch.setattr(langid, "BUCKETS", 32)
    monkeypatch.setattr(langid, "DIMENSIONS", 4)
    rng = np.random.default_rng(3)
    bags, langs = [], []
    for i in range(40):
        where = np.sort(rng.choice(32, 6, replace=False))
        share = rng.random(6)
        bags.append((where, share / share.sum()))
        langs.append("abc"[i % 3])
    model = langid.train(bags, langs, seed=5)
    table, bias = _plain_training(bags, langs, seed=5)
    assert np.allclose(model.table, table) and np.allclose(model.bias, bias)


def test_the_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    bags = []
    train = langid.train
    try:
        langid.train = lambda b, l: bags.append(len(b)) or train(b, l)
        langid.fit(docs.unionAll(docs).unionAll(docs), train_rows=200)
    finally:
        langid.train = train
    assert 100 < bags[0] <= 200


def test_rejected_predictions_are_wrong_more_often():
    rng = np.random.default_rng(8)
    sure = rng.random(4000)
    right = rng.random(4000) < 0.5 + 0.5 * np.minimum(1, sure * 1.6)
    cut = langid.rejection_threshold(sure, right)
    assert 0.1 < cut < 0.9 and right[sure < cut].mean() < right[sure >= cut].mean()
    assert langid.rejection_threshold(sure, np.ones(4000, bool)) == np.sort(sure)[40]
    assert langid.rejection_threshold(sure, np.zeros(4000, bool)) == 0.0


def test_held_out_rejections(spark, model):
    docs = spark.read.parquet(f"{SF_CHECK.replace('0.01', '0.1')}/documents.parquet")
    rows = langid.identify(docs, langid.fit(docs)).where("lang is not null").where(langid.held_out(docs["doc_id"])).collect()
    kept, rejected = ([r["lang_pred"] == r["lang"] for r in rows if r["rejected"] == x] for x in (False, True))
    assert np.mean(kept) > 0.995 and (not rejected or np.mean(rejected) < np.mean(kept))

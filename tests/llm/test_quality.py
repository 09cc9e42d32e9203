from __future__ import annotations

import zlib

import numpy as np
import pytest

from conftest import SF_CHECK
from pluvio.llm import features, quality


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_CHECK}/documents.parquet"), spark.read.parquet(f"{SF_CHECK}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return quality.fit(*tables)


def test_held_out_labels_are_predicted(tables, model):
    docs, labels = tables
    rows = (quality.score(docs, model).join(labels, "doc_id").where(quality.held_out(docs["doc_id"]))
            .select("doc_id", "score", "predicted", "quality").collect())
    assert len(rows) > 30
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.98
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def test_moments_match_numpy(tables, model):
    docs, labels = (t.toPandas() for t in tables)
    rows = docs.merge(labels, on="doc_id")
    rows = rows[[zlib.crc32(str(i).encode()) % 5 != 0 for i in rows["doc_id"]]]
    x = np.array([features.statistics(t) for t in rows["text"]])
    y = rows["quality"].to_numpy()
    assert np.allclose(model.centre, x.mean(axis=0))
    assert np.allclose(model.scale, x.std(axis=0))
    z = (x - model.centre) / model.scale
    inside = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = sum((y == c).mean() * inside[c] for c in (0, 1))
    for c in (0, 1):
        shrunk = (1 - quality.TO_POOLED) * inside[c] + quality.TO_POOLED * pooled
        shrunk = (1 - quality.TO_DIAGONAL) * shrunk + quality.TO_DIAGONAL * np.diag(np.diag(pooled))
        factor = model.factors[c]
        assert np.allclose(np.linalg.inv(factor.T @ factor), shrunk, atol=1e-5)


def test_edge_rows_are_scored_on_text_alone(docs, model):
    made = quality.score(docs, model)
    assert "Score" not in made.columns and made.columns[-2:] == ["score", "predicted"]
    rows = made.collect()
    assert len(rows) == docs.count()
    by_text = {}
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]


def test_keep_good_keeps_columns(docs, tables, model):
    left = quality.keep_good(docs, tables[1])
    assert left.columns == docs.columns


def test_a_clean_text_stays_and_junk_goes(spark, tables, model):
    clean = tables[0].join(tables[1].where("quality = 1"), "doc_id").orderBy("doc_id").first()["text"]
    words = clean.split()
    rows = [(1, clean), (2, " | ".join(words)), (3, " ".join(w.upper() + "!!" for w in words)),
            (4, " ".join(w for w in words for _ in range(20))), (5, " ".join(w + "###" for w in words))]
    got = quality.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert [r["predicted"] for r in got] == [1, 0, 0, 0, 0]


def test_without_labels_or_with_one_class(docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None), (4, 7)], "doc_id long, quality int")
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, odd)).collect()} == {1.0}
    assert quality.score(no_docs, quality.fit(no_docs, none)).collect() == []


def test_statistics_of_odd_texts():
    for text in ("", " ", "x", "\U0001f600" * 5, "é" * (3 << 20)):
        assert np.isfinite(features.statistics(text)).all()

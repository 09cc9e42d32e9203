"""The stages of the corpus pipeline on odd rows."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from pluvio.session import local_path, work_root

from .conftest import DOCS, make


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(4)
    known = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).collect()]
    rows = [(i, t, "en", f"src{i % 3}") for i, t in enumerate(known)]
    rows += [(None, known[0], None, None), (3, known[3], "en", "src0"), (3, known[3], "en", "src0"), (200, None, None, None),
             (201, "", "en", "src1"), (202, " \n ", None, "src2"), (None, None, None, None),
             (203, known[5] + " " * 200_000 + known[6], "en", "src1"), (204, " ".join(rng.choices(known[7].split(), k=60_000)), "en", None)]
    return spark.createDataFrame(make(rows), DOCS)


def test_stages_take_odd_rows_and_keep_columns(spark, odd):
    docs = odd
    texts = {r["text"] for r in odd.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, SF_SMALL), "edges")
        assert docs.columns == odd.columns, name
        assert {r["text"] for r in docs.collect()} <= texts
    assert docs.count() > 20
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    sums = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sums and all(r["n"] <= 1024 for r in sums)


def test_stages_take_an_empty_table(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF_SMALL).collect() == [], name


def test_exact_and_near_copies_go(spark, odd):
    for name, stage in corpus_pipeline.STAGES[1:3]:
        left = stage(spark, odd, SF_SMALL).collect()
        rows = [(r["doc_id"], r["text"]) for r in left]
        # rows equal in id and text are one document, of which exact dedup keeps one row and near dedup both
        documents = rows if name == "exact dedup" else list(dict.fromkeys(rows))
        assert len({t or "" for _, t in rows}) == len(documents) < odd.count(), name


def test_run_leaves_its_result_alone(spark):
    def copies():
        top = os.path.join(local_path(work_root(spark)), "pluvio", "stage")
        return {(d, f) for d in (os.listdir(top) if os.path.isdir(top) else []) for f in os.listdir(os.path.join(top, d))
                if not f.startswith(".")}

    before = copies()
    made = corpus_pipeline.run(spark, SF_SMALL)
    assert {d for d, _ in copies() - before} == {"llm-pipeline"}
    assert made.count() > 0 and made.columns[:3] == ["doc_id", "start", "length"]

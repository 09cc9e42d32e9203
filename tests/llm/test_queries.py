"""Every registered query: SQL where there is some, plain code elsewhere."""

from __future__ import annotations

import inspect

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_CHECK, SF_SMALL
from oracle_compare import compare, duck
from pluvio.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    found = compare(spark, name, SF_CHECK, duck(SF_CHECK))
    assert found["cols_match"] and found["match"] and found["spark_rows"] > 0, found


def test_all_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names


COLUMNS = {
    "op1_langid": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
    "op2_mixing": [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"),
                   ("taken", "bigint")],
    "op4_secrets": [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"),
                    ("base_sha256", "string"), ("spans", "string")],
    "op7_simhash": [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
    "op8_quality": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_document(spark, name):
    made = queries.QUERIES[name](spark, SF_SMALL)
    assert set(COLUMNS[name]) <= set(made.dtypes)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert sorted(r[0] for r in made.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    read, first = docs, {r["doc_id"]: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        docs = corpus_pipeline.staged(stage(spark, docs, SF_SMALL), "test")
        assert docs.dtypes == read.dtypes
        rows = docs.collect()
        assert all(r == first[r["doc_id"]] for r in rows)
        kept.append(rows)
    good, exact, near, mixed = kept
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    ids = lambda rows: {r["doc_id"] for r in rows}
    wrong = [i for i, q in labels.items() if (q == 1) != (i in ids(good))]
    assert len(wrong) <= 0.05 * len(labels)
    largest = {}
    for r in good:
        largest[r["text"]] = max(largest.get(r["text"], 0), r["doc_id"])
    assert ids(exact) == set(largest.values()) and len(exact) == len(largest)
    assert ids(near) <= ids(exact) and len(near) == len(ids(near))
    assert ids(mixed) <= ids(near)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert ids(pieces.collect()) == ids(mixed)
    assert ids(corpus_pipeline.run(spark, SF_SMALL).collect()) == ids(mixed)

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("size", T.StringType()), T.StructField("Score", T.StringType()),
    T.StructField("row", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("copies", T.StringType()),
])
WORDS = ("alder birch cedar dogwood elm fir gum hazel ivy juniper katsura larch maple nutmeg oak pine quince "
         "rowan spruce teak umbrella viburnum willow yew zelkova the of and in to is").split()


def make(rows):
    """Rows of (doc_id, text, lang, source) with the other columns filled in."""
    return [(*r, None if r[1] is None else len(r[1]), "s", "c", "r", "k", "f", "n") for r in rows]


def edge_rows(n: int = 60, seed: int = 3):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(1, 80))), "en", f"src{i % 3}") for i in range(n)]
    long_text = " ".join(rng.choices(WORDS, k=40_000))
    rows += [(100, None, None, None), (101, "", "en", "src0"), (102, " \n\t ", None, "src1"),
             (103, long_text, "en", "src1"), (104, long_text, "en", "src2"), (105, long_text + " x", "en", None),
             (None, "a text without an id", "en", "src0"), (None, None, None, None),
             (7, rows[7][1], "en", "src1"),  # a repeated row
             (106, rows[3][1], None, "src2"), (107, rows[3][1], "en", "src0"),
             # white space of two million characters
             (110, "before" + " " * 1_000_000 + "\n" * 600_000 + "\t" * 400_000 + "behind", "en", "src0"),
             (108, "İstanbul ſ K 中文 \U0001f600 é\x00z", "tr", ""), (109, "x", "en", "src0")]
    return rows


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(make(edge_rows()), DOCS)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

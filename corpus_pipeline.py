"""A training corpus from raw documents, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the
one before it kept; all but the last return the columns of ``documents``.

Null texts count as empty, null ids and sources as values of their own, and
an empty table gives no rows, in every stage. Further columns are kept up to
the last stage, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pluvio.llm import exact_dedup, mixing, packing, quality, simhash
from pluvio.llm.common import staged, table
from pluvio.staging import scratch


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; equal texts are judged alike."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id (null ids are smallest); of rows equal in both, one."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: shingles of 3 words, at most 3 bits apart.
    That with the smallest id stays, null ids last; texts without words are alike."""
    return simhash.deduplicate(docs, max_bits=3, shingle=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; empty texts take no words and go as often as their source's hash says."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens; each row is a document, an empty one its end id alone."""
    return packing.pack(docs)


STAGES = [("quality classifier", classify), ("exact dedup", exact), ("simhash near-dedup", near),
          ("mixing sources", mix), ("packing", pack)]

#: Classifier, fingerprints and tokens are beyond SQL; the stages are tested against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the
    next reads them, and what a stage wrote on its way is deleted after it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as copies:
            if before:
                copies.append(before)
            docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
            before = copies.pop()  # this stage's rows stay for the next one
    with scratch(spark) as copies:
        copies.append(before)
        made = staged(STAGES[-1][1](spark, docs, sf_dir), "pipeline")
        copies.pop()
    return made

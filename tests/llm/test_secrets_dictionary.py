from __future__ import annotations

import random
import string

from pyspark.sql import functions as F

from pluvio.llm import secrets


def _documents(copies, distinct):
    """Secrets of a few long letter runs; ``copies`` of one document, and ``distinct`` that repeat its secret."""
    rng = random.Random(3)
    runs = ["".join(rng.choices(string.ascii_letters, k=20)) for _ in range(3)]
    secret = "7".join(runs)
    rows = [(f"handler of requests, signing key\n  {secret}\n",)] * copies
    rows += [(f"request handler number {i}, the signing key\n  {secret}\n",) for i in range(distinct)]
    rows += [(f"handler of ordinary requests {i}, number",) for i in range(20)]
    return secret, runs, rows


def test_copies_count_once_and_secrets_not_at_all(spark):
    for copies, distinct in ((300, 0), (1, 30)):
        secret, runs, rows = _documents(copies, distinct)
        table = spark.createDataFrame(rows, "text string").repartition(4)
        made = secrets.identifier_dictionary(table)
        assert not set(runs) & set(made.decode().split())
        assert {"handler", "requests", "number"} <= set(made.decode().split())
        found = secrets.scan(table, made).where(F.contains("text", F.lit(secret))).select(
            F.substring_index(secrets.spans(F.col("findings")), ":", 1).alias("kind"),
            F.size("findings").alias("n")).distinct().collect()
        assert [tuple(r) for r in found] == [("novel", 1)]

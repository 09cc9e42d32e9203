from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pluvio.llm import secrets

KEY = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEX"
DICTIONARY = b"client handler response request session configuration database connection identifier"


def _base(text):
    """The rules as stated, one pattern at a time, failing matches dropped after."""
    found = []
    assign = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
              r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    for place, (kind, pattern, least) in enumerate((("assign", assign, 12), ("access", "AKIA[A-Z0-9]+", 18),
                                                    ("hex", "[0-9a-f]+", 16))):
        for m in re.finditer(pattern, text):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                found.append((m.start(), place, kind, m.end()))
    return [(s, e, kind) for s, _, kind, e in sorted(found)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["password", "PassWD", "secret", "Token", "api_key", "ApiKey", "=", ":", " ", "  ", "'", '"', "AKIA", "akia",
     "ABCDEFGH01234567", "deadbeef", "0123456789abcdef", "é", "ſecret", "toKen", "\U0001f600", "\n", "-", ".", "xyz"]),
    max_size=25))
def test_base_spans_match_the_rules(parts):
    text = "".join(parts)
    assert secrets.base_findings(text, text.lower()) == _base(text)


def test_novel_strings_in_sensitive_context_are_added():
    scanner = secrets.Scanner(DICTIONARY)
    text = f"the signing key\n  {KEY} and request_handler_configuration2"
    found = scanner.scan(text)
    assert [(f["kind"], text[f["start"]:f["end"]]) for f in found] == [("novel", KEY)]
    assert scanner.scan(f"an ordinary word, then {KEY}") == []
    assert scanner.scan("session id database_connection_identifier_1") == []


def test_identifiers_are_cheap_and_random_strings_are_not():
    scanner = secrets.Scanner(DICTIONARY)
    for text, low in ((KEY, False), ("database_connection_identifier", True)):
        assert (scanner.novelty(text, 0, len(text)) < secrets.NOVELTY) == low
    again = f"{KEY} {KEY}"  # known from the code around it
    assert scanner.novelty(again, 0, len(KEY)) < secrets.NOVELTY


def test_scan_of_edge_rows(spark, docs):
    rows = [(1, f"token = {KEY}", "mine"), (2, None, "x"), (3, "", None), (None, "AKIA" + "A1" * 9, "y"),
            (1, f"token = {KEY}", "mine"), (4, "w " * 300_000 + "0123456789abcdef", "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, Findings string")
    made = secrets.scan(table, secrets.identifier_dictionary(table))
    assert made.columns == ["doc_id", "text", "findings"]
    got = made.select("doc_id", secrets.spans(F.col("findings")).alias("spans")).collect()
    assert sorted(((r["doc_id"] or 0), r["spans"]) for r in got) == [
        (0, "access:0:22"), (1, f"assign:0:{8 + len(KEY)}"), (1, f"assign:0:{8 + len(KEY)}"), (2, ""), (3, ""),
        (4, "hex:600000:600016")]
    assert secrets.scan(docs, b"").count() == docs.count()


def test_dictionary_counts_documents_of_the_whole_table(spark):
    rows = [(f"common common word{'x' * (i % 3)} only{chr(97 + i)}",) for i in range(9)]
    made = secrets.identifier_dictionary(spark.createDataFrame(rows, "text string").repartition(4)).decode().split()
    assert made == ["wordxx", "wordx", "word", "common"]


def test_empty(no_docs):
    assert secrets.identifier_dictionary(no_docs) == b""
    assert secrets.scan(no_docs, b"").collect() == []

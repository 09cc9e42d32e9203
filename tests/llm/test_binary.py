from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from pluvio.llm import binary, tokens
from pluvio.llm.warc import open_store


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_paths()[0])


def _plain(lengths, window):
    """Best fit decreasing by looking at every open sequence."""
    rooms, total = [], 0
    for size in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if not fits:
            rooms.append(window)
            fits, total = [(window, len(rooms) - 1)], total + 1
        rooms[min(fits)[1]] -= size
    return sorted(rooms)


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([1, 2, 7, 8, 31, 64]).flatmap(
    lambda w: st.tuples(st.just(w), st.lists(st.integers(1, w), min_size=1, max_size=60))))
def test_placement_is_best_fit_decreasing(case):
    window, lengths = case
    sequence, offset, n = binary.best_fit_decreasing(np.array(lengths), window)
    filled = Counter()
    for s, o, size in sorted(zip(sequence.tolist(), offset.tolist(), lengths)):
        assert o == filled[s]
        filled[s] += size
    assert set(filled) == set(range(n)) and max(filled.values()) <= window
    assert sorted(window - f for f in filled.values()) == _plain(lengths, window)


def test_tree_takes_the_tightest_fit():
    tree = binary.CapacityTree(10)
    assert tree.take(1) is None
    for room, sequence in ((3, 0), (7, 1), (10, 2), (3, 3)):
        tree.add(room, sequence)
    assert tree.take(4) == (7, 1)
    assert tree.take(4) == (10, 2)
    assert tree.take(4) is None
    assert {tree.take(1), tree.take(3)} == {(3, 0), (3, 3)}
    assert tree.take(1) is None


def _check(index, docs, library, window):
    want = Counter()
    for r in docs.collect():
        want[(r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids + [0]))] += 1
    at = defaultdict(list)
    for r in binary.read(index).collect():
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] <= window and r["start"] % window == 0
        at[r["sequence_id"]].append((r["offset"], r["length"]))
        same = [k for k in want if k[0] == r["doc_id"] and len(k[1]) == r["doc_tokens"]
                and k[1][r["start"]:r["start"] + len(ids)] == tuple(ids.tolist())]
        assert same
    for pieces in at.values():
        filled = 0
        for offset, length in sorted(pieces):
            assert offset == filled
            filled += length
        assert filled <= window
    placed = sum(length for pieces in at.values() for _, length in pieces)
    assert placed == sum(len(ids) * n for (_, ids), n in want.items())
    assert sum(map(len, at.values())) == sum(-(-len(ids) // window) * n for (_, ids), n in want.items())
    return at


@pytest.mark.parametrize("window", [64, 1024])
def test_edge_rows_round_trip(docs, library, window):
    _check(binary.write(docs, window=window), docs, library, window)


def test_documents_pack_with_little_padding(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    at = _check(binary.write(docs.coalesce(1)), docs, library, 1024)
    tokens_ = sum(length for pieces in at.values() for _, length in pieces)
    assert len(at) * 1024 < 1.1 * tokens_


def test_files_are_as_described(spark, monkeypatch, library):
    monkeypatch.setattr(binary, "SHARD_TOKENS", 300)
    docs = spark.createDataFrame([(i, "some words of text " * (i % 9)) for i in range(80)], "doc_id long, text string")
    for r in binary.write(docs.coalesce(1), window=32).collect():
        store, base = open_store(r["path"])
        read = lambda ending: store.open_input_file(base + ending).read()
        ids, cu = np.frombuffer(read(".ids.bin"), "<u2"), np.frombuffer(read(".cu.bin"), "<i8")
        assert len(ids) == 32 * r["sequences"] and cu[0] == 0 and cu[-1] == len(ids) and (np.diff(cu) > 0).all()
        assert set(range(0, len(ids), 32)) <= set(cu.tolist())  # no segment crosses a sequence
        positions = np.frombuffer(zstandard.decompress(read(".pos.bin.zst")), "<u2")
        assert (np.flatnonzero(positions == 0) == cu[:-1]).all()


def test_damage_is_noticed(spark):
    index = binary.write(spark.createDataFrame([(1, "a few words")], "doc_id long, text string"))
    store, base = open_store(index.first()["path"])
    with store.open_output_stream(base + ".cu.bin") as out:
        out.write(np.array([0, 2, 1024], "<i8").tobytes())
    with pytest.raises(Exception, match="damaged files"):
        binary.read(index).collect()


def test_empty(no_docs):
    index = binary.write(no_docs)
    assert index.count() == 0 and binary.read(index).collect() == []


def test_many_short_pieces_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(binary, "SHARD_PIECES", 50)
    docs = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"),
                                    F.lit(None).cast("string").alias("text"))
    index = binary.write(docs)
    assert index.agg(F.max("segments")).first()[0] <= 50 and index.agg(F.sum("segments")).first()[0] == 1000
    assert index.count() >= 20 and binary.read(index).count() == 1000

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF_SMALL
from pluvio.llm import packing, tokens


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_paths()[0])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(
    ["word", "Don't", "x1", " ", " ", " ", "\n", "\t", "\r", "é", "ñandú", "中文", " ", "　", "\x1c", "\x85",
     "​", "\U0001f600", "<|endoftext|>", "!!", "--", "'s", "ſ", "İ", "0", "\x00"]), max_size=14))
def test_ids_are_those_of_the_library(library, parts):
    text = "".join(parts)
    own = tokens.encoder(*tokens.default_paths())
    got = np.frombuffer(own.encode(text), own.dtype).tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("run", [" ", "\n", "\t", " \n", "a", "-", "1", "é"])
@pytest.mark.parametrize("size", [tokens.LONG_SPACE - 1, tokens.LONG_SPACE, 300_000])
def test_ids_of_long_runs(library, run, size):
    own = tokens.encoder(*tokens.default_paths())
    text = "x " + run * (size // len(run)) + "y"
    assert np.frombuffer(own.encode(text), own.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def test_ids_of_whole_documents(spark, library):
    own = tokens.encoder(*tokens.default_paths())
    texts = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    for text in texts:
        assert np.frombuffer(own.encode(text), own.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(1, 12), max_size=70), min_size=1, max_size=30), st.sampled_from([1, 8, 32]))
def test_every_id_lies_in_one_piece(lists, window):
    docs = [np.array([*x, 0], np.uint16) for x in lists]
    placed, filled = [0] * len(docs), Counter()
    for n, start, length, sequence, offset in packing.pack_shard(docs, window):
        assert length > 0 and start == placed[n] and offset == filled[sequence]
        placed[n] += length
        filled[sequence] += length
    assert placed == [len(d) for d in docs]
    last = max(filled)
    assert all(filled[s] == window for s in range(last)) and 0 < filled[last] <= window


def test_scores_are_bm25():
    rng = np.random.default_rng(2)
    docs = [rng.integers(1, 30, rng.integers(1, 20)) for _ in range(40)]
    index = packing.Bm25(docs)
    mean = np.mean([len(d) for d in docs])

    def score(query, doc):
        total = 0.0
        for t in set(docs[query].tolist()):
            df = sum(t in d for d in docs)
            tf = int((docs[doc] == t).sum())
            norm = packing.K1 * (1 - packing.B + packing.B * len(docs[doc]) / mean)
            total += np.log1p((40 - df + 0.5) / (df + 0.5)) * tf * (packing.K1 + 1) / (tf + norm) * (df > 1)
        return total

    used = np.zeros(40, bool)
    used[[3, 5, 8]] = True
    for seed in range(40):
        want = sorted(((-score(seed, d), d) for d in range(40) if not used[d] and score(seed, d) > 0))
        got = index.nearest(seed, used).tolist()
        assert np.allclose([score(seed, d) for d in got], [-s for s, _ in want[:packing.NEIGHBOURS]], atol=1e-4)


def test_neighbours_share_a_window():
    topics = [np.r_[np.full(20, t), np.arange(100 + t * 3, 103 + t * 3), 0] for t in range(1, 9) for _ in range(3)]
    order = np.random.default_rng(0).permutation(len(topics))
    windows = defaultdict(list)
    for n, _, _, sequence, _ in packing.pack_shard([topics[i] for i in order], 3 * 24):
        windows[sequence].append(int(topics[order[n]][0]))
    assert all(len(set(topic)) == 1 for topic in windows.values())


def _check(pieces, docs, library, window=1024):
    want = Counter()
    for r in docs.collect():
        want[(r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids + [0]))] += 1
    rows = sorted(pieces.collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    at = Counter()
    for r in rows:
        assert r["offset"] == at[r["sequence_id"]] and len(r["ids"]) == 4 * r["length"]
        at[r["sequence_id"]] += r["length"]
    assert all(n <= window for n in at.values())
    parts = defaultdict(list)
    for r in rows:
        parts[(r["doc_id"], r["doc_tokens"])].append((r["start"], np.frombuffer(r["ids"], "<u4")))
    for (doc_id, total), found in parts.items():
        same = [ids for (i, ids), n in want.items() for _ in range(n) if i == doc_id and len(ids) == total]
        cover = Counter(p for start, ids in found for p in range(start, start + len(ids)))
        assert cover == Counter({p: len(same) for p in range(total)})
        for start, ids in found:
            assert any(tuple(ids.tolist()) == s[start:start + len(ids)] for s in same)
    assert sum(at.values()) == sum(len(ids) * n for (_, ids), n in want.items())
    return at


def test_edge_rows(docs, library):
    _check(packing.pack(docs), docs, library)


def test_documents_pack_with_little_padding(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    at = _check(packing.pack(docs), docs, library)
    assert len(at) * 1024 - sum(at.values()) < 0.02 * sum(at.values())


def test_shards_are_bounded(docs, library, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 5)
    rows = docs.where("length(text) < 10000").coalesce(1)
    _check(packing.pack(rows), rows, library)


def test_checksum_is_that_of_the_ids(spark):
    from pluvio.llm.queries import op3_packing

    for r in op3_packing(spark, SF_SMALL).limit(5).collect():
        assert 0 <= r["ids_crc32"] < 1 << 32
    assert zlib.crc32(np.array([0], "<u4").tobytes()) == 0x2144DF1C


def test_empty(no_docs):
    assert packing.pack(no_docs).collect() == []

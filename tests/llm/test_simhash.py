from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from pluvio.llm import simhash


def _fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def _components(fps, ids, bits=3):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    known = sorted(set(fps))
    for i, a in enumerate(known):
        for b in known[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for f, i in zip(fps, ids):
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return [least.get(find(f)) for f in fps]


def test_the_code_covers():
    offsets, starts, radius = simhash.anchor_offsets(1)
    assert radius == 4 and len(starts) == (1 << 14) + 1
    assert (np.bitwise_count(offsets[starts[:-1]]) <= radius).all()  # each home
    assert int(np.bitwise_count(offsets).max()) == radius + 1


def test_linked_fingerprints_meet_at_a_home():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
    (ia, ka, ha), (ib, kb, _) = simhash.anchors(a, 3), simhash.anchors(b, 3)
    homes = [set() for _ in a]
    for i, k in zip(ia[ha], ka[ha]):
        homes[i].add(int(k))
    met = np.zeros(len(a), bool)
    for i, k in zip(ib, kb):
        met[i] |= int(k) in homes[i]
    assert met.all()


def test_documents_match_brute_force(docs):
    rows = docs.collect()
    want = [_fingerprint(r["text"]) for r in rows]
    component = _components(want, [r["doc_id"] for r in rows])
    got = simhash.near_duplicates(docs).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=key) == sorted(
        ((r["doc_id"], f"{f:016x}", c) for r, f, c in zip(rows, want, component)), key=key)


def test_links_in_small_and_large_groups(spark):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 64, 1, dtype=np.uint64)[0]
    near = [centre ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)))
            for _ in range(700)]  # one dense cloud, more than SMALL_GROUP at an anchor
    pairs = rng.integers(0, 1 << 64, 200, dtype=np.uint64)
    fps = sorted({int(x) for x in [*near, *pairs, *(pairs ^ np.uint64(0b10010001)), *(pairs ^ np.uint64(0xF))]})
    table = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long").repartition(5)
    found = simhash.components(simhash.links(table)).collect()
    root = {int(np.int64(r["node"]).view(np.uint64)): int(np.int64(r["root"]).view(np.uint64)) for r in found}
    want = _components(fps, list(range(len(fps))))
    got = [root.get(f, f) for f in fps]
    together = {}
    for w, g in zip(want, got):
        assert together.setdefault(w, g) == g
    assert len(set(got)) == len(set(want))


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert got == {**{i: 0 for i in range(301)}, 500: 500, 501: 500}


def test_deduplicate_keeps_one_of_each(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base, "a"), (2, base + " tail", "b"), (9, "something else entirely here", "c"), (3, None, "d"),
            (None, "", "e"), (4, base.upper(), "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert groups[5] == groups[2] == groups[4] == 2 and groups[None] == groups[3] == 3
    left = simhash.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 9]


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.deduplicate(no_docs).collect() == []


@pytest.mark.parametrize("max_bits", [2, 3])
@pytest.mark.parametrize("half", [0, 1])
def test_large_groups_divided_by_bytes_keep_every_link(monkeypatch, half, max_bits):
    rng = np.random.default_rng(6)
    near = rng.integers(0, 1 << 32, 40, dtype=np.uint64)
    noise = np.array([sum(1 << int(b) for b in rng.choice(32, rng.integers(0, 4), replace=False)) for _ in range(900)], np.uint64)
    other = near[rng.integers(0, 40, 900)] ^ noise
    fp = np.unique(other << np.uint64(32 * (1 - half)))  # the anchor's half is the same in all

    def components(links):
        root = {int(x): int(x) for x in fp}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in (row for part in links for row in part.tolist()):
            root[find(int(a))] = find(int(b))
        return sorted(sorted(x for x in root if find(x) == r) for r in {find(x) for x in root})

    pairs = [np.array([[a, b] for b in fp if bin(int(a) ^ int(b)).count("1") <= max_bits], np.uint64) for a in fp]
    monkeypatch.setattr(simhash, "DIVIDED_GROUP", 10)
    divided = simhash._large(fp, half, max_bits)
    assert all(bin(int(a) ^ int(b)).count("1") <= max_bits for part in divided for a, b in part.tolist())
    assert components(divided) == components(pairs)

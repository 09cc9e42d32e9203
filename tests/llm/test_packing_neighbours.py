from __future__ import annotations

import numpy as np

from pluvio.llm import packing


def test_every_shared_term_of_a_long_seed_counts():
    rare = [np.array([1000 + i, 1000 + i, 2]) for i in range(60)]
    docs = [np.arange(1000, 1060), *rare, np.array([5, 6, 7])]
    used = np.zeros(len(docs), bool)
    used[0] = True
    index = packing.Bm25(docs)
    assert sorted(index.nearest(0, used).tolist()) == list(range(1, 61))


def test_a_neighbour_that_fits_is_found_behind_many_that_do_not():
    long = [np.r_[np.full(30, 1), np.full(30, 100 + i), 0] for i in range(30)]
    seed, short = np.r_[np.full(20, 1), np.full(20, 2), 0], np.r_[1, np.full(8, 50), 0]
    docs = [seed, *long, short]
    pieces = list(packing.pack_shard(docs, 51))
    assert [p for p in pieces if p[3] == 0] == [(0, 0, 41, 0, 0), (31, 0, 10, 0, 41)]


def test_a_window_keeps_its_seed():
    seed, near, also = np.r_[1, 1, 1, 2, 3, 0], np.r_[2, 3, 60, 61, 62, 0], np.r_[1, 1, 50, 51, 52, 0]
    drift = np.r_[50, 51, 52, 60, 61, 0]  # near to what the seed has fetched, not to the seed
    docs = [seed, near, also, *[np.r_[9, 9, 9, 9, 9, 0]] * 4, drift]
    first = [p[0] for p in packing.pack_shard(docs, 24) if p[3] == 0]
    assert first[0] == 0 and set(first[1:3]) == {1, 2} and first[3] == 3

from __future__ import annotations

import math

import numpy as np
import pytest

from pluvio.llm import topk


def _brute(rows, k, queries):
    """All pairs, as the registered SQL has them: every row is a candidate of its own."""
    vectors = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    scores = {}
    for q, a in vectors:
        if queries(q):
            scores.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, v)), i) for i, v in vectors if i != q)
    return sorted((q, n + 1, i, -s) for q, found in scores.items() for n, (s, i) in enumerate(sorted(found)[:k]))


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "mine") for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, v string")


@pytest.mark.parametrize("shard_rows", [7, 4096])
def test_matches_brute_force(spark, shard_rows):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 0.3, (6, 12))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.05, 12)).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(80)]  # many equal vectors: ties by id
    rows += [(None, rows[1][1]), (400, None), (420, [None] * 12), (440, [float("nan")] * 12),
             (441, [float("inf")] * 12), (460, []), (461, rows[2][1][:5]), (480, [0.0] * 12), (20, rows[20][1]),
             (40, rows[3][1])]
    rows += [(i, rows[i][1]) for i in (1, 1, 1, 1, 1, 1, 1, 60, 60)] + [(60, rows[61][1]), (7, rows[8][1]), (7, rows[9][1])]
    rows += [(20, rows[0][1])] * 9  # more copies under a query's own id than it may have hits
    got = topk.top_k(_table(spark, rows), topk.F.col("vec_id") % 20 == 0, k=5, shard_rows=shard_rows, query_rows=4)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == _brute(rows, 5, lambda q: q % 20 == 0)


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 0.5]), (1, [0.25, 1.0]), (2, [-1.0, 0.0])]
    got = topk.top_k(_table(spark, rows), topk.F.col("vec_id") == 0, k=20)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 20, lambda q: q == 0)


def test_empty(spark):
    assert topk.top_k(_table(spark, []), topk.F.col("vec_id") % 20 == 0).collect() == []
    assert topk.top_k(_table(spark, [(20, [1.0])]), topk.F.col("vec_id") % 20 == 0).collect() == []
    assert topk.top_k(_table(spark, [(1, [1.0]), (2, [1.0])]), topk.F.col("vec_id") % 20 == 0).collect() == []


def test_tree_cuts_nodes_and_stays_exact(monkeypatch):
    rng = np.random.default_rng(9)
    centres = rng.integers(-64, 64, (40, 16))
    points = np.repeat(centres, 100, axis=0) + rng.integers(-2, 3, (4000, 16)).astype(float)
    tree, queries = topk.BallTree(points), points[:50]
    assert (np.sort(tree.order) == np.arange(4000)).all()
    seen = []
    partition = np.partition
    monkeypatch.setattr(topk.np, "partition", lambda a, *r, **k: seen.append(a.shape) or partition(a, *r, **k))
    best = tree.search(queries, np.stack([np.arange(50), np.arange(1, 51)], axis=1), np.full(50, topk.LOWEST), 10)
    scores = np.rint(queries @ points.T).astype(np.int64)
    keys = scores * topk.PLACES + topk.PLACES - 1 - np.arange(4000)
    keys[np.arange(50), np.arange(50)] = topk.LOWEST
    assert (np.sort(best, axis=1) == np.sort(keys, axis=1)[:, -10:]).all()
    leaves = sum(node[2] < 0 for node in tree.nodes)
    assert len(seen) < leaves / 2


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(20, [1.0, 1.0]), (1, [2.0, 0.0]), (1, [1.5, 0.0])]
    got = topk.top_k(_table(spark, rows), topk.F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == [(20, 1, 1, 128 * 64), (20, 2, 1, 96 * 64)]


def test_far_shards_are_not_shipped(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = 4 * np.eye(24)[:, :24]
    rows = [(i, (centres[i % 24] + rng.normal(0, 0.02, 24)).tolist()) for i in range(2400)]
    cells = []
    pairs = topk._pairs

    def watched(df, key, shipped, *rest):
        if key == "p":
            cells.append(sum(map(len, shipped.values())))
        return pairs(df, key, shipped, *rest)

    monkeypatch.setattr(topk, "_pairs", watched)
    got = topk.top_k(_table(spark, rows), topk.F.col("vec_id") % 20 == 0, k=5, shard_rows=100, query_rows=20)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 5, lambda q: q % 20 == 0)
    groups = len({q % 24 for q in range(0, 2400, 20)})
    assert sum(cells) < groups * 24 / 4  # all pairs would be groups * 24


def test_a_pivot_with_most_rows_is_divided(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.001, 4).tolist()) for i in range(300)] + [(1000 + i, [3.0 * i, 1.0, 0.0, 0.0]) for i in range(9)]
    got = topk.top_k(_table(spark, rows), topk.F.col("vec_id") % 20 == 0, k=3, shard_rows=40, query_rows=3)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 3, lambda q: q % 20 == 0)

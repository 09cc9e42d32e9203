from __future__ import annotations

import pytest

from pluvio.llm import topk

from .test_topk import _brute, _table


@pytest.mark.parametrize("shard_rows", [7, 4096])
def test_large_components_beside_small_ones(spark, shard_rows):
    rows = [(i, [float(i % 7), float(i % 5 - 2)]) for i in range(60)]
    rows += [(100, [20_000_000.0, 3.0]), (101, [-20_000_000.0, 1.0]), (102, [20_000_000.0, 3.0])]
    got = topk.top_k(_table(spark, rows), topk.F.col("vec_id") % 20 == 0, k=5, shard_rows=shard_rows)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 5, lambda q: q % 20 == 0)

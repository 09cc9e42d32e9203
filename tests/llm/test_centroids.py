from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import types as T

from pluvio.llm import centroids

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    # names that the operator uses itself
    T.StructField("cluster", T.StringType()), T.StructField("e", T.StringType()),
    T.StructField("Distance", T.StringType()), T.StructField("near", T.StringType())])


def _table(spark, rows):
    return spark.createDataFrame([(*r, "c", "e", "d", "n") for r in rows], VECTORS)


def _plain(rows, k, rounds, components, scale=64):
    """The same by loops over Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [max(-centroids.CLAMP, min(centroids.CLAMP, x)) for x in v]) for i, v in kept]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    middle = [v for _, v in sorted(kept, key=key)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        parts = {}
        for _, v in kept:
            parts.setdefault(near(v)[1], []).append(v)
        for n, vs in parts.items():
            middle[n] = [sum(x) // len(vs) for x in zip(*vs)]
    top = (1 << 63) - 1
    found = [(i, near(v)[1], min(near(v)[0], top)) for i, v in kept]
    within = [sum(d for _, c, d in found if c == n) for n in range(len(middle))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return [(i, c, d, min(within[c], top), min(sum(within), top), digest[c]) for i, c, d in found]


def _same(got, want):
    order = lambda r: tuple((x is None, x or 0) for x in r[:3])
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)


def _rows(components, n=120, scale=1.0, seed=2):
    rng = random.Random(seed)
    rows = [(i, [scale * rng.gauss(0, 1) for _ in range(components)]) for i in range(n)]
    rows += [(i, rows[0][1]) for i in range(500, 520)]  # a common vector
    return rows + [rows[3], rows[3], (None, rows[4][1]), (None, rows[5][1]), (200, None), (201, []),
                   (202, rows[6][1][:-1]), (203, rows[6][1] + [0.5]), (204, [None] * components),
                   (205, [float("nan")] * components), (206, [float("-inf")] * components)]


@pytest.mark.parametrize("components, k, rounds", [(4, 7, 3), (8, 1, 2), (3, 16, 0)])
def test_matches_plain_code(spark, components, k, rounds):
    rows = _rows(components)
    got = centroids.cluster(_table(spark, rows), k=k, rounds=rounds, components=components)
    _same(got, _plain(rows, k, rounds, components))


def test_equal_vectors_leave_centroids_empty(spark):
    rows = [(i, [1.0, -1.0]) for i in range(30)] + [(99, [5.0, 5.0])]
    _same(centroids.cluster(_table(spark, rows), k=8, components=2), _plain(rows, 8, 3, 2))


def test_fewer_vectors_than_centroids(spark):
    rows = [(1, [0.5, 0.25]), (2, [-0.5, 3.0])]
    _same(centroids.cluster(_table(spark, rows), k=16, components=2), _plain(rows, 16, 3, 2))


@pytest.mark.parametrize("scale", [1e8, 1e12, 1e30])
def test_sums_beyond_64_bits_are_exact(spark, scale):
    rows = _rows(4, n=40, scale=scale)
    _same(centroids.cluster(_table(spark, rows), k=5, components=4), _plain(rows, 5, 3, 4))


def test_empty(spark):
    got = centroids.cluster(_table(spark, []))
    assert got.collect() == [] and centroids.cluster(_table(spark, [(1, None)])).collect() == []
    assert got.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"),
                          ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")]


def test_no_python_on_the_path_and_partial_sums(spark, capsys):
    whole = centroids.whole_vectors(_table(spark, _rows(4)), components=4)
    near = centroids._nearest([[0, 0, 0, 0], [1, 2, 3, 4]], "long")
    whole.withColumn("own", centroids._dot(whole["e"], whole["e"], "long")).select(near["cluster"].alias("c")).groupBy("c").count().explain()
    plan = capsys.readouterr().out
    assert "partial_count" in plan and not any(w in plan for w in ("Python", "Pandas", "Arrow"))

"""H2, G4: the change feed between two snapshots."""

from __future__ import annotations

import random

from pluvio.operators import changes

SCHEMA = "id string, " + ", ".join(f"{c} string" for c in changes.VALUES)


def _snapshot(spark, rows):
    return spark.createDataFrame([(i, *v) for i, v in rows], SCHEMA)


def _random(rng, ids):
    return [(i, tuple(rng.choice([None, "", "n", "a", "v"]) for _ in changes.VALUES)) for i in ids]


def test_feed_matches_plain_code_and_applies(spark):
    rng = random.Random(2)
    old = _random(rng, [f"s{i}" for i in range(40)] + [None])
    new = [(i, v if rng.random() < 0.5 else w) for (i, v), (_, w) in zip(old[5:], _random(rng, range(36)))]
    new += _random(rng, ["t1", "t2"])
    was, now = dict(old), dict(new)
    want = {}
    for i in was.keys() | now.keys():
        if i not in was:
            want[i] = ("insert", [], now[i])
        elif i not in now:
            want[i] = ("delete", [], (None,) * len(changes.VALUES))
        elif was[i] != now[i]:
            want[i] = ("update", [c for c, a, b in zip(changes.VALUES, was[i], now[i]) if a != b], now[i])
    a, b = _snapshot(spark, old), _snapshot(spark, new)
    feed = changes.snapshot_changes(a, b)
    got = {r["id"]: (r["change"], r["changed"], tuple(r[c] for c in changes.VALUES)) for r in feed.collect()}
    assert got == want and {c for c, *_ in want.values()} == {"insert", "update", "delete"}
    after = changes.apply_changes(a, feed)
    assert {tuple(r) for r in after.collect()} == {(i, *v) for i, v in new}
    assert {tuple(r) for r in changes.apply_changes(after, feed).collect()} == {(i, *v) for i, v in new}  # twice


def test_equal_snapshots_and_empty_ones(spark):
    some, none = _snapshot(spark, _random(random.Random(1), ["a", "b"])), _snapshot(spark, [])
    assert changes.snapshot_changes(some, some.union(some)).collect() == []
    assert changes.snapshot_changes(none, none).collect() == []
    assert {r.change for r in changes.snapshot_changes(none, some).collect()} == {"insert"}
    assert changes.apply_changes(some, changes.snapshot_changes(some, none)).collect() == []


def test_both_sides_are_read_once(spark, tmp_root):
    rows = _random(random.Random(3), [f"s{i}" for i in range(20)])
    for name, part in (("old", rows), ("new", rows[3:])):
        _snapshot(spark, part).write.parquet(f"{tmp_root}/{name}")
    feed = changes.snapshot_changes(spark.read.parquet(f"{tmp_root}/old"), spark.read.parquet(f"{tmp_root}/new"))
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "NestedLoop" not in plan and feed.count() == 3

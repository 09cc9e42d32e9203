"""B7, B8: runs of missing pages and days."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from pluvio.operators import gaps

PAGES = "request string, part int, metadata struct<resultset:struct<offset:long,count:long,limit:long>>, results array<string>"


def _page(request, offset, part=1):
    return request, part, ((offset, None, None),), []


def test_missing_pages_match_plain_code(spark):
    rng = random.Random(6)
    totals = {f"r{i}": rng.choice([0, 1, 9, 10, 11, 95, 230]) for i in range(25)} | {None: 35}
    landed, want = [], []
    for request, total in totals.items():
        offsets = list(range(1, total + 1, 10))
        there = {o for o in offsets if rng.random() < 0.55}
        landed += [_page(request, o) for o in there] + [_page(request, o) for o in there if rng.random() < 0.3]
        run = []
        for o in [*offsets, None]:
            if o is not None and o not in there:
                run.append(o)
            elif run:
                want.append((request, run[0], len(run), sum(min(10, total - x + 1) for x in run)))
                run = []
    landed += [_page("r0", 4), _page("r1", None), _page("r2", 10_001), _page("not asked for", 1), _page("not asked for", 91)]
    requests = spark.createDataFrame([(r, 1, t) for r, t in totals.items()] + [("nothing", 1, None)],
                                     "request string, part int, total long")
    got = gaps.missing_pages(requests, spark.createDataFrame(landed, PAGES), ["request", "part"], limit=10)
    key = lambda r: (r[0] is None, r[0] or "", r[1])
    assert sorted(((r.request, r.offset, r.pages, r.rows) for r in got.collect()), key=key) == sorted(want, key=key)


def test_missing_days_and_fewest_requests_match_plain_code(spark):
    rng = random.Random(9)
    day = lambda n: dt.date(2000, 2, 20) + dt.timedelta(n)
    spans = [("a", 0, 40), ("b", 5, 5), ("c", 0, 10), ("c", 8, 30), ("d", 10, 9), ("e", 0, 100)]
    present = [(s, day(rng.randrange(-5, 60))) for s in "abcde" for _ in range(25) if s != "e"] + [("z", day(3)), ("a", None)]
    want = []
    for station in "abce":
        own = [(s, e) for k, s, e in spans if k == station]
        there = {d for k, d in present if k == station}
        run = []
        for n in range(min(s for s, _ in own), max(e for _, e in own) + 2):
            if n <= max(e for _, e in own) and day(n) not in there:
                run.append(day(n))
            elif run:
                want += [(station, run[i], run[i:i + 7][-1]) for i in range(0, len(run), 7)]
                run = []
    missing = gaps.missing_days(
        spark.createDataFrame([(k, day(s), day(e)) for k, s, e in spans], "station string, start date, end date"),
        spark.createDataFrame(present * 2, "station string, day date"), ["station"])
    got = gaps.fewest_requests(missing, 7)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    with pytest.raises(ValueError):
        gaps.fewest_requests(missing, 0)


def test_nothing_asked_for(spark):
    none = spark.createDataFrame([], "station string, start date, end date")
    present = spark.createDataFrame([("a", dt.date(2000, 1, 1))], "station string, day date")
    assert gaps.missing_days(none, present, ["station"]).collect() == []

"""What is not there yet: runs of missing pages and days, in the fewest requests.

Gaps are found between what is there, not by listing all that should be: the
present places of a request and two sentinels (just before its first place,
just behind its last) are sorted, and whatever lies between two neighbours is
one gap. So the work grows with what was landed and with the number of
requests, not with the length of the spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import PAGE_LIMIT


def _gaps(present: DataFrame, spans: DataFrame, keys: list[str], at: str, step: Column) -> DataFrame:
    """(keys, before, after, total): neighbours more than ``step`` apart.
    ``spans`` has the sentinels ``before`` and ``after`` of each request, and
    its total; what is present of other requests, or outside, does not count."""
    edges = spans.select(*keys, F.explode(F.array("before", "after")).alias(at), F.col("before").alias("_low"),
                         F.col("after").alias("_high"), F.col("total").alias("_total"))
    both = present.select(*keys, at).unionByName(edges, allowMissingColumns=True)
    request = Window.partitionBy(*keys)
    whole = both.withColumns({c: F.max(c).over(request) for c in ("_low", "_high", "_total")})
    following = F.lead(at).over(request.orderBy(at))
    return (whole.where(F.col(at).between(F.col("_low"), F.col("_high")))
            .select(*keys, F.col(at).alias("before"), following.alias("after"), F.col("_total").alias("total"))
            .where(F.col("after") > F.col("before") + step))


def _distinct(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    return df.select(*keys, at).where(F.col(at).isNotNull()).distinct()


def missing_pages(requests: DataFrame, pages: DataFrame, keys, total: str = "total",
                  limit: int = PAGE_LIMIT) -> DataFrame:
    """(keys, offset, pages, rows): runs of missing pages of each request,
    the first one's offset and how many pages and rows the run has.

    ``requests`` has the declared ``total`` of each request once; ``pages``
    (see ``read_pages``) what was landed of it. Pages that were landed twice
    count once, unreadable ones and those off the page grid not at all. A
    total of 0 or NULL needs no page; a NULL key is a key.
    """
    keys = list(keys)
    declared = requests.select(*keys, F.coalesce(F.col(total).cast("long"), F.lit(0)).alias("_total")).where("_total > 0")
    count = F.ceil(F.col("_total") / limit).cast("long")
    spans = declared.select(*keys, F.lit(1 - limit).cast("long").alias("before"), (count * limit + 1).alias("after"),
                            F.col("_total").alias("total"))
    offset = F.col("metadata.resultset.offset")
    there = _distinct(pages.select(*keys, offset.alias("offset")).where((F.col("offset") - 1) % limit == 0), keys, "offset")
    gaps = _gaps(there, spans, keys, "offset", F.lit(limit))
    first, run = F.col("before") + limit, ((F.col("after") - F.col("before")) / limit - 1).cast("long")
    return gaps.select(*keys, first.alias("offset"), run.alias("pages"),
                       F.least(run * limit, F.col("total") - first + 1).alias("rows"))


def missing_days(spans: DataFrame, present: DataFrame, keys, start: str = "start", end: str = "end",
                 day: str = "day") -> DataFrame:
    """(keys, start, end): runs of days of each key's span with nothing
    present. Overlapping or repeated spans of a key count as one from the
    first start to the last end; a span that ends before it starts has none."""
    keys = list(keys)
    whole = (spans.where(F.col(start) <= F.col(end)).groupBy(*keys)
             .agg(F.date_sub(F.min(start), 1).alias("before"), F.date_add(F.max(end), 1).alias("after"),
                  F.lit(None).cast("long").alias("total")))
    gaps = _gaps(_distinct(present, keys, day), whole, keys, day, F.expr("interval 1 day"))
    return gaps.select(*keys, F.date_add("before", 1).alias("start"), F.date_sub("after", 1).alias("end"))


def fewest_requests(gaps: DataFrame, max_days: int) -> DataFrame:
    """Gaps (start, end) as requests of at most ``max_days`` days each: a gap
    needs as many as its length divided by that, rounded up."""
    if max_days < 1:
        raise ValueError("max_days must be a positive integer")
    nth = F.sequence(F.lit(0), F.floor(F.datediff("end", "start") / max_days).cast("int"))
    others = [c for c in gaps.columns if c not in ("start", "end")]
    first = F.date_add("start", F.col("_nth") * max_days)
    return gaps.where("start <= end").select("*", F.explode(nth).alias("_nth")).select(
        *others, first.alias("start"), F.least(F.date_add(first, max_days - 1), F.col("end")).alias("end"))

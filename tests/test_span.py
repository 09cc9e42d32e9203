from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pluvio import fixtures as fx
from pluvio.plans.registry import _observed_span, span_requests

from conftest import SF_SMALL

D = dt.date


def test_two_requests_leave_out_one_month(spark):  # J4
    span = spark.createDataFrame([(D(1992, 1, 2), D(1998, 12, 1))], "first date, last date")
    assert [tuple(r) for r in span_requests(span).orderBy("s").collect()] == [
        (D(1992, 1, 2), D(1995, 5, 31)), (D(1995, 7, 1), D(1998, 12, 1))]


def test_requests_cover_nearly_all_rows(spark):  # J4
    rows = fx.fx_observations(spark, SF_SMALL).select(F.col("date").cast("timestamp").cast("date").alias("d"))
    ranges = [tuple(r) for r in span_requests(_observed_span(spark, SF_SMALL)).collect()]
    days = [r.d for r in rows.collect()]
    asked = sum(any(s <= d <= e for s, e in ranges) for d in days)
    assert len(ranges) == 2 and 0.97 * len(days) < asked < len(days)

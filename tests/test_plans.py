"""Plan-shape and property tests."""

from __future__ import annotations

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from pluvio import fixtures as fx
from pluvio.operators import joins
from pluvio.operators.observations import pivot_daily
from pluvio.operators.periods import periods
from pluvio.plans import views
from pluvio.plans.registry import curated_inputs
from pluvio.sinks import landing, tables
from pluvio.sources import observations
from pluvio.sources.observations import scan_observations

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_anomaly_uses_window_not_self_join(spark):
    df = views.precipitation_anomaly_by_state_by_year(*curated_inputs(spark, SF_SMALL))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan
    assert "Window" in plan


def test_station_join_broadcasts_dimension(spark):
    rs = joins.join_observations_stations(*curated_inputs(spark, SF_SMALL))
    plan = rs._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan


def test_pivot_single_exchange(spark):
    df = pivot_daily(fx.fx_observations(spark, SF_SMALL))
    plan = _plan(df)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max" in plan


def test_period_scan_prunes_partitions(spark, tmp_root):
    obs = spark.createDataFrame(
        [("GHCND:A", f"2000-01-0{d}T00:00:00", "TMAX", float(d)) for d in range(1, 6)],
        "station string, date string, datatype string, value double")
    landing.land_observations(obs, tmp_root + "/raw")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    df = scan_observations(spark, tmp_root + "/raw", "2000-01-02", "2000-01-03", ["TMAX"])
    plan = df._jdf.queryExecution().sparkPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [" in plan and "make_date" in plan
    assert sorted(r.day for r in df.collect()) == [2, 3]


def test_upsert_prunes_stored_months_by_literal(spark, tmp_root):
    path = tmp_root + "/results"
    tables.ensure_table(spark, path, "transformed_results")
    rows = [(f"A_{y}{m:02d}01", "A", dt.date(y, m, 1), 1.0, None, None, None) for y in (1999, 2000, 2001)
            for m in range(1, 13)]
    stored = spark.createDataFrame(rows, tables.TRANSFORMED_RESULTS)
    tables.upsert_observations(stored, path)
    batch = stored.where("date = '2000-05-01'").selectExpr("*", "year(date) as year", "month(date) as month")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    kept = tables.touched_months(tables.read_table(spark, path, "transformed_results"), batch)
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
    assert "2000" in filters and ">= 5" in filters and "<= 5" in filters
    assert [r.id for r in kept.collect()] == ["A_20000501"]


def test_observation_job_reads_raw_files_once(spark, tmp_root, monkeypatch):
    from pluvio.plans import jobs

    layout = jobs.Layout(tmp_root)
    landing.land_observations(spark.createDataFrame(
        [("GHCND:A", f"2000-01-{d:02d}T00:00:00", t, float(d)) for d in range(1, 21) for t in ("TMAX", "PRCP")],
        "station string, date string, datatype string, value double"), layout.raw_results)
    read = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda c: read.add(1) or c, "string")
    reader = observations._reader

    def watched(spark, schema, multiline, mode="PERMISSIVE"):
        class Reader:
            def json(self, root):
                return reader(spark, schema, multiline, mode).json(root).withColumn("station", counted("station"))
        return Reader()

    monkeypatch.setattr(observations, "_reader", watched)
    got = jobs.job_transform_observations(spark, layout, "2000-01-01", "2000-01-31")
    assert (got["rows"], got["skipped_days"]) == (20, 0)
    assert read.value == 40  # every landed row was read once


def test_rainy_filter_reaches_scan(spark, tmp_root):
    r, s = curated_inputs(spark, SF_SMALL)
    path = tmp_root + "/r"
    r.write.parquet(path)
    df = views.rainy_days_by_state_by_year(spark.read.parquet(path), s)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [IsNotNull(prcp), GreaterThan(prcp,0.0)" in plan


def test_new_ids_equal_subtract(spark):
    obs, known = fx.fx_observations(spark, SF_SMALL), fx.fx_stations(spark, SF_SMALL)
    a = {r.id for r in joins.new_station_ids(obs, known).collect()}
    b = {r.station for r in obs.select("station").subtract(known.select("id")).collect()}
    assert a == b


def test_precipitation_years_sum_to_state_total(spark):
    r, s = curated_inputs(spark, SF_SMALL)
    by_year = views.precipitation_by_state_by_year(r, s).groupBy("state").sum("total_precipitation")
    per_year = {x[0]: x[1] for x in by_year.collect()}
    rs = joins.join_observations_stations(r, s).groupBy("state").sum("prcp")
    total = {x[0]: (x[1] or 0.0) for x in rs.collect()}
    assert per_year == total


@settings(max_examples=12, deadline=None)
@given(start=st.dates(dt.date(1999, 1, 1), dt.date(2001, 12, 31)),
       days=st.integers(0, 800),
       freq=st.sampled_from(["daily", "monthly", "yearly", "custom"]),
       step=st.integers(1, 40))
def test_periods_tile_the_range(spark, start, days, freq, step):
    end = start + dt.timedelta(days=days)
    got = sorted((p.start, p.end) for p in
                 periods(spark, start.isoformat(), end.isoformat(), freq, step).collect())
    assert got[0][0] == start and got[-1][1] == end
    for (s1, e1), (s2, _e2) in zip(got, got[1:]):
        assert s1 <= e1 and s2 == e1 + dt.timedelta(days=1)

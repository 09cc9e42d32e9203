"""The month cube: one pass over the facts, mergeable, refreshed by month."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pluvio.plans import cube, jobs, views
from pluvio.plans.registry import curated_inputs
from pluvio.sinks import tables

from conftest import SF_SMALL

D = dt.date


def _random_results(spark, seed=1, n=600):
    rng = random.Random(seed)
    rows = {}
    for _ in range(n):
        station, day = f"S{rng.randrange(8)}", D(2000, 1, 1) + dt.timedelta(rng.randrange(800))
        value = lambda: rng.choice([None, float(rng.randrange(-20, 40))])
        rows[station, day] = (f"{station}_{day:%Y%m%d}", station, day, value(), value(), value(),
                              rng.choice([None, 0.0, 0.0, 3.0, -1.0]))
    rows["S9", D(2000, 2, 29)] = ("S9_20000229", "S9", D(2000, 2, 29), None, None, None, None)
    return spark.createDataFrame(list(rows.values()), tables.TRANSFORMED_RESULTS)


def _dimension(spark, results):
    """Three states; the last two stations are not in the dimension."""
    return results.select(F.col("station").alias("id")).distinct().where("id < 'S7'").withColumn(
        "state", F.concat(F.lit("T"), (F.substring("id", 2, 1).cast("int") % 3).cast("string")))


@pytest.mark.parametrize("name", sorted(views.VIEWS))
def test_roll_ups_equal_the_views(spark, name):
    results = _random_results(spark)
    dim = _dimension(spark, results)
    want = views.VIEWS[name](results, dim)
    got = cube.VIEWS[name](cube.month_cube(results), dim)
    assert got.dtypes == want.dtypes
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_bitmap_equals_distinct_days(spark):
    results = _random_results(spark, 5)
    dim = _dimension(spark, results)
    got = cube.rainy_days_by_bitmap(results, dim)
    assert got.collect() == views.rainy_days_by_state_by_year(results, dim).collect() and got.count() > 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "distinct" not in plan.lower() and "partial_bit_or" in plan


def test_every_day_of_a_month_has_its_bit(spark):
    rows = [(f"A_{d}", "A", D(2001, 1, d), None, None, None, 1.0) for d in range(1, 32)]
    one, = cube.month_cube(spark.createDataFrame(rows, tables.TRANSFORMED_RESULTS)).collect()
    assert one.wet == (1 << 31) - 1 and one.prcp_n == 31


def _stored(spark, layout, results):
    tables.ensure_table(spark, layout.results, "transformed_results")
    tables.ensure_table(spark, layout.stations, "transformed_stations")
    tables.upsert_observations(results, layout.results)
    stations = _dimension(spark, results).selectExpr(
        "id", "id as name", "0D as latitude", "0D as longitude", "0D as elevation", "'M' as elevation_unit", "state",
        "1D as datacoverage", "date'2000-01-01' as mindate", "date'2001-01-01' as maxdate")
    tables.upsert_stations(stations, layout.stations)


def _reads(spark, monkeypatch):
    """A counter of the stored facts that are read from now on."""
    seen, read = spark.sparkContext.accumulator(0), tables.read_table
    watch = F.udf(lambda v: seen.add(1) or v, "double")

    def watched(session, path, name):
        df = read(session, path, name)
        return df.withColumn("tmax", watch("tmax")) if name == "transformed_results" else df

    monkeypatch.setattr(tables, "read_table", watched)
    return seen


def test_a_refresh_reads_the_facts_once(spark, tmp_root, monkeypatch):
    layout = jobs.Layout(tmp_root)
    results = _random_results(spark)
    _stored(spark, layout, results)
    seen = _reads(spark, monkeypatch)
    report = jobs.job_presentation(spark, layout)
    assert len(report) == 11 and all(isinstance(n, int) for n in report.values()), report
    assert seen.value == results.count()


def test_a_delta_refresh_reads_one_month_and_equals_a_full_one(spark, tmp_root, monkeypatch):
    layout = jobs.Layout(tmp_root)
    results = _random_results(spark)
    _stored(spark, layout, results.withColumn("prcp", F.when(F.month("date") != 5, F.col("prcp"))))
    jobs.job_presentation(spark, layout)
    load = results.where("date between '2000-05-01' and '2000-05-31'")
    tables.upsert_observations(load, layout.results)
    seen = _reads(spark, monkeypatch)
    months = spark.createDataFrame([(2000, 5)], "year int, month int")
    jobs.job_presentation(spark, layout, months=months)
    assert seen.value == load.count()
    monkeypatch.undo()
    delta = {v: sorted(map(tuple, tables.read_table(spark, layout.presentation(v), f"presentation_{v}").collect()))
             for v in views.VIEWS}
    jobs.job_presentation(spark, layout)
    for v in views.VIEWS:
        assert sorted(map(tuple, tables.read_table(spark, layout.presentation(v), f"presentation_{v}").collect())) == delta[v]


def test_only_the_folders_of_the_month_are_listed(spark, tmp_root):
    layout = jobs.Layout(tmp_root)
    _stored(spark, layout, _random_results(spark))
    facts = tables.read_table(spark, layout.results, "transformed_results")
    months = spark.createDataFrame([(2001, 3)], "year int, month int")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = cube.month_cube(tables.touched_months(facts, months))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = re.findall(r"FileScan parquet.*?PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert len(scans) == 1 and "2001" in scans[0] and ">= 3" in scans[0] and "<= 3" in scans[0]


def test_a_refresh_without_new_rows_changes_nothing(spark, tmp_root):
    layout = jobs.Layout(tmp_root)
    _stored(spark, layout, _random_results(spark))
    jobs.job_presentation(spark, layout)
    none = spark.createDataFrame([], "year int, month int")
    assert jobs.refresh_cube(spark, layout, none) == 0
    assert tables.read_table(spark, layout.cube, "month_cube").count() > 100


def test_cube_equals_the_contract(spark):
    from pluvio.operators.conform import conform_schema

    made = conform_schema(cube.month_cube(curated_inputs(spark, SF_SMALL)[0]), tables.table_schema("month_cube"))
    assert made.count() > 0 and made.columns == tables.table_schema("month_cube").fieldNames()

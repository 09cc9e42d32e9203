"""A view or a cube that was not made is an error, never an older result."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pluvio.plans import jobs, registry
from pluvio.sinks import tables

from conftest import SF_SMALL

D = dt.date
BROKEN = "avg_temp_by_season"


def _break(monkeypatch, turn: int) -> list[int]:
    """Break a view the ``turn``-th time that it is made; gives the turns so far."""
    whole, turns = jobs.VIEWS[BROKEN], []

    def made(*args, **kwargs):
        turns.append(len(turns) + 1)
        if turns[-1] == turn:
            raise ValueError("no such season")
        return whole(*args, **kwargs)

    monkeypatch.setitem(jobs.VIEWS, BROKEN, made)
    return turns


@pytest.mark.parametrize("turn", [1, 2])
def test_a_delta_refresh_does_not_pass_off_old_rows(spark, monkeypatch, turn):
    turns = _break(monkeypatch, turn)
    with pytest.raises(jobs.ViewsFailed, match="ValueError: no such season") as error:
        registry.QUERIES["job_delta_refresh"](spark, SF_SMALL)
    assert turns[-1] == turn and list(error.value.failed) == [BROKEN]
    assert len(error.value.report) == 11  # the others were refreshed all the same


def test_a_presentation_names_the_view_that_failed(spark, monkeypatch):
    _break(monkeypatch, 1)
    with pytest.raises(jobs.ViewsFailed, match=BROKEN):
        registry.QUERIES["job_presentation"](spark, SF_SMALL)


def test_a_whole_report_passes():
    report = {"station_summary": 0, "monthly_avg_temp": 3}
    assert jobs.all_refreshed(report) is report


def test_a_pipeline_with_a_failed_view_fails(spark, tmp_root, monkeypatch):
    layout = jobs.Layout(tmp_root)
    obs = spark.createDataFrame([("GHCND:S1", "1990-01-05T00:00:00", "TMAX", 1.0)],
                                "station string, date string, datatype string, value double")
    requests = spark.createDataFrame([("1990-01-01", "1990-01-31")], "start_date string, end_date string")
    catalog = spark.createDataFrame(
        [("GHCND:S1", "n", -10.5, -40.5, 5.0, "METERS", 1.0, "1990-01-01", "2001-01-01")],
        "id string, name string, latitude double, longitude double, elevation double, "
        "elevationUnit string, datacoverage double, mindate string, maxdate string")
    cells = spark.createDataFrame([(-11, -41, "Bahia")], "cell_lat int, cell_lon int, state_name string")
    _break(monkeypatch, 1)
    with pytest.raises(jobs.ViewsFailed, match=BROKEN) as error:
        jobs.job_pipeline(spark, layout, obs, requests, catalog, cells, run_date=D(2024, 1, 1))
    done = error.value.report
    assert done["observations"]["rows"] == done["stations"]["upserted"] == 1
    assert done["views"][BROKEN] == "ValueError: no such season" and list(error.value.failed) == [BROKEN]


def _facts(spark, layout):
    """Rain on a day of each of six months."""
    rows = [(f"S1_2000{m:02d}01", "S1", D(2000, m, 1), None, None, None, float(m)) for m in range(1, 7)]
    tables.ensure_table(spark, layout.results, "transformed_results")
    tables.ensure_table(spark, layout.stations, "transformed_stations")
    tables.upsert_observations(spark.createDataFrame(rows, tables.TRANSFORMED_RESULTS), layout.results)


def _fail(*_args, **_kwargs):
    raise OSError("lost")


def _half_written(write):
    """The write of the cube fails in the task that has June."""
    def failing(df, path, name, by_folder=False):
        if name == "month_cube" and "days" in df.columns and df.count():
            df = df.withColumn("days", F.expr("if(month = 6, raise_error('lost'), days)"))
        write(df, path, name, by_folder)

    return failing


@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("step", ["_staged_batch", "_write"])
def test_a_cube_that_failed_is_made_whole_by_a_delta(spark, tmp_root, monkeypatch, step, before):
    layout = jobs.Layout(tmp_root)
    _facts(spark, layout)
    if before:
        jobs.job_presentation(spark, layout)
    monkeypatch.setattr(tables, step, _fail if step == "_staged_batch" else _half_written(tables._write))
    with pytest.raises((OSError, tables.ReplaceFailed)):
        jobs.job_presentation(spark, layout)
    monkeypatch.undo()
    months = spark.createDataFrame([(2000, 5)], "year int, month int")
    jobs.job_presentation(spark, layout, months=months)
    assert tables.read_table(spark, layout.cube, "month_cube").count() == 6
    name = "central_tendence_tmin_tmax_by_month"
    assert tables.read_table(spark, layout.presentation(name), f"presentation_{name}").count() == 6


def test_a_delta_after_a_whole_cube_stays_a_delta(spark, tmp_root):
    layout = jobs.Layout(tmp_root)
    _facts(spark, layout)
    months = spark.createDataFrame([(2000, 5)], "year int, month int")
    assert [jobs.refresh_cube(spark, layout, m) for m in (months, months, None, months)] == [6, 1, 6, 1]

"""H1, D1: compacted months beside raw days; bucketed tables."""

from __future__ import annotations

import datetime as dt

from pluvio.operators.joins import join_observations_stations
from pluvio.plans import jobs
from pluvio.plans.registry import curated_inputs
from pluvio.session import work_path
from pluvio.sinks import bucketed, compaction, files, landing
from pluvio.staging import scratch, stage

from conftest import SF_SMALL

OBS = "station string, date string, datatype string, attributes string, value double"
D = dt.date


def _obs(spark, days, value, station="A", datatype="TMAX"):
    return spark.createDataFrame([(station, f"{d}T00:00:00", datatype, None, value) for d in days], OBS)


def _rows(spark, raw, compact, **how):
    return sorted((r.station, r.date[:10], r.datatype, r.value, r.year, r.month, r.day)
                  for r in compaction.scan_landed(spark, raw, compact, **how).collect())


def test_months_are_compacted_and_raw_days_win(spark, tmp_root):
    raw, compact = tmp_root + "/raw", tmp_root + "/compact"
    assert _rows(spark, raw, compact) == []
    assert compaction.compact_months(spark, raw, compact, "2000-01-01", "2000-12-31") == {"months": 0, "rows": 0}
    days = [f"2000-01-{d:02d}" for d in (1, 2, 3)] + ["2000-02-01", "2001-01-01"]
    landing.land_observations(_obs(spark, days, 1.0).union(_obs(spark, days[:2], 5.0, datatype="PRCP")), raw)
    before = _rows(spark, raw, compact)
    assert len(before) == 7
    done = compaction.compact_months(spark, raw, compact, "2000-01-01", "2000-12-31")
    assert done == {"months": 3, "rows": 6}
    assert _rows(spark, raw, compact) == before
    assert not files.exists(spark, raw + "/datatype=TMAX/year=2000/month=01/day=01")
    assert files.exists(spark, raw + "/datatype=TMAX/year=2001/month=01/day=01")
    # a day is landed again, whole, and a new one: the other days stay
    landing.land_observations(_obs(spark, ["2000-01-02"], 9.0, station="B").union(_obs(spark, ["2000-01-09"], 2.0)), raw)
    want = sorted([r for r in before if r[1:3] != ("2000-01-02", "TMAX")]
                  + [("B", "2000-01-02", "TMAX", 9.0, 2000, 1, 2), ("A", "2000-01-09", "TMAX", 2.0, 2000, 1, 9)])
    assert _rows(spark, raw, compact) == want
    for _ in range(2):  # merged with what was compacted; again changes nothing
        compaction.compact_months(spark, raw, compact, "2000-01-01", "2001-12-31")
        assert _rows(spark, raw, compact) == want
    assert _rows(spark, raw, compact, start="2000-01-02", end="2000-01-03", datatypes=["TMAX"]) == [
        r for r in want if r[1] in ("2000-01-02", "2000-01-03") and r[2] == "TMAX"]


def test_a_run_that_died_before_it_deleted_is_harmless(spark, tmp_root, monkeypatch):
    raw, compact = tmp_root + "/raw", tmp_root + "/compact"
    landing.land_observations(_obs(spark, ["2000-01-01", "2000-01-02"], 1.0), raw)
    before = _rows(spark, raw, compact)
    delete = files.delete
    monkeypatch.setattr(compaction.files, "delete", lambda s, path: None if "/raw/" in path else delete(s, path))
    compaction.compact_months(spark, raw, compact, "2000-01-01", "2000-01-31")
    assert _rows(spark, raw, compact) == before
    monkeypatch.undo()
    compaction.compact_months(spark, raw, compact, "2000-01-01", "2000-01-31")
    assert _rows(spark, raw, compact) == before


def test_a_month_with_an_unreadable_record_stays_raw(spark, tmp_root):
    raw, compact = tmp_root + "/raw", tmp_root + "/compact"
    landing.land_observations(_obs(spark, ["2000-01-01", "2000-02-01"], 1.0), raw)
    spark.createDataFrame([("{ not json",)], "value string").write.mode("append").text(
        raw + "/datatype=TMAX/year=2000/month=01/day=01")
    assert compaction.compact_months(spark, raw, compact, "2000-01-01", "2000-12-31")["months"] == 1
    assert files.exists(spark, raw + "/datatype=TMAX/year=2000/month=01/day=01")
    assert not files.exists(spark, raw + "/datatype=TMAX/year=2000/month=02/day=01")


def test_bucketed_join_shuffles_neither_side(spark, tmp_root):
    results, dim = curated_inputs(spark, SF_SMALL)
    names = [bucketed.write_bucketed(results, "t_results_bucketed", tmp_root + "/r", "station", 4),
             bucketed.write_bucketed(dim, "t_stations_bucketed", tmp_root + "/s", "id", 4)]
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = bucketed.join_bucketed(spark, *names)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Broadcast" not in plan
        # the same join of tables that are not bucketed, beyond the (lowered) bound, shuffles both
        spark.table(names[0]).write.parquet(tmp_root + "/plain_r")
        spark.table(names[1]).write.parquet(tmp_root + "/plain_s")
        plain = join_observations_stations(spark.read.parquet(tmp_root + "/plain_r"),
                                           spark.read.parquet(tmp_root + "/plain_s"), max_broadcast_rows=1)
        assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert sorted(map(tuple, joined.select("id", "state").collect())) == sorted(
            map(tuple, plain.select("id", "state").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"drop table {name}")


def test_staged_copies_go_with_their_scope(spark):
    rows = spark.range(3)
    kept = stage(rows, spark, "scope-test")[1]
    try:
        with scratch(spark):
            outer = stage(rows, spark, "scope-test")[1]
            with scratch(spark) as paths:
                inner, left = (stage(rows, spark, "scope-test")[1] for _ in range(2))
                paths.remove(left)
            assert not files.exists(spark, inner) and files.exists(spark, outer)
            raise ValueError
    except ValueError:
        pass
    assert not files.exists(spark, outer) and files.exists(spark, kept) and files.exists(spark, left)
    for path in (kept, left):
        files.delete(spark, path)


def test_no_copies_are_left_after_a_pipeline(spark, tmp_root):
    stages = work_path(spark, "stage")

    def left():
        names = files.folders(spark, stages) if files.exists(spark, stages) else []
        return {(n, f) for n in names for f in files.folders(spark, f"{stages}/{n}")}

    before, layout = left(), jobs.Layout(tmp_root)
    obs = _obs(spark, ["2000-01-05", "2000-01-06"], 1.0, station="GHCND:S1")
    catalog = spark.createDataFrame(
        [("GHCND:S1", "n", -10.5, -40.5, 5.0, "METERS", 1.0, "1990-01-01", "2001-01-01")],
        "id string, name string, latitude double, longitude double, elevation double, "
        "elevationUnit string, datacoverage double, mindate string, maxdate string")
    cells = spark.createDataFrame([(-11, -41, "Bahia")], "cell_lat int, cell_lon int, state_name string")
    ask = lambda *r: spark.createDataFrame([r], "start_date string, end_date string")
    report = jobs.job_pipeline(spark, layout, obs, ask("2000-01-01", "2000-01-31"), catalog, cells, run_date=D(2024, 1, 1))
    assert report["observations"]["rows"] == 2 and report["views"]["station_summary"] == 1
    assert jobs.job_pipeline(spark, layout, None, ask("2000-01-31", "2000-01-01"), catalog, cells) == {"periods": 0}
    assert left() == before

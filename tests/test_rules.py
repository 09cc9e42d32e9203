"""
hand-made rows each."""

from __future__ import annotations

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.operators import joins, stations
from pluvio.operators.conform import ContractError, conform_schema
from pluvio.operators.observations import pivot_daily
from pluvio.operators.periods import generate_periods, invalid_period_requests, periods
from pluvio.plans import views
from pluvio.schemas import PRESENTATION, TRANSFORMED_STATIONS
from pluvio.session import local_path, work_path
from pluvio.sinks import landing, tables
from pluvio.sources.observations import scan_observations, tolerant_scan

D = dt.date
OBS = "station string, date string, datatype string, value double"


def _obs(spark, rows):
    return spark.createDataFrame(rows, OBS)


def _stations(spark, rows):
    full = [(i, f"n{i}", 0.0, 0.0, 0.0, "METERS", st, 1.0, D(2000, 1, 1), D(2001, 1, 1))
            for i, st in rows]
    return spark.createDataFrame(full, TRANSFORMED_STATIONS)


def test_pivot_max_nulls_and_unknown_types(spark):  # M1, M2, M3
    df = _obs(spark, [
        ("GHCND:A1", "2000-01-05T00:00:00", "TMAX", 30.0),
        ("GHCND:A1", "2000-01-05T00:00:00", "TMAX", 31.0),
        ("GHCND:A1", "2000-01-05T00:00:00", "PRCP", 2.0),
        ("GHCND:B2", "2000-01-05T00:00:00", "SNOW", 9.0),
    ])
    got = {r["id"]: r for r in pivot_daily(df).collect()}
    assert set(got) == {"A1_20000105", "B2_20000105"}
    a = got["A1_20000105"]
    assert (a.station, a.date, a.tmax, a.tmin, a.tavg, a.prcp) == \
        ("GHCND:A1", D(2000, 1, 5), 31.0, None, None, 2.0)
    b = got["B2_20000105"]
    assert (b.tmax, b.tmin, b.tavg, b.prcp) == (None, None, None, None)


def test_anomaly_null_year_and_zero_mean(spark):  # M14, M15
    r = spark.createDataFrame([
        ("a", "S1", D(2000, 1, 1), None, None, None, None),   # state X, 2000: prcp NULL
        ("b", "S1", D(2001, 1, 1), None, None, None, 10.0),   # state X, 2001: 10
        ("c", "S2", D(2000, 1, 1), None, None, None, 0.0),    # state Y: mean 0
    ], "id string, station string, date date, tmax double, tmin double, tavg double, prcp double")
    s = _stations(spark, [("S1", "X"), ("S2", "Y")])
    out = {(x.state, x.year.year): x for x in
           views.precipitation_anomaly_by_state_by_year(r, s).collect()}
    x2000 = out[("X", 2000)]
    assert (x2000.total_precipitation, x2000.historical_avg_precipitation,
            x2000.anomaly_mm, x2000.anomaly_pct) == (0.0, 10.0, 0.0, 0.0)
    x2001 = out[("X", 2001)]
    assert (x2001.anomaly_mm, x2001.anomaly_pct) == (0.0, 0.0)
    y = out[("Y", 2000)]
    assert (y.historical_avg_precipitation, y.anomaly_pct) == (0.0, 0.0)


def test_rainy_days_distinct_and_orphans(spark):  # M12, M16
    r = spark.createDataFrame([
        ("a", "S1", D(2000, 3, 1), None, None, None, 1.0),
        ("b", "S2", D(2000, 3, 1), None, None, None, 5.0),   # same date, same state
        ("c", "S1", D(2000, 3, 2), None, None, None, 0.0),   # not rainy
        ("d", "ORPHAN", D(2000, 3, 3), None, None, None, 3.0),
    ], "id string, station string, date date, tmax double, tmin double, tavg double, prcp double")
    s = _stations(spark, [("S1", "X"), ("S2", "X")])
    rows = views.rainy_days_by_state_by_year(r, s).collect()
    assert [(x.state, x.rainy_days) for x in rows] == [("X", 1)]
    per_station = {x.station_id: x.total_measurements
                   for x in views.total_measurements_by_station(r, s).collect()}
    assert per_station["ORPHAN"] == 1


def test_seasons(spark):  # M17
    r = spark.createDataFrame(
        [(f"i{m}", "S", D(2000, m, 1), None, None, float(m), None) for m in range(1, 13)],
        "id string, station string, date date, tmax double, tmin double, tavg double, prcp double")
    got = [(x.season, x.avg_temp) for x in views.avg_temp_by_season(r, None).collect()]
    assert got == [("Verão", 5.0), ("Outono", 4.0), ("Inverno", 7.0), ("Primavera", 10.0)]


def test_periods_rules(spark):  # M18 - M21
    got = [(p.start, p.end) for p in periods(spark, "2024-01-15", "2024-03-10").collect()]
    assert got == [(D(2024, 1, 15), D(2024, 1, 31)), (D(2024, 2, 1), D(2024, 2, 29)),
                   (D(2024, 3, 1), D(2024, 3, 10))]
    assert periods(spark, "2024-03-10", "2024-01-15").count() == 0
    lm = periods(spark, None, None, as_of=D(2024, 3, 10)).collect()
    assert [(p.start, p.end) for p in lm] == [(D(2024, 2, 1), D(2024, 2, 29))]
    yearly = [(p.start, p.end) for p in periods(spark, "2023-06-01", "2024-02-01", "yearly").collect()]
    assert yearly == [(D(2023, 6, 1), D(2023, 12, 31)), (D(2024, 1, 1), D(2024, 2, 1))]
    custom = [(p.start, p.end) for p in
              periods(spark, "2024-01-01", "2024-01-10", "weekly-ish", 4).collect()]
    assert custom == [(D(2024, 1, 1), D(2024, 1, 4)), (D(2024, 1, 5), D(2024, 1, 8)),
                      (D(2024, 1, 9), D(2024, 1, 10))]
    req = spark.createDataFrame([("2024-01-01", "2024-01-10", "other", "0"),
                                 ("2024-01-01", "2024-01-10", "other", "x"),
                                 ("2024-13-01", "2024-01-10", "daily", None)],
                                "start_date string, end_date string, frequency string, custom_days string")
    assert generate_periods(req, D(2024, 3, 1)).count() == 0
    assert invalid_period_requests(req, D(2024, 3, 1)).count() == 3


def test_typed_stations_rejects_alone(spark):  # M8, M9
    rec = spark.createDataFrame([
        ("S1", "ok", "1.5", "2.5", "3", "METERS", "SP", "1", "2000-01-01", "2001-01-01"),
        ("S2", "bad lat", "north", "2.5", "3", "METERS", "SP", "1", "2000-01-01", "2001-01-01"),
        ("S3", "no state", "1.5", "2.5", "3", "METERS", None, "1", "2000-01-01", "2001-01-01"),
    ], ", ".join(f"{c} string" for c in stations.RECORD_COLUMNS))
    good, rejects = stations.typed_stations(rec)
    assert [r.id for r in good.collect()] == ["S1"]
    reasons = {r.id: r.reason for r in rejects.collect()}
    assert reasons == {"S2": "unparseable latitude", "S3": "missing state"}


def test_dedupe_last_wins_and_union(spark):  # M22, G4
    df = spark.createDataFrame([("S1", D(2000, 1, 1), "old"), ("S1", D(2000, 2, 1), "new"),
                                ("S2", D(2000, 1, 1), "only")],
                               "id string, snapshot_date date, name string")
    got = {r.id: r.name for r in stations.dedupe_last_wins(df).collect()}
    assert got == {"S1": "new", "S2": "only"}


def test_upsert_observations_null_overwrites_and_empty(spark, tmp_root):  # M6, M7
    path = tmp_root + "/results"
    tables.ensure_table(spark, path, "transformed_results")
    schema = "id string, station string, date date, tmax double, tmin double, tavg double, prcp double"
    first = spark.createDataFrame([("A_20000101", "A", D(2000, 1, 1), 1.0, 2.0, 3.0, 4.0),
                                   ("A_20000201", "A", D(2000, 2, 1), 1.0, 2.0, 3.0, 4.0)], schema)
    tables.upsert_observations(first, path)
    second = spark.createDataFrame([("A_20000101", "A", D(2000, 1, 1), 9.0, None, None, None),
                                    ("B_20000101", "B", D(2000, 1, 1), 5.0, None, None, None)],
                                   schema)
    tables.upsert_observations(second, path)
    again = tables.upsert_observations(second, path)  # idempotent
    assert again["written"]
    got = {r.id: (r.tmax, r.tmin, r.prcp) for r in
           tables.read_table(spark, path, "transformed_results").collect()}
    assert got == {"A_20000101": (9.0, None, None), "A_20000201": (1.0, 2.0, 4.0),
                   "B_20000101": (5.0, None, None)}
    empty = spark.createDataFrame([], schema)
    assert tables.upsert_observations(empty, path) == {"written": False, "rows": 0}


def test_upsert_stations_state_change(spark, tmp_root):  # H5
    path = tmp_root + "/stations"
    tables.ensure_table(spark, path, "transformed_stations")
    tables.upsert_stations(_stations(spark, [("S1", "SP"), ("S2", "RJ")]), path)
    tables.upsert_stations(_stations(spark, [("S1", "MG")]), path)
    got = sorted((r.id, r.state) for r in tables.read_table(spark, path, "transformed_stations").collect())
    assert got == [("S1", "MG"), ("S2", "RJ")]


def test_tolerant_scan_skips_whole_day(spark, tmp_root):  # M5
    root = tmp_root + "/raw"
    obs = _obs(spark, [("GHCND:A", "2000-01-01T00:00:00", "TMAX", 1.0),
                       ("GHCND:A", "2000-01-01T00:00:00", "PRCP", 2.0),
                       ("GHCND:A", "2000-01-02T00:00:00", "TMAX", 3.0)])
    landing.land_observations(obs, root)
    bad = local_path(root) + "/datatype=PRCP/year=2000/month=01/day=01/zz-corrupt.json"
    with open(bad, "w") as f:
        f.write("{not json\n")
    rows, bad_days = tolerant_scan(spark, root, "2000-01-01", "2000-01-31")
    assert [(r.date, r.datatype) for r in rows.collect()] == [("2000-01-02T00:00:00", "TMAX")]
    assert [tuple(r) for r in bad_days.collect()] == [(2000, 1, 1)]


def test_land_rerun_replaces_only_touched_days(spark, tmp_root):  # H1
    root = tmp_root + "/raw"
    landing.land_observations(_obs(spark, [("GHCND:A", "2000-01-01T00:00:00", "TMAX", 1.0),
                                           ("GHCND:A", "2000-01-02T00:00:00", "TMAX", 2.0)]), root)
    landing.land_observations(_obs(spark, [("GHCND:B", "2000-01-02T00:00:00", "TMAX", 7.0)]), root)
    got = sorted((r.station, r.day, r.value) for r in scan_observations(spark, root).collect())
    assert got == [("GHCND:A", 1, 1.0), ("GHCND:B", 2, 7.0)]
    assert os.path.isdir(local_path(root) + "/datatype=TMAX/year=2000/month=01/day=02")


def test_snapshot_skips_unchanged_region(spark, tmp_root):  # H2, H3, A5
    snap_root, manifest = tmp_root + "/snap", tmp_root + "/meta"
    rec = _stations(spark, [("S1", "SP"), ("S2", "RJ")])
    recs = rec.select(*[F.col(c).cast("string").alias(c) for c in stations.RECORD_COLUMNS])
    written = landing.write_station_snapshot(recs, snap_root, D(2024, 1, 1))
    assert sorted(r.region for r in written.collect()) == ["RJ", "SP"]
    changed = recs.withColumn("name", F.when(F.col("id") == "S1", "renamed").otherwise(F.col("name")))
    written = landing.write_station_snapshot(changed, snap_root, D(2024, 1, 1))
    assert [r.region for r in written.collect()] == ["SP"]
    m = landing.write_manifest(spark, snap_root, manifest, D(2024, 1, 1), changed).first()
    assert (m.total_stations, m.regions) == (2, ["RJ", "SP"])
    assert m.files and all("region=" in f for f in m.files)
    cur = landing.scan_station_snapshot(spark, snap_root, manifest)
    assert sorted((r.id, r.name) for r in cur.collect()) == [("S1", "renamed"), ("S2", "nS2")]


def test_missing_snapshot_is_empty(spark, tmp_root):
    assert landing.scan_station_snapshot(spark, tmp_root + "/none", tmp_root + "/nometa").count() == 0


def test_state_lookup_unknown_is_null(spark):  # D4, D5
    pts = spark.createDataFrame([("P1", -10.5, -40.5), ("P2", 50.0, 50.0)],
                                "id string, latitude double, longitude double")
    cells = spark.createDataFrame([(-11, -41, "Bahia")], "cell_lat int, cell_lon int, state_name string")
    codes = spark.createDataFrame([("Bahia", "BA")], "state_name string, code string")
    got = {r.id: r.state for r in
           joins.lookup_state_code(joins.assign_state(pts, cells), codes).collect()}
    assert got == {"P1": "BA", "P2": None}


def test_ensure_tables_creates_typed_empty_tables_once(spark, tmp_root):  # H7
    created = tables.ensure_tables(spark, tmp_root)
    assert all(created.values()) and len(created) == 13
    assert not any(tables.ensure_tables(spark, tmp_root).values())
    r = tables.read_table(spark, tmp_root + "/transformed_results", "transformed_results")
    assert r.count() == 0 and r.columns[:7] == ["id", "station", "date", "tmax", "tmin", "tavg", "prcp"]
    name = "presentation_rainy_days_by_state_by_year"
    v = tables.read_table(spark, f"{tmp_root}/{name}", name)
    assert v.schema["rainy_days"].dataType.simpleString() == "int"


def test_station_refresh_is_idempotent(spark, tmp_root):  # J2 rerun changes nothing
    from pluvio.plans.jobs import Layout, job_refresh_stations

    layout = Layout(tmp_root)
    obs = _obs(spark, [("GHCND:S1", "2000-01-01T00:00:00", "TMAX", 1.0),
                       ("GHCND:S2", "2000-01-01T00:00:00", "TMAX", 2.0),
                       ("GHCND:S3", "2000-01-01T00:00:00", "TMAX", 3.0)])
    catalog = spark.createDataFrame(
        [("GHCND:S1", "one", -10.5, -40.5, 5.0, "METERS", 1.0, "2000-01-01", "2001-01-01"),
         ("GHCND:S2", "two", 50.0, 50.0, 5.0, "METERS", 1.0, "2000-01-01", "2001-01-01")],
        "id string, name string, latitude double, longitude double, elevation double, "
        "elevationUnit string, datacoverage double, mindate string, maxdate string")
    cells = spark.createDataFrame([(-11, -41, "Bahia")], "cell_lat int, cell_lon int, state_name string")
    codes = spark.createDataFrame([("Bahia", "BA")], "state_name string, code string")
    first = job_refresh_stations(spark, layout, obs, catalog, cells, codes, D(2024, 1, 1))
    assert (first["new_stations"], first["upserted"], first["rejected"], first["unresolved"]) == (2, 1, 1, 1)
    assert first["written_regions"] == 2
    second = job_refresh_stations(spark, layout, obs, catalog, cells, codes, D(2024, 1, 1))
    assert (second["new_stations"], second["written_regions"], second["unresolved"]) == (0, 0, 1)
    rejects = tables.read_table(spark, layout.rejects, "rejected_stations").collect()
    assert {r.id: r.reason for r in rejects} == {"GHCND:S2": "missing state", "GHCND:S3": "not in the catalog"}
    dim = tables.read_table(spark, layout.stations, "transformed_stations").collect()
    assert [(r.id, r.state) for r in dim] == [("GHCND:S1", "BA")]


def _page(request, offset, count, rows):
    row = ("GHCND:A", "2000-01-01T00:00:00", "TMAX", None, 1.0)
    return ({"resultset": {"offset": offset, "count": count, "limit": 2}}, None if rows is None else [row] * rows,
            None, request)


def test_page_completeness_counts_pages_not_rows(spark):  # A2, A3 (M23 deviation)
    from pluvio.schemas import PAGE_ENVELOPE
    from pluvio.sources.observations import CORRUPT, distinct_pages, explode_pages, page_completeness

    pages = spark.createDataFrame([
        _page("short", 1, 3, 2),
        _page("whole", 1, 3, 2), _page("whole", 3, 3, 1),
        _page("nothing", 1, 0, None),
        _page("doubled", 1, 4, 2), _page("doubled", 1, 4, 2),  # as many rows as declared, one page missing
        (None, None, "{broken", "unreadable"),
        _page("both", 1, 1, 1), (None, None, "{broken", "both"),
    ], T.StructType([*PAGE_ENVELOPE.fields, T.StructField(CORRUPT, T.StringType()),
                     T.StructField("request", T.StringType())]))
    got = {r.request: (r.declared, r.received, r.unreadable, r.complete)
           for r in page_completeness(pages, ["request"]).collect()}
    assert got == {"short": (3, 2, 0, False), "whole": (3, 3, 0, True), "nothing": (0, 0, 0, True),
                   "doubled": (4, 2, 0, False), "unreadable": (0, 0, 1, False), "both": (1, 1, 1, False)}
    assert explode_pages(pages).count() == 10
    assert explode_pages(distinct_pages(pages, ["request"])).count() == 8


def test_long_keys_stay_apart(spark, tmp_path):  # keys of seven digits
    from pluvio import fixtures as fx

    spark.createDataFrame([(k, 1, 1.0, 0.0, "A", "F", dt.datetime(2000, 1, 1)) for k in (100000, 1000000, 7)],
                          "l_suppkey long, l_linenumber int, l_quantity double, l_discount double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    got = {r.station for r in fx.fx_observations(spark, str(tmp_path)).collect()}
    assert got == {"GHCND:S100000", "GHCND:S1000000", "GHCND:S000007"}
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert {r[0] for r in con.sql(fx.with_views("select station from fx_observations", "fx_observations")
                                  ).fetchall()} == got


def test_landing_keeps_attributes_and_rejects(spark, tmp_root):  # H1
    root = tmp_root + "/raw"
    rows = spark.createDataFrame([("GHCND:A", "2000-01-01T00:00:00", "TMAX", ",,W", 1.0),
                                  ("GHCND:A", "soon", "TMAX", "x", 2.0), ("GHCND:B", None, "PRCP", None, 3.0)],
                                 "station string, date string, datatype string, attributes string, value double")
    assert landing.land_observations(rows, root) == {"landed": 1, "rejected": 2}
    assert [(r.station, r.attributes) for r in scan_observations(spark, root).collect()] == [("GHCND:A", ",,W")]
    got = sorted((r.station, r.date, r.attributes, r.value, r.reason)
                 for r in landing.read_rejected(spark, root).collect())
    assert got == [("GHCND:A", "soon", "x", 2.0, "unparseable date"),
                   ("GHCND:B", None, None, 3.0, "unparseable date")]


def test_missing_root_and_table_are_errors(spark, tmp_root):  # A1, A6
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_observations(spark, tmp_root + "/mistyped").count()
    with pytest.raises(tables.MissingTable):
        tables.read_table(spark, tmp_root + "/mistyped", "transformed_results")
    with pytest.raises(tables.MissingTable):
        tables.upsert_stations(_stations(spark, [("S1", "SP")]), tmp_root + "/mistyped")


def test_digit_states_empty_states_and_repeated_keys(spark, tmp_root):  # H4, H5
    path = tmp_root + "/stations"
    tables.ensure_table(spark, path, "transformed_stations")
    tables.upsert_stations(_stations(spark, [("S1", "01"), ("S2", "02")]), path)
    read = lambda: sorted((r.id, r.state) for r in
                          tables.read_table(spark, path, "transformed_stations").collect())
    assert read() == [("S1", "01"), ("S2", "02")]
    for bad in ([("S3", "")], [("S4", "SP"), ("S4", "RJ")]):
        with pytest.raises(ContractError):
            tables.upsert_stations(_stations(spark, bad), path)
        assert read() == [("S1", "01"), ("S2", "02")]
    results = tmp_root + "/results"
    tables.ensure_table(spark, results, "transformed_results")
    twice = spark.createDataFrame([("A_20000101", "A", D(2000, 1, 1), 1.0, None, None, None)] * 2,
                                  tables.TRANSFORMED_RESULTS)
    with pytest.raises(ContractError):
        tables.upsert_observations(twice, results)
    assert tables.read_table(spark, results, "transformed_results").count() == 0


def test_a_load_that_dies_before_the_write_leaves_the_table(spark, tmp_root, monkeypatch):  # H4 - H6
    path = tmp_root + "/stations"
    tables.ensure_table(spark, path, "transformed_stations")
    tables.upsert_stations(_stations(spark, [("S1", "SP")]), path)

    def die(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(tables, "_replace", die)
    with pytest.raises(OSError):
        tables.upsert_stations(_stations(spark, [("S2", "RJ")]), path)
    monkeypatch.undo()
    assert [r.id for r in tables.read_table(spark, path, "transformed_stations").collect()] == ["S1"]
    tables.upsert_stations(_stations(spark, [("S2", "RJ")]), path)  # run again
    assert tables.read_table(spark, path, "transformed_stations").count() == 2


@pytest.mark.parametrize("name", ["transformed_results", "transformed_stations"])
def test_a_failed_write_is_restored_or_run_again(spark, tmp_root, monkeypatch, name):  # H4, H5
    path = f"{tmp_root}/{name}"
    row = lambda i, d, v: (f"{i}_{d:%Y%m%d}", i, d, v, None, None, None)
    if name == "transformed_results":
        upsert, make = tables.upsert_observations, lambda rows: spark.createDataFrame(rows, tables.TRANSFORMED_RESULTS)
        first, later = [row("A", D(2000, 1, 1), 1.0), row("B", D(2000, 1, 2), 2.0), row("C", D(2000, 3, 1), 3.0)], [
            row("A", D(2000, 1, 1), 9.0)]
        want = {"A_20000101": 9.0, "B_20000102": 2.0, "C_20000301": 3.0}
        broken, value = f"{path}/year=2000/month=1", "tmax"
    else:
        upsert, make = tables.upsert_stations, lambda rows: _stations(spark, rows)
        first, later, want = [("S1", "SP"), ("S2", "RJ")], [("S1", "MG")], {"S1": "MG", "S2": "RJ"}
        broken, value = f"{path}/state=RJ", "state"
    tables.ensure_table(spark, path, name)
    upsert(make(first), path)
    write = tables._write

    def die(df, where, *_, **__):  # part of the table is gone, the new content not yet there
        tables.files.delete(spark, broken)
        raise OSError("lost")

    monkeypatch.setattr(tables, "_write", die)
    with pytest.raises(tables.ReplaceFailed) as failed:
        upsert(make(later), path)
    monkeypatch.setattr(tables, "_write", write)
    tables.restore_table(spark, path, name, failed.value.staged)
    read = lambda: {r["id"]: r[value] for r in tables.read_table(spark, path, name).collect()}
    assert read() == want and not tables.files.exists(spark, failed.value.staged)
    upsert(make(later), path)  # and running the load again changes nothing
    assert read() == want


def test_staged_copies_are_deleted(spark, tmp_root):
    path = tmp_root + "/results"
    tables.ensure_table(spark, path, "transformed_results")
    stage = work_path(spark, "stage", "transformed_results-batch")
    before = tables.files.folders(spark, stage) if tables.files.exists(spark, stage) else []
    tables.upsert_observations(spark.createDataFrame(
        [("A_20000101", "A", D(2000, 1, 1), 1.0, None, None, None)], tables.TRANSFORMED_RESULTS), path)
    assert tables.files.folders(spark, stage) == before
    stage = work_path(spark, "stage", "transformed_results-next")
    assert not tables.files.exists(spark, stage) or tables.files.folders(spark, stage) == []


def test_snapshot_sees_rows_that_would_cancel(spark, tmp_root):  # H2
    rec = lambda name: _stations(spark, [("S1", "SP"), ("S1", "SP")]).select(
        *[F.lit(name).alias(c) if c == "name" else F.col(c).cast("string").alias(c)
          for c in stations.RECORD_COLUMNS])
    landing.write_station_snapshot(rec("old"), tmp_root, D(2024, 1, 1))
    assert landing.write_station_snapshot(rec("new"), tmp_root, D(2024, 1, 1)).count() == 1
    assert {r.name for r in landing.read_snapshot(spark, tmp_root).collect()} == {"new"}


def test_manifest_lists_files_of_odd_regions(spark, tmp_root):  # H3
    recs = _stations(spark, [("S1", "RJ"), ("S2", "São Paulo"), ("S3", "UNITED STATES"), ("S4", "a+b")]).select(
        *[F.col(c).cast("string").alias(c) for c in stations.RECORD_COLUMNS])
    landing.write_station_snapshot(recs, tmp_root + "/snap", D(2024, 1, 1))
    m = landing.write_manifest(spark, tmp_root + "/snap", tmp_root + "/meta", D(2024, 1, 1), recs).first()
    assert m.regions == ["RJ", "São Paulo", "UNITED STATES", "a+b"] and len(m.files) >= 4
    cur = landing.scan_station_snapshot(spark, tmp_root + "/snap", tmp_root + "/meta")
    assert sorted(r.id for r in cur.collect()) == ["S1", "S2", "S3", "S4"]


def test_refresh_repairs_a_failed_run(spark, tmp_root, monkeypatch):  # J2
    from pluvio.plans.jobs import Layout, job_refresh_stations

    obs = _obs(spark, [("GHCND:S1", "2000-01-01T00:00:00", "TMAX", 1.0)])
    catalog = spark.createDataFrame(
        [("GHCND:S1", "one", -10.5, -40.5, 5.0, "METERS", 1.0, "2000-01-01", "2001-01-01")],
        "id string, name string, latitude double, longitude double, elevation double, "
        "elevationUnit string, datacoverage double, mindate string, maxdate string")
    cells = spark.createDataFrame([(-11, -41, "Bahia"), (-11, -41, "Bahia")],  # a doubled cell
                                  "cell_lat int, cell_lon int, state_name string")
    layout = Layout(tmp_root)

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(tables, "upsert_stations", fail)
    with pytest.raises(OSError):
        job_refresh_stations(spark, layout, obs, catalog, cells, None, D(2024, 1, 1))
    monkeypatch.undo()
    again = job_refresh_stations(spark, layout, obs, catalog, cells, None, D(2024, 1, 1))
    assert (again["new_stations"], again["upserted"]) == (1, 1)
    dim = tables.read_table(spark, layout.stations, "transformed_stations").collect()
    assert [(r.id, r.state) for r in dim] == [("GHCND:S1", "BA")]


def test_pipeline_loads_requested_days_only(spark, tmp_root):  # J4
    from pluvio.plans.jobs import Layout, job_pipeline

    layout = Layout(tmp_root)
    obs = _obs(spark, [("GHCND:S1", "1990-01-05T00:00:00", "TMAX", 1.0),
                       ("GHCND:S2", "2000-06-01T00:00:00", "TMAX", 2.0),
                       ("GHCND:S3", "2020-01-07T00:00:00", "TMIN", 3.0)])
    requests = spark.createDataFrame([("1990-01-01", "1990-01-31"), ("2020-01-01", "2020-01-31")],
                                     "start_date string, end_date string")
    catalog = spark.createDataFrame(
        [(f"GHCND:S{i}", "n", -10.5, -40.5, 5.0, "METERS", 1.0, "1990-01-01", "2001-01-01") for i in (1, 2, 3)],
        "id string, name string, latitude double, longitude double, elevation double, "
        "elevationUnit string, datacoverage double, mindate string, maxdate string")
    cells = spark.createDataFrame([(-11, -41, "Bahia")], "cell_lat int, cell_lon int, state_name string")
    report = job_pipeline(spark, layout, obs, requests, catalog, cells, run_date=D(2024, 1, 1))
    stored = tables.read_table(spark, layout.results, "transformed_results").collect()
    assert sorted(r.id for r in stored) == ["S1_19900105", "S3_20200107"]
    dim = tables.read_table(spark, layout.stations, "transformed_stations").collect()
    assert sorted(r.id for r in dim) == ["GHCND:S1", "GHCND:S3"]
    assert (report["periods"], report["missing_loads"], report["landed"]["landed"]) == (2, 6, 3)
    assert all(isinstance(n, int) for n in report["views"].values())


def test_a_broken_view_does_not_hold_up_the_others(spark, tmp_root, monkeypatch):  # J3, M25
    from pluvio.plans import jobs

    layout = jobs.Layout(tmp_root)
    tables.ensure_table(spark, layout.results, "transformed_results")
    tables.ensure_table(spark, layout.stations, "transformed_stations")
    tables.upsert_stations(_stations(spark, [("S1", "SP")]), layout.stations)

    def broken(*_, **__):
        raise ValueError("no such season")

    monkeypatch.setitem(jobs.VIEWS, "avg_temp_by_season", broken)
    report = jobs.job_presentation(spark, layout)
    assert report["avg_temp_by_season"] == "ValueError: no such season"
    assert report["total_stations_by_state"] == 1 and len(report) == 11


def test_overflow_is_refused(spark):  # C7
    from pyspark.errors import ArithmeticException

    big = spark.createDataFrame([("X", 1 << 40)], "state string, total_stations long")
    with pytest.raises(ArithmeticException):
        conform_schema(big, PRESENTATION["total_stations_by_state"]).collect()


def test_bad_values_do_not_break_the_pivot(spark):  # E1
    rows = spark.createDataFrame([("GHCND:A", "2000-01-01", "TMAX", "warm"), ("GHCND:A", "2000-01-01", "TMIN", "2"),
                                  ("GHCND:A", "soon", "TMAX", "3")],
                                 "station string, date string, datatype string, value string")
    assert [(r.id, r.tmax, r.tmin) for r in pivot_daily(rows).collect()] == [("A_20000101", None, 2.0)]


def test_known_states(spark):  # D4
    names = spark.createDataFrame([("Bahia",), ("São Paulo",), ("Nowhere",), (None,)], "state_name string")
    got = {r.state_name: r.state for r in joins.lookup_state_code(names).collect()}
    assert got == {"Bahia": "BA", "São Paulo": "SP", "Nowhere": None, None: None}
    assert joins.state_codes(spark).count() == 27


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from pluvio import session

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_path(Session(), "x")
    assert session.work_path(spark, "x") == session.work_path(spark, "x")

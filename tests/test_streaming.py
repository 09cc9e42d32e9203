"""Incremental loading picks up only newly landed days."""

from __future__ import annotations

from pluvio.sinks import landing, tables
from pluvio.streaming.incremental import run_incremental_load

OBS = "station string, date string, datatype string, value double"


def test_incremental_load_processes_new_days_once(spark, tmp_root):
    raw, results, ckpt = tmp_root + "/raw", tmp_root + "/results", tmp_root + "/ckpt"
    landing.land_observations(spark.createDataFrame([
        ("GHCND:A", "2000-01-01T00:00:00", "TMAX", 1.0),
        ("GHCND:A", "2000-01-01T00:00:00", "PRCP", 2.0),
        ("GHCND:A", "2000-01-02T00:00:00", "TMAX", 3.0)], OBS), raw)
    run_incremental_load(spark, raw, results, ckpt)
    got = {r.id: (r.tmax, r.prcp) for r in tables.read_table(spark, results, "transformed_results").collect()}
    assert got == {"A_20000101": (1.0, 2.0), "A_20000102": (3.0, None)}

    # a new datatype for an old day, and a new day: the old day is re-read whole
    landing.land_observations(spark.createDataFrame([
        ("GHCND:A", "2000-01-02T00:00:00", "PRCP", 5.0),
        ("GHCND:B", "2000-01-03T00:00:00", "TMIN", -1.0)], OBS), raw)
    run_incremental_load(spark, raw, results, ckpt)
    got = {r.id: (r.tmax, r.tmin, r.prcp) for r in
           tables.read_table(spark, results, "transformed_results").collect()}
    assert got == {"A_20000101": (1.0, None, 2.0), "A_20000102": (3.0, None, 5.0),
                   "B_20000103": (None, -1.0, None)}


def test_second_run_reads_only_new_files(spark, tmp_root):
    from pluvio.streaming.incremental import start_incremental_load

    raw, results, ckpt = tmp_root + "/raw", tmp_root + "/results", tmp_root + "/ckpt"

    def run():
        query = start_incremental_load(spark, raw, results, ckpt)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    first = [("GHCND:A", f"2000-01-{d:02d}T00:00:00", "TMAX", 1.0) for d in range(1, 8)]
    landing.land_observations(spark.createDataFrame(first, OBS), raw)
    assert run() == 7
    landing.land_observations(spark.createDataFrame(
        [("GHCND:A", "2000-01-07T00:00:00", "PRCP", 2.0), ("GHCND:B", "2000-02-01T00:00:00", "TMAX", 3.0)], OBS), raw)
    assert run() == 2 and run() == 0
    got = {r.id: (r.tmax, r.prcp) for r in tables.read_table(spark, results, "transformed_results").collect()}
    assert got == {f"A_200001{d:02d}": (1.0, None) for d in range(1, 7)} | {
        "A_20000107": (1.0, 2.0), "B_20000201": (3.0, None)}


def test_new_files_are_listed_and_not_opened(spark, tmp_root):
    from pluvio.streaming.incremental import start_incremental_load

    raw, results, ckpt = tmp_root + "/raw", tmp_root + "/results", tmp_root + "/ckpt"
    landing.land_observations(spark.createDataFrame(
        [(f"GHCND:{i}", "2000-01-01T00:00:00", "TMAX", float(i)) for i in range(50)], OBS).coalesce(1), raw)
    files = spark.read.format("binaryFile").load(raw).count()
    query = start_incremental_load(spark, raw, results, ckpt)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == files < 50
    assert tables.read_table(spark, results, "transformed_results").count() == 50

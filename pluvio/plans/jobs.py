"""Composite jobs: observations, stations, presentation, whole pipeline.

Each job is a short chain of DataFrame operators ending in one sink, and
returns a report of what it did. Nothing loops over days or periods on the
driver: a job covers all its periods with one partition-pruned scan.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import DATATYPES
from ..operators.joins import bounded_broadcast, new_station_ids
from ..operators.observations import pivot_daily
from ..operators.periods import expand_days, expected_loads, generate_periods, missing_loads
from ..operators.stations import RECORD_COLUMNS, enrich_stations, station_union, typed_stations, unresolved_stations
from ..schemas import REJECTED_STATIONS
from ..sinks import landing, tables
from ..staging import scratch, stage
from ..sources.observations import PIVOTED, distinct_pages, explode_pages, page_completeness, tolerant_scan
from .cube import VIEWS, month_cube


@dataclass(frozen=True)
class Layout:
    """Where a deployment keeps its data (all paths on shared storage)."""

    root: str
    raw: str | None = None  # landed raw observations, if kept elsewhere

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw_results(self) -> str:
        return self.raw or self._p("raw", "results")

    @property
    def raw_stations(self) -> str:
        return self._p("raw", "stations", "snapshots")

    @property
    def manifest(self) -> str:
        return self._p("raw", "stations", "metadata")

    @property
    def results(self) -> str:
        return self._p("transformation", "transformed_results")

    @property
    def stations(self) -> str:
        return self._p("transformation", "transformed_stations")

    @property
    def rejects(self) -> str:
        return self._p("transformation", "rejected_stations")

    @property
    def cube(self) -> str:
        return self._p("transformation", "month_cube")

    def presentation(self, view: str) -> str:
        return self._p("presentation", view)


class ViewsFailed(RuntimeError):
    """Presentation views were not refreshed: their tables hold older rows, or
    not all rows. ``failed`` has the error of each, ``report`` what the job did."""

    def __init__(self, failed: dict[str, str], report: dict) -> None:
        super().__init__("views not refreshed: " + "; ".join(f"{view}: {error}" for view, error in failed.items()))
        self.failed, self.report = failed, report


def all_refreshed(views: dict[str, int | str], report: dict | None = None) -> dict[str, int | str]:
    """What ``job_presentation`` gave, if no view of it failed; ``ViewsFailed``
    (with the ``report`` of the job around it) otherwise."""
    failed = {view: made for view, made in views.items() if not isinstance(made, int)}
    if failed:
        raise ViewsFailed(failed, views if report is None else report)
    return views


def _day_keys(day: str = "day") -> list:
    return [F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day")]


def job_transform_observations(spark: SparkSession, layout: Layout, start, end,
                               multiline: bool = False, days: DataFrame | None = None) -> dict:
    """Landed raw days of [start, end] -> wide daily rows -> upsert.

    ``days`` (one ``day`` column) limits the load to these days of the span.
    Days holding an unreadable record or a row that does not type are
    skipped whole and counted. The raw files are read once.
    """
    tables.ensure_table(spark, layout.results, "transformed_results")
    wanted = None if days is None else days.select(*_day_keys())
    with scratch(spark):
        rows, bad_days = tolerant_scan(spark, layout.raw_results, start, end, multiline=multiline, days=wanted,
                                       columns=PIVOTED)
        stats = tables.upsert_observations(pivot_daily(rows, rows.count()), layout.results)
        return stats | {"skipped_days": bad_days.count()}


def job_refresh_stations(spark: SparkSession, layout: Layout, observations: DataFrame,
                         catalog: DataFrame, cells: DataFrame, codes: DataFrame | None = None,
                         run_date=None, resolution: float = 1.0) -> dict:
    """Find stations seen in ``observations`` but not in the current
    snapshot, enrich them, upsert the typed ones into the dimension, record
    the others in the reject table, and write the new snapshot and manifest.

    The manifest, which decides what is new, is written last, and every step
    before it can be repeated: a run that fails is repaired by the next one.
    Stations without a catalog record are recorded as rejects too; they are
    not in the snapshot, so each run tries them again.
    """
    run_date = run_date or _dt.datetime.now(_dt.timezone.utc).date()
    tables.ensure_table(spark, layout.stations, "transformed_stations")
    tables.ensure_table(spark, layout.rejects, "rejected_stations")
    with scratch(spark):
        existing = landing.scan_station_snapshot(spark, layout.raw_stations, layout.manifest)
        ids, _ = stage(new_station_ids(observations, existing), spark, "new-ids")
        record = [F.col(c).cast("string").alias(c) for c in RECORD_COLUMNS]
        new, _ = stage(enrich_stations(ids, catalog, cells, codes, resolution).select(*record), spark, "new-stations")
        good, rejects = typed_stations(new)
        unknown = unresolved_stations(ids, catalog).select(
            "id", *[F.lit(None).cast("string").alias(c) for c in RECORD_COLUMNS[1:]],
            F.lit("not in the catalog").alias("reason"))
        rejected = rejects.unionByName(unknown).select(*REJECTED_STATIONS.fieldNames())
        report = {"new_stations": new.count(), "unresolved": unknown.count(), "rejected": rejects.count(),
                  "upserted": 0, "written_regions": 0}
        if report["new_stations"] or report["unresolved"]:
            report["upserted"] = tables.upsert_stations(good, layout.stations)["rows"]
            tables.upsert_rejects(rejected, layout.rejects, good.select("id"))
        if report["new_stations"]:
            current, _ = stage(station_union(existing.select(*RECORD_COLUMNS), new), spark, "station-snapshot")
            regions = landing.write_station_snapshot(current, layout.raw_stations, run_date)
            report["written_regions"] = regions.count()
            landing.write_manifest(spark, layout.raw_stations, layout.manifest, run_date, current)
        return report


def refresh_cube(spark: SparkSession, layout: Layout, months: DataFrame | None = None) -> int:
    """Recompute the month cube from the daily rows, or only its ``months``
    (columns year, month), whose folders alone are read and replaced. Without
    a cube that was written to its end all of it is made. Returns the rows written."""
    results = tables.read_table(spark, layout.results, "transformed_results")
    if months is None or not tables.is_whole(spark, layout.cube):
        return tables.replace_months(month_cube(results), layout.cube, whole=True)
    with scratch(spark):
        # few rows, whatever they are derived from, and read three times
        months, _ = stage(months.select(*tables.MONTH_KEYS).distinct(), spark, "touched-months")
        rows = tables.touched_months(results, months)
        return 0 if rows is None else tables.replace_months(month_cube(rows), layout.cube)


def job_presentation(spark: SparkSession, layout: Layout, views=None, at_once: int = 4,
                     months: DataFrame | None = None) -> dict[str, int | str]:
    """Recompute every presentation table from the curated tables; rows
    written per view, or the error of a view that failed: the others go on,
    and the failed one keeps its published rows, unless writing them failed.
    Read the tables only after ``all_refreshed`` has passed this report.

    The daily rows are read once, into the month cube; with ``months`` only
    those months of them. All views are rolled up from the cube. The
    dimension is checked for broadcast once. The views are independent, so
    ``at_once`` of them are submitted together and fill each other's idle tasks.
    """
    refresh_cube(spark, layout, months)
    cube = tables.read_table(spark, layout.cube, "month_cube")
    stations = tables.read_table(spark, layout.stations, "transformed_stations")
    dimension = bounded_broadcast(stations.select("id", "state"))

    def refresh(name: str) -> int | str:
        try:
            made = VIEWS[name](cube, dimension, ordered=False, checked=True)
            return tables.overwrite_view(made, layout.presentation(name), name)
        except Exception as e:  # reported: one broken view does not hold up ten good ones
            return f"{type(e).__name__}: {e}"

    names = list(views or VIEWS)
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(names, pool.map(refresh, names)))


def _months_of(results: DataFrame, first, last) -> DataFrame:
    """Stored rows of a span of days, by folder literals and then by day."""
    span = tables.months_between((first.year, first.month), (last.year, last.month))
    return results.where(span & F.col("date").between(F.lit(first), F.lit(last)))


def job_pipeline(spark: SparkSession, layout: Layout, raw_observations: DataFrame | None,
                 requests: DataFrame, catalog: DataFrame, cells: DataFrame, codes: DataFrame | None = None,
                 as_of=None, run_date=None, multiline: bool = False, datatypes=DATATYPES,
                 pages: DataFrame | None = None, page_keys=("datatype",)) -> dict:
    """Periods -> land -> observations -> stations -> presentation.

    Only the days of the requested periods are loaded, by one scan over
    their span that keeps these days. ``raw_observations`` are landed first
    unless None (already landed). ``pages`` are landed API pages: their rows
    are landed, and requests with missing, short or unreadable pages are
    counted. New stations are looked for among the loaded days only. The
    report also counts (period, datatype) pairs with nothing landed. Views
    that fail raise ``ViewsFailed``, which has the report, at the end.
    """
    with scratch(spark):
        periods, _ = stage(generate_periods(requests, as_of), spark, "periods")
        bounds = periods.agg(F.min("start").alias("s"), F.max("end").alias("e"), F.count(F.lit(1)).alias("n")).first()
        if bounds["s"] is None:
            return {"periods": 0}
        report: dict = {"periods": bounds["n"]}
        days = expand_days(periods).select("day").distinct()
        if pages is not None:
            found = page_completeness(pages, page_keys).agg(
                F.count_if(~F.col("complete")).alias("incomplete"), F.sum("received").alias("rows")).first()
            report["incomplete_requests"] = found["incomplete"]
            raw_observations = explode_pages(distinct_pages(pages, page_keys))
        if raw_observations is not None:
            rows = None if pages is None else found["rows"] or 0
            report["landed"] = landing.land_observations(raw_observations, layout.raw_results, rows=rows)
        report["observations"] = job_transform_observations(
            spark, layout, bounds["s"], bounds["e"], multiline=multiline, days=days)
        results = tables.read_table(spark, layout.results, "transformed_results")
        loaded = _months_of(results, bounds["s"], bounds["e"]).join(
            bounded_broadcast(days.withColumnRenamed("day", "date"), 1_000_000), "date", "left_semi")
        report["missing_loads"] = _missing(periods, loaded, datatypes).count()
        report["stations"] = job_refresh_stations(spark, layout, loaded, catalog, cells, codes, run_date)
        months = days.select(F.year("day").alias("year"), F.month("day").alias("month")).distinct()
        report["views"] = job_presentation(spark, layout, months=months)
        all_refreshed(report["views"], report)
        return report


def _missing(periods: DataFrame, loaded: DataFrame, datatypes) -> DataFrame:
    """(start, end, datatype) of the periods that have no value stored."""
    by_date = loaded.groupBy("date").agg(*[F.bool_or(F.col(t.lower()).isNotNull()).alias(t) for t in datatypes])
    has = F.array_compact(F.array(*[F.when(F.col(t), F.lit(t)) for t in datatypes]))
    there = by_date.select(F.col("date").alias("day"), F.explode(has).alias("datatype"))
    by_day = expand_days(periods.distinct()).join(there, "day")
    return missing_loads(expected_loads(periods.distinct(), datatypes), by_day)


"""Registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built from
the driver's tables through the bridge views, so its work grows with
them. Sink and job entries write under a fresh folder of the shared work
area and return what they wrote, read back. ``ORACLE`` holds the matching
DuckDB SQL where one exists (see ``oracle.py``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from .. import functions as PF
from ..operators import changes, conform, gaps, joins, periods, regions, stations
from ..operators import observations as obs_ops
from ..operators.numbering import number_in_groups
from ..operators.sizing import spread
from ..functions.constants import STATE_CODES
from ..schemas import PARTITIONING, STATION_RECORD, TRANSFORMED_RESULTS
from ..session import work_path
from ..sinks import bucketed, compaction, landing, tables
from ..sources import observations as src
from ..staging import scratch
from ..streaming import incremental
from . import cube, jobs, oracle
from .values import as_values
from .views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

# Run date used by snapshot / manifest entries (a parameter, not data).
RUN_DATE = dt.date(2002, 1, 1)
OLD_SNAPSHOT_DATE = dt.date(2001, 1, 1)
# Period of the period-filter entries (the filter is the operator).
PERIOD = (dt.date(1996, 1, 1), dt.date(1998, 12, 31))
# Second upsert batch: PRCP and TAVG from this day on replace whole rows.
UPSERT_FROM = dt.date(1998, 1, 1)


# --- shared inputs ------------------------------------------------------------

def curated_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(transformed_results, transformed_stations) derived from the tables."""
    return q_pivot_daily(spark, sf_dir), fx.fx_stations(spark, sf_dir)


def _typed(spark, sf):
    good, _ = obs_ops.split_valid(obs_ops.typed_observations(fx.fx_observations(spark, sf)))
    return good


def _station_requests(spark, sf, frequency: str, custom_days=None) -> DataFrame:
    """One load request per station spanning its observed days."""
    req = _typed(spark, sf).groupBy("station").agg(
        F.min("date").cast("string").alias("start_date"),
        F.max("date").cast("string").alias("end_date"))
    return req.withColumns({"frequency": F.lit(frequency),
                            "custom_days": F.lit(custom_days).cast("string")})


def _periods(spark, sf, frequency, custom_days=None) -> DataFrame:
    return periods.generate_periods(_station_requests(spark, sf, frequency, custom_days),
                                    as_of=RUN_DATE, keep=["station"])


def _aux(spark, sf):
    return (fx.fx_station_catalog(spark, sf), fx.fx_region_cells(spark, sf),
            fx.fx_state_codes(spark, sf))


def _enriched_catalog(spark, sf) -> DataFrame:
    _, cells, codes = _aux(spark, sf)
    catalog = fx.fx_full_catalog(spark, sf)
    return stations.enrich_stations(catalog.select("id"), catalog, cells, codes)


def _new_ids(spark, sf) -> DataFrame:
    return joins.new_station_ids(fx.fx_observations(spark, sf), fx.fx_stations(spark, sf))


def _enriched_new(spark, sf) -> DataFrame:
    catalog, cells, codes = _aux(spark, sf)
    return stations.enrich_stations(_new_ids(spark, sf), catalog, cells, codes)


def _as_records(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in stations.RECORD_COLUMNS])


def _scratch(spark, name: str) -> str:
    return work_path(spark, "queries", name, unique=True)


_LANDED: dict[tuple[str, str], str] = {}


def _landed(spark, sf, name: str, shared: bool = True) -> str:
    """Land the observations as raw day files; read-only users share one
    landed copy per session and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if shared and key in _LANDED:
        return _LANDED[key]
    root = _scratch(spark, name) + "/raw/results"
    landing.land_observations(fx.fx_raw_observations(spark, sf), root)
    if shared:
        _LANDED[key] = root
    return root


def landed_root(spark, sf) -> str:
    """The session's shared landed copy (for timing what reads it)."""
    return _landed(spark, sf, "shared")


# --- B: periods ---------------------------------------------------------------

def q_periods_last_month(spark, sf):
    days = _typed(spark, sf).select(F.col("date").alias("as_of")).distinct()
    return periods.periods_last_month(days)


def q_periods_daily(spark, sf):
    return _periods(spark, sf, periods.DAILY)


def q_periods_monthly(spark, sf):
    return _periods(spark, sf, periods.MONTHLY)


def q_periods_yearly(spark, sf):
    return _periods(spark, sf, periods.YEARLY)


def q_periods_custom(spark, sf):
    return _periods(spark, sf, "custom", 7)


def q_expand_days(spark, sf):
    return periods.expand_days(_periods(spark, sf, periods.MONTHLY))


def q_expected_loads(spark, sf):
    """(station, monthly period, datatype) pairs with nothing landed."""
    exp = periods.expected_loads(_periods(spark, sf, periods.MONTHLY)) \
        .withColumn("m", F.trunc("start", "MM"))
    landed = _typed(spark, sf).select("station", F.trunc("date", "MM").alias("m"), "datatype")
    return periods.missing_loads(exp, landed, ("station", "m", "datatype")).drop("m")


def q_expected_pages(spark, sf):
    totals = (_typed(spark, sf).groupBy("datatype", F.year("date").alias("year"))
              .agg(F.count(F.lit(1)).alias("total")))
    return periods.expected_pages(totals)


# --- C: projections / filters ---------------------------------------------------

def q_observation_key(spark, sf):
    return obs_ops.observation_key(_typed(spark, sf))


def q_typed_observations(spark, sf):
    return _typed(spark, sf)


def q_observation_day_parts(spark, sf):
    return obs_ops.observation_day_parts(fx.fx_observations(spark, sf))


def q_valid_station_ids(spark, sf):
    return stations.valid_station_ids(fx.fx_observations(spark, sf))


def q_station_projection(spark, sf):
    return stations.station_projection(fx.fx_full_catalog(spark, sf))


def q_typed_stations(spark, sf):
    good, _rejects = stations.typed_stations(_as_records(_enriched_catalog(spark, sf)))
    return good


def q_reject_stations(spark, sf):
    _good, rejects = stations.typed_stations(_as_records(_enriched_catalog(spark, sf)))
    return rejects


def q_conform_schema(spark, sf):
    results, _ = curated_inputs(spark, sf)
    return conform.conform_schema(results, TRANSFORMED_RESULTS)


def q_contract_violations(spark, sf):
    """Rows that break the contract: no station for ids ending in 9, no date
    on the fifth of a month."""
    results, _ = curated_inputs(spark, sf)
    broken = results.withColumns({
        "station": F.when(~F.col("station").endswith("9"), F.col("station")),
        "date": F.when(F.dayofmonth("date") != 5, F.col("date")),
        "tmax": F.lit(None).cast("double")})
    return conform.contract_violations(broken.withColumn("id", PF.observation_id("station", "date")),
                                       TRANSFORMED_RESULTS)


def q_rainy_filter(spark, sf):
    results, _ = curated_inputs(spark, sf)
    return obs_ops.rainy_filter(results)


def q_datatype_filter(spark, sf):
    return obs_ops.datatype_filter(fx.fx_observations(spark, sf), ["TMAX", "PRCP"])


def q_period_filter(spark, sf):
    return obs_ops.period_filter(_typed(spark, sf), *PERIOD)


# --- D: joins ---------------------------------------------------------------------

def q_join_observations_stations(spark, sf):
    return joins.join_observations_stations(*curated_inputs(spark, sf))


def q_join_annual_to_history(spark, sf):
    rs = joins.join_observations_stations(*curated_inputs(spark, sf))
    annual = rs.groupBy("state", PF.year_start("date").alias("year")).agg(
        F.sum("prcp").alias("total_precipitation"))
    return joins.join_annual_to_history(annual)


def q_new_station_ids(spark, sf):
    return _new_ids(spark, sf)


def q_lookup_state_code(spark, sf):
    """Codes of the 27 known states; every 28th supplier is in none of them."""
    names = F.array(*[F.lit(name) for name, _ in STATE_CODES])
    nth = F.regexp_extract("id", "([0-9]+)$", 1).cast("long") % 28
    s = fx.fx_all_stations(spark, sf).select(
        "id", F.coalesce(F.get(names, nth.cast("int")), F.lit("Nowhere")).alias("state_name"))
    return joins.lookup_state_code(s, out="code")


def q_assign_state(spark, sf):
    cat = fx.fx_full_catalog(spark, sf).select("id", "latitude", "longitude")
    return joins.assign_state(cat, fx.fx_region_cells(spark, sf))


def q_assign_region(spark, sf):
    """The exact state of every place, by an index that is written once."""
    index, _path = tables.stage(regions.region_index(fx.fx_region_rings(spark, sf)), spark, "region-index")
    return regions.assign_region(fx.fx_places(spark, sf), index)


def q_enrich_stations(spark, sf):
    return _enriched_new(spark, sf)


def q_unresolved_stations(spark, sf):
    return stations.unresolved_stations(_new_ids(spark, sf), fx.fx_station_catalog(spark, sf))


# --- E: aggregations -----------------------------------------------------------------

def q_pivot_daily(spark, sf):
    observations = fx.fx_observations(spark, sf)
    return obs_ops.pivot_daily(observations, observations.count())


def q_distinct_station_ids(spark, sf):
    return joins.distinct_station_ids(fx.fx_observations(spark, sf))


def q_agg_avg(spark, sf):
    r, _ = curated_inputs(spark, sf)
    return r.groupBy("station").agg(PF.zero_if_null(F.avg("tavg")).alias("avg_tavg"))


def q_agg_sum(spark, sf):
    r, _ = curated_inputs(spark, sf)
    return r.groupBy("station").agg(PF.zero_if_null(F.sum("prcp")).alias("total_prcp"))


def q_agg_min_max(spark, sf):
    r, _ = curated_inputs(spark, sf)
    return r.groupBy("station").agg(PF.zero_if_null(F.max("tmax")).alias("max_tmax"),
                                    PF.zero_if_null(F.min("tmin")).alias("min_tmin"))


def q_agg_count(spark, sf):
    return (_typed(spark, sf).groupBy("station", "datatype")
            .agg(F.count(F.lit(1)).cast("int").alias("n")))


def q_agg_count_distinct(spark, sf):
    return (_typed(spark, sf).groupBy("station")
            .agg(F.count_distinct("date").cast("int").alias("days")))


def q_agg_of_agg(spark, sf):
    r, _ = curated_inputs(spark, sf)
    yearly = r.groupBy("station", PF.year_start("date").alias("year")).agg(
        F.sum("prcp").alias("total"))
    return yearly.groupBy("station").agg(PF.zero_if_null(F.avg("total")).alias("mean_yearly_prcp"))


def q_group_by_expression(spark, sf):
    r, _ = curated_inputs(spark, sf)
    return (r.groupBy(PF.year_start("date").alias("year"), PF.season("date").alias("season"))
            .agg(F.count(F.lit(1)).cast("int").alias("station_days")))


def q_month_cube(spark, sf):
    r, _ = curated_inputs(spark, sf)
    return cube.month_cube(r)


def q_rainy_days_bitmap(spark, sf):
    return cube.rainy_days_by_bitmap(*curated_inputs(spark, sf))


def q_stations_by_region(spark, sf):
    return stations.stations_by_region(fx.fx_all_stations(spark, sf))


def q_manifest_summary(spark, sf):
    return stations.manifest_summary(_enriched_catalog(spark, sf), RUN_DATE)


def q_row_counts(spark, sf):
    r, s = curated_inputs(spark, sf)
    return (r.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("transformed_results").alias("table"), "rows")
            .unionByName(s.agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit("transformed_stations").alias("table"), "rows")))


def _two_snapshots(spark, sf) -> DataFrame:
    old = _as_records(fx.fx_stations(spark, sf)).withColumn(
        "snapshot_date", F.lit(OLD_SNAPSHOT_DATE))
    new = _as_records(_enriched_catalog(spark, sf)).withColumn(
        "snapshot_date", F.lit(RUN_DATE))
    return old.unionByName(new)


def q_dedupe_last_wins(spark, sf):
    return stations.dedupe_last_wins(_two_snapshots(spark, sf), "id", ("snapshot_date",))


# --- G: sorts, unions --------------------------------------------------------------------

def q_sort_by_keys(spark, sf):
    r, _ = curated_inputs(spark, sf)
    return r.orderBy("station", "date")


def q_sort_by_count_desc(spark, sf):
    return (fx.fx_observations(spark, sf).groupBy("station")
            .agg(F.count(F.lit(1)).alias("observations"))
            .orderBy(F.desc("observations"), "station"))


def q_sort_by_season(spark, sf):
    r, _ = curated_inputs(spark, sf)
    return (r.groupBy(PF.season("date").alias("season"))
            .agg(PF.zero_if_null(F.avg("tmax")).alias("avg_tmax"))
            .orderBy(PF.season_rank("season")))


def q_station_union(spark, sf):
    """Every station is in the existing set; most come anew with a state code."""
    catalog, cells, codes = _aux(spark, sf)
    new = stations.enrich_stations(catalog.select("id"), catalog, cells, codes)
    return stations.station_union(_as_records(fx.fx_all_stations(spark, sf)), _as_records(new))


def q_append_observations(spark, sf):
    typed = _typed(spark, sf)
    rain = F.coalesce(F.col("datatype") == "PRCP", F.lit(False))
    return obs_ops.append_observations(typed.where(rain), typed.where(~rain))


# --- A: sources ---------------------------------------------------------------------------

def q_scan_observations(spark, sf):
    return src.scan_observations(spark, _landed(spark, sf, "scan"), *PERIOD)


def q_scan_observations_by_type(spark, sf):
    root = _landed(spark, sf, "scan-by-type")
    return src.scan_observations_by_type(spark, root, *PERIOD, ["TMAX", "PRCP"])


PAGE_ROWS = 100


def _land_pages(spark, sf, name: str, defects: bool = False, page_rows: int = PAGE_ROWS, lost=None) -> str:
    """Land the observations as API pages of at most ``page_rows`` rows, a request
    being a datatype and a month. Each envelope declares its request's total.
    Pages for which ``lost(month, page)`` holds are not landed.

    With ``defects``, of every third month the last TMAX page is missing and
    all TMIN pages are there twice, and every fourth month has an
    unreadable PRCP page.
    """
    obs = fx.fx_raw_observations(spark, sf).withColumn(
        "request", F.concat(F.lit("m"), F.date_format(F.to_date("date"), "yyyyMM")))
    root = _scratch(spark, name) + "/raw/pages"
    keys, rows = ["datatype", "request"], obs.count()
    with scratch(spark):
        numbered = number_in_groups(obs, keys, ["station", "date", "value"], rows)
        paged = numbered.withColumn("offset", F.floor((F.col("nth") - 1) / page_rows) * page_rows + 1)
        row = F.struct("nth", F.struct("station", "date", "datatype", "attributes", "value").alias("row"))
        # a task has a range of pages, which is what the groups and the folders need
        pages = (spread(paged, rows, *keys, "offset").groupBy(*keys, "offset", "total")
                 .agg(F.array_sort(F.collect_list(row)).getField("row").alias("results"))
                 .select(*keys, F.struct(F.struct(
                     "offset", F.col("total").alias("count"), F.lit(page_rows).cast("long").alias("limit"))
                     .alias("resultset")).alias("metadata"), "results"))
        month = F.substring("request", 6, 2).cast("int")
        if lost is not None:
            pages = pages.where(~lost(month, F.floor((F.col("metadata.resultset.offset") - 1) / page_rows)))
        if defects:
            span = F.col("metadata.resultset")
            last = (F.col("datatype") == "TMAX") & (month % 3 == 0) & (span["offset"] + page_rows > span["count"])
            twice = F.when((F.col("datatype") == "TMIN") & (month % 3 == 0), 2).otherwise(1)
            pages = (pages.where(~last).withColumn("copy", F.explode(F.sequence(F.lit(1), twice))).drop("copy"))
            broken = (obs.where((F.col("datatype") == "PRCP") & (month % 4 == 0)).select(*keys).distinct()
                      .withColumn("value", F.lit('{"metadata": {"resultset"')))
            broken.write.partitionBy(*keys).text(root)
        pages.write.mode("append").partitionBy(*keys).json(root)
    return root


def q_explode_pages(spark, sf):
    pages = src.read_pages(spark, _land_pages(spark, sf, "pages"))
    return src.explode_pages(pages).select("station", "date", "datatype", "attributes", "value")


def q_page_completeness(spark, sf):
    pages = src.read_pages(spark, _land_pages(spark, sf, "pages-check", defects=True))
    return src.page_completeness(pages, ["datatype", "request"])


GAP_PAGE_ROWS, REQUEST_DAYS = 10, 30


def q_missing_pages(spark, sf):
    """Runs of missing pages: of every seven pages the third to the fifth are
    lost, and all of the requests of every sixth month."""
    root = _land_pages(spark, sf, "page-gaps", page_rows=GAP_PAGE_ROWS,
                       lost=lambda month, page: (page % 7).between(2, 4) | (month % 6 == 0))
    requests = _typed(spark, sf).groupBy("datatype", F.concat(F.lit("m"), F.date_format("date", "yyyyMM")).alias(
        "request")).agg(F.count(F.lit(1)).alias("total"))
    return gaps.missing_pages(requests, src.read_pages(spark, root), ["datatype", "request"], limit=GAP_PAGE_ROWS)


def q_gap_requests(spark, sf):
    """The fewest requests of at most thirty days for all days of the observed
    span on which a station has no value of a datatype."""
    typed = _typed(spark, sf)
    first, last = _observed_span(spark, sf).first()
    spans = typed.select("station", "datatype").distinct().select(
        "*", F.lit(first).alias("start"), F.lit(last).alias("end"))
    missing = gaps.missing_days(spans, typed.withColumnRenamed("date", "day"), ["station", "datatype"])
    return gaps.fewest_requests(missing, REQUEST_DAYS)


def q_station_changes(spark, sf):
    """The feed from the known stations to the enriched catalog, from which
    ids that end in 4 or 8 are gone."""
    new = _as_records(_enriched_catalog(spark, sf)).where(~F.substring("id", -1, 1).isin("4", "8"))
    return changes.snapshot_changes(_as_records(fx.fx_stations(spark, sf)), new)


def q_apply_station_changes(spark, sf):
    """The known stations after that feed."""
    old = _as_records(fx.fx_stations(spark, sf))
    feed, _path = tables.stage(q_station_changes(spark, sf), spark, "station-changes")
    return changes.apply_changes(old, feed)


def q_compacted_scan(spark, sf):
    """Raw rows of both zones: all months are compacted, then the first one is
    landed again."""
    raw, compact = _landed(spark, sf, "compact", shared=False), _scratch(spark, "compact") + "/compact"
    first, last = _observed_span(spark, sf).first()
    compaction.compact_months(spark, raw, compact, first, last)
    observations = fx.fx_raw_observations(spark, sf)
    landing.land_observations(observations.where(F.col("date").startswith(f"{first:%Y-%m}")), raw,
                              rows=observations.count())
    return compaction.scan_landed(spark, raw, compact)


def q_incremental_load(spark, sf):
    """The curated table after two runs of the incremental load: before the
    second, the later half of the span and all TAVG values are landed."""
    root = _scratch(spark, "incremental")
    raw, results, seen = f"{root}/raw", f"{root}/transformed_results", f"{root}/seen"
    observations = fx.fx_raw_observations(spark, sf)
    first, last = _observed_span(spark, sf).first()
    middle = first + (last - first) / 2
    early = (F.col("date") < F.lit(middle.isoformat())) & (F.col("datatype") != "TAVG")
    for part in (observations.where(early), observations.where(~early)):
        landing.land_observations(part, raw, rows=observations.count())
        incremental.run_incremental_load(spark, raw, results, seen)
    return tables.read_table(spark, results, "transformed_results").select(*TRANSFORMED_RESULTS.fieldNames())


def q_join_bucketed(spark, sf):
    """The fact-to-dimension join of two tables bucketed by station."""
    results, dim = curated_inputs(spark, sf)
    root, tag = _scratch(spark, "bucketed"), uuid.uuid4().hex[:12]
    return bucketed.join_bucketed(
        spark, bucketed.write_bucketed(results, f"pluvio_results_{tag}", f"{root}/results", "station", buckets=8),
        bucketed.write_bucketed(dim, f"pluvio_stations_{tag}", f"{root}/stations", "id", buckets=8))


def _snapshot_layout(spark, sf, name: str) -> jobs.Layout:
    layout = jobs.Layout(_scratch(spark, name))
    current = _as_records(_enriched_catalog(spark, sf))
    landing.write_station_snapshot(current, layout.raw_stations, RUN_DATE)
    landing.write_manifest(spark, layout.raw_stations, layout.manifest, RUN_DATE, current)
    return layout


def q_scan_station_snapshot(spark, sf):
    layout = _snapshot_layout(spark, sf, "snapshot-scan")
    return landing.scan_station_snapshot(spark, layout.raw_stations, layout.manifest)


def _table(spark, name: str, table: str) -> str:
    path = _scratch(spark, name) + "/" + table
    tables.ensure_table(spark, path, table)
    return path


def q_scan_table(spark, sf):
    r, _ = curated_inputs(spark, sf)
    path = _table(spark, "scan-table", "transformed_results")
    tables.upsert_observations(r, path)
    df = tables.read_table(spark, path, "transformed_results")
    df.createOrReplaceTempView("transformed_results")
    return spark.table("transformed_results").select(*TRANSFORMED_RESULTS.fieldNames())


def q_stations_from_rows(spark, sf):
    path = _scratch(spark, "station-rows")
    _as_records(_enriched_catalog(spark, sf)).write.mode("overwrite").json(path)
    return spark.read.schema(STATION_RECORD).json(path)


def q_tolerant_scan(spark, sf):
    """Land, then drop an unreadable file into the first observed day and a
    row without a date that parses into the last: both days (every
    datatype) must disappear from the scan."""
    root = _landed(spark, sf, "tolerant", shared=False)
    span = _typed(spark, sf).agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
    for day, line in ((span["first"], "{ this line is not json"), (span["last"], '{"station": "X", "date": "soon"}')):
        folder = f"{root}/datatype=TMAX/year={day.year}/month={day.month:02d}/day={day.day:02d}"
        spark.range(1).select(F.lit(line).alias("value")).write.mode("append").text(folder)
    rows, _bad = src.tolerant_scan(spark, root)
    return rows


# --- H: sinks ---------------------------------------------------------------------------------

def q_land_observations(spark, sf):
    """What was landed, and one row whose date does not parse, as rejected."""
    raw = fx.fx_raw_observations(spark, sf)
    undated = raw.groupBy().agg(F.min("station").alias("station")).select(
        "station", F.lit("not a date").alias("date"), F.lit("TMAX").alias("datatype"),
        F.lit("x").alias("attributes"), F.lit(1.0).alias("value"))
    root = _scratch(spark, "land") + "/raw/results"
    landing.land_observations(raw.unionByName(undated), root)
    landed = src.scan_observations(spark, root).withColumn("reason", F.lit(None).cast("string"))
    return landed.unionByName(landing.read_rejected(spark, root), allowMissingColumns=True)


def q_write_station_snapshot(spark, sf):
    layout = _snapshot_layout(spark, sf, "snapshot-write")
    return landing.read_snapshot(spark, layout.raw_stations)


def q_write_manifest(spark, sf):
    """The manifest; its (random) file names give way to the regions that
    their folders name."""
    layout = _snapshot_layout(spark, sf, "manifest")
    regions = F.transform("files", lambda f: F.url_decode(F.replace(
        F.regexp_extract(f, "region=([^/]+)/", 1), F.lit("+"), F.lit("%2B"))))
    return landing.read_manifest(spark, layout.manifest).select(
        "last_updated", "total_stations", "regions", F.array_sort(F.array_distinct(regions)).alias("file_regions"))


def q_ensure_tables(spark, sf):
    """Every column of every table, as created and stored, and the rows of
    the table after the curated ones were loaded."""
    root = _scratch(spark, "ensure")
    tables.ensure_tables(spark, root)
    r, s = curated_inputs(spark, sf)
    tables.upsert_observations(r, f"{root}/transformed_results")
    tables.upsert_stations(s, f"{root}/transformed_stations")
    parts = []
    for name in tables.table_names():
        stored = tables.read_table(spark, f"{root}/{name}", name)
        contract, folders = tables.table_schema(name), PARTITIONING.get(name, [])
        columns = F.array(*[F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.name in contract.fieldNames() and not contract[f.name].nullable).alias("required"),
            F.lit(f.name in folders).alias("partition")) for f in stored.schema.fields])
        parts.append(stored.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.explode(columns).alias("c"), "rows").select("table", "c.*", "rows"))
    return obs_ops.append_observations(*parts)


def _upsert_batches(spark, sf):
    raw = fx.fx_observations(spark, sf)
    rows = raw.count()
    b1 = obs_ops.pivot_daily(raw.where(F.col("datatype").isin("TMAX", "TMIN", "TAVG")), rows)
    b2 = obs_ops.pivot_daily(raw.where(F.col("datatype").isin("PRCP", "TAVG")), rows)
    b2 = b2.where(F.col("date") >= F.lit(UPSERT_FROM))
    return b1, b2


def q_upsert_observations(spark, sf):
    b1, b2 = _upsert_batches(spark, sf)
    path = _table(spark, "upsert-results", "transformed_results")
    tables.upsert_observations(b1, path)
    tables.upsert_observations(b2, path)
    return tables.read_table(spark, path, "transformed_results").select(
        *TRANSFORMED_RESULTS.fieldNames())


def q_upsert_stations(spark, sf):
    """Stations whose state is two digits, most replaced by the catalog's."""
    path = _table(spark, "upsert-stations", "transformed_stations")
    tables.upsert_stations(fx.fx_stations(spark, sf).withColumn("state", F.substring("id", -2, 2)), path)
    good, _ = stations.typed_stations(_as_records(_enriched_catalog(spark, sf)))
    tables.upsert_stations(good, path)
    return tables.read_table(spark, path, "transformed_stations")


def q_overwrite_view(spark, sf):
    name = "precipitation_anomaly_by_state_by_year"
    path = _scratch(spark, "view") + f"/presentation_{name}"
    tables.overwrite_view(VIEWS[name](*curated_inputs(spark, sf), ordered=False), path, name)
    return tables.read_table(spark, path, f"presentation_{name}")


# --- J: jobs -------------------------------------------------------------------------------------

def q_job_transform_observations(spark, sf):
    layout = jobs.Layout(_scratch(spark, "job-obs"), raw=_landed(spark, sf, "job-obs"))
    bounds = _typed(spark, sf).agg(F.min("date").alias("s"), F.max("date").alias("e")).first()
    jobs.job_transform_observations(spark, layout, bounds["s"], bounds["e"])
    return tables.read_table(spark, layout.results, "transformed_results").select(
        *TRANSFORMED_RESULTS.fieldNames())


def _refreshed(spark, sf, name: str) -> jobs.Layout:
    """Seed snapshot + dimension with the known stations, then refresh from
    the observations: only the new, resolvable stations are added."""
    layout = jobs.Layout(_scratch(spark, name))
    known = _as_records(fx.fx_stations(spark, sf))
    landing.write_station_snapshot(known, layout.raw_stations, OLD_SNAPSHOT_DATE)
    landing.write_manifest(spark, layout.raw_stations, layout.manifest, OLD_SNAPSHOT_DATE, known)
    tables.ensure_table(spark, layout.stations, "transformed_stations")
    tables.upsert_stations(fx.fx_stations(spark, sf), layout.stations)
    catalog, cells, codes = _aux(spark, sf)
    jobs.job_refresh_stations(spark, layout, fx.fx_observations(spark, sf),
                              catalog, cells, codes, RUN_DATE)
    return layout


def q_job_refresh_stations(spark, sf):
    layout = _refreshed(spark, sf, "job-stations")
    return tables.read_table(spark, layout.stations, "transformed_stations")


def q_rejected_stations(spark, sf):
    """The reject table after the same refresh: stations without a catalog
    record, and those whose record does not type."""
    layout = _refreshed(spark, sf, "job-rejects")
    return tables.read_table(spark, layout.rejects, "rejected_stations")


def _stored_values(spark, layout: jobs.Layout, views) -> DataFrame:
    parts = [as_values(name, tables.read_table(spark, layout.presentation(name), f"presentation_{name}"))
             for name in views]
    return obs_ops.append_observations(*parts)


def q_job_presentation(spark, sf):
    """All values of all presentation tables."""
    layout = jobs.Layout(_scratch(spark, "job-presentation"))
    r, s = curated_inputs(spark, sf)
    tables.ensure_table(spark, layout.results, "transformed_results")
    tables.ensure_table(spark, layout.stations, "transformed_stations")
    tables.upsert_observations(r, layout.results)
    tables.upsert_stations(s, layout.stations)
    return _stored_values(spark, layout, jobs.all_refreshed(jobs.job_presentation(spark, layout)))


def _middle_month(dated: DataFrame) -> dict:
    """Year and month of the day in the middle of the observed span."""
    span = dated.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    middle = F.date_add("first", F.floor(F.datediff("last", "first") / 2).cast("int"))
    return span.select(F.year(middle).alias("year"), F.month(middle).alias("month")).first().asDict()


def q_job_delta_refresh(spark, sf):
    """All values of all presentation tables, refreshed whole while one month
    had no rain and no TMAX, and again for that month alone when it was loaded."""
    layout = jobs.Layout(_scratch(spark, "job-delta"))
    r, s = curated_inputs(spark, sf)
    late = _middle_month(_typed(spark, sf))  # the same days as the pivoted rows, without the pivot
    is_late = (F.year("date") == late["year"]) & (F.month("date") == late["month"])
    tables.ensure_table(spark, layout.results, "transformed_results")
    tables.ensure_table(spark, layout.stations, "transformed_stations")
    tables.upsert_stations(s, layout.stations)
    early = {c: F.when(~is_late, F.col(c)) for c in ("tmax", "prcp")}
    tables.upsert_observations(r.withColumns(early), layout.results)
    jobs.all_refreshed(jobs.job_presentation(spark, layout))
    load = r.where(is_late)
    tables.upsert_observations(load, layout.results)
    months = load.select(F.year("date").alias("year"), F.month("date").alias("month")).distinct()
    return _stored_values(spark, layout, jobs.all_refreshed(jobs.job_presentation(spark, layout, months=months)))


def _pipeline_values(spark, sf, name: str, ranges: DataFrame) -> DataFrame:
    """Whole chain from an empty deployment over the landed observations, for
    requests from ``s`` to ``e``. Returns all values of all tables."""
    layout = jobs.Layout(_scratch(spark, name), raw=_landed(spark, sf, name))
    requests = ranges.select(F.col("s").cast("string").alias("start_date"), F.col("e").cast("string").alias("end_date"),
                             F.lit("monthly").alias("frequency"))
    catalog, cells, codes = _aux(spark, sf)
    report = jobs.job_pipeline(spark, layout, None, requests, catalog, cells, codes,
                               as_of=RUN_DATE, run_date=RUN_DATE)
    results = tables.read_table(spark, layout.results, "transformed_results")
    dimension = tables.read_table(spark, layout.stations, "transformed_stations")
    return obs_ops.append_observations(
        as_values("transformed_results", results), as_values("transformed_stations", dimension),
        _stored_values(spark, layout, report["views"]))


def _observed_span(spark, sf) -> DataFrame:
    return obs_ops.observed_span(fx.fx_observations(spark, sf))


def span_requests(span: DataFrame) -> DataFrame:
    """Two disjoint ranges (s, e) that cover the days from ``first`` to
    ``last`` but for the calendar month in the middle."""
    days = F.datediff("last", "first")
    middle = F.date_add("first", F.floor(days / 2).cast("int"))
    return span.select(F.inline(F.array(
        F.struct(F.col("first").alias("s"), F.date_sub(F.trunc(middle, "month"), 1).alias("e")),
        F.struct(F.date_add(F.last_day(middle), 1).alias("s"), F.col("last").alias("e"))))).where("s <= e")


def q_job_pipeline(spark, sf):
    """The chain for two requests that cover the observed span but for one
    month, whose landed days must be left out."""
    return _pipeline_values(spark, sf, "job-pipeline", span_requests(_observed_span(spark, sf)))


QUERIES: dict[str, Query] = {}
for _name in VIEWS:
    def _view_query(spark, sf, _n=_name):
        return VIEWS[_n](*curated_inputs(spark, sf))
    QUERIES[_name] = _view_query


def q_total_stations_by_state(spark, sf):
    results, _ = curated_inputs(spark, sf)
    return VIEWS["total_stations_by_state"](results, fx.fx_all_stations(spark, sf))


QUERIES.update({
    # F3 reads the dimension alone: all of it
    "total_stations_by_state": q_total_stations_by_state,
    # A
    "scan_observations": q_scan_observations,
    "explode_pages": q_explode_pages,
    "page_completeness": q_page_completeness,
    "scan_observations_by_type": q_scan_observations_by_type,
    "scan_station_snapshot": q_scan_station_snapshot,
    "scan_table": q_scan_table,
    "stations_from_rows": q_stations_from_rows,
    "tolerant_scan": q_tolerant_scan,
    # B
    "periods_last_month": q_periods_last_month,
    "periods_daily": q_periods_daily,
    "periods_monthly": q_periods_monthly,
    "periods_yearly": q_periods_yearly,
    "periods_custom": q_periods_custom,
    "expand_days": q_expand_days,
    "expected_loads": q_expected_loads,
    "expected_pages": q_expected_pages,
    "missing_pages": q_missing_pages,
    "gap_requests": q_gap_requests,
    # C
    "observation_key": q_observation_key,
    "typed_observations": q_typed_observations,
    "observation_day_parts": q_observation_day_parts,
    "valid_station_ids": q_valid_station_ids,
    "station_projection": q_station_projection,
    "typed_stations": q_typed_stations,
    "reject_stations": q_reject_stations,
    "conform_schema": q_conform_schema,
    "contract_violations": q_contract_violations,
    "rainy_filter": q_rainy_filter,
    "datatype_filter": q_datatype_filter,
    "period_filter": q_period_filter,
    # D
    "join_observations_stations": q_join_observations_stations,
    "join_bucketed": q_join_bucketed,
    "join_annual_to_history": q_join_annual_to_history,
    "new_station_ids": q_new_station_ids,
    "lookup_state_code": q_lookup_state_code,
    "assign_state": q_assign_state,
    "assign_region": q_assign_region,
    "enrich_stations": q_enrich_stations,
    "unresolved_stations": q_unresolved_stations,
    # E
    "pivot_daily": q_pivot_daily,
    "distinct_station_ids": q_distinct_station_ids,
    "agg_avg": q_agg_avg,
    "agg_sum": q_agg_sum,
    "agg_min_max": q_agg_min_max,
    "agg_count": q_agg_count,
    "agg_count_distinct": q_agg_count_distinct,
    "agg_of_agg": q_agg_of_agg,
    "group_by_expression": q_group_by_expression,
    "month_cube": q_month_cube,
    "rainy_days_bitmap": q_rainy_days_bitmap,
    "stations_by_region": q_stations_by_region,
    "manifest_summary": q_manifest_summary,
    "row_counts": q_row_counts,
    "dedupe_last_wins": q_dedupe_last_wins,
    # G
    "sort_by_keys": q_sort_by_keys,
    "sort_by_count_desc": q_sort_by_count_desc,
    "sort_by_season": q_sort_by_season,
    "station_union": q_station_union,
    "append_observations": q_append_observations,
    # H
    "land_observations": q_land_observations,
    "compacted_scan": q_compacted_scan,
    "write_station_snapshot": q_write_station_snapshot,
    "station_changes": q_station_changes,
    "apply_station_changes": q_apply_station_changes,
    "write_manifest": q_write_manifest,
    "ensure_tables": q_ensure_tables,
    "upsert_observations": q_upsert_observations,
    "upsert_stations": q_upsert_stations,
    "overwrite_view": q_overwrite_view,
    # J
    "job_transform_observations": q_job_transform_observations,
    "job_refresh_stations": q_job_refresh_stations,
    "rejected_stations": q_rejected_stations,
    "job_presentation": q_job_presentation,
    "job_delta_refresh": q_job_delta_refresh,
    "incremental_load": q_incremental_load,
    "job_pipeline": q_job_pipeline,
})

ORACLE: dict[str, str] = {k: v for k, v in oracle.ALL_SQL.items() if k in QUERIES}

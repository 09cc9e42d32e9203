"""Independent SQL statements of each registered query, for DuckDB.

They run over the driver's raw tables; the bridge views and the curated
tables are inlined as CTEs by ``fixtures.with_views``. Column names match
the Spark results exactly.
"""

from __future__ import annotations

from ..fixtures import with_views
from ..functions.constants import STATE_CODES
from ..schemas import MEASURES
from .values import values_sql

R_S = ("transformed_results", "transformed_stations")

#: view -> (statement, the bridge views it reads)
VIEW_BODIES: dict[str, tuple[str, tuple[str, ...]]] = {
    "monthly_avg_temp": ("""
        select state, month, ifnull(avg(tavg), 0) as avg_temp
        from station_days group by all order by state, month""", ("station_days",)),
    "station_summary": ("""
        select station as station_id, state, cast(count(*) as integer) as total_measurements,
               ifnull(avg(tavg), 0) as avg_temp
        from station_days group by all order by total_measurements desc, station_id""", ("station_days",)),
    "total_stations_by_state": ("""
        select state, cast(count(*) as integer) as total_stations
        from transformed_stations group by all order by total_stations desc, state""", ("transformed_stations",)),
    "total_measurements_by_station": ("""
        select station as station_id, cast(count(*) as integer) as total_measurements
        from transformed_results group by all order by total_measurements desc, station_id""",
                                      ("transformed_results",)),
    "precipitation_by_state_by_year": ("""
        select state, year, ifnull(sum(prcp), 0) as total_precipitation
        from station_days group by all order by state, year""", ("station_days",)),
    "central_tendence_tmin_tmax_by_month": ("""
        select cast(date_trunc('month', date) as timestamp) as month,
               ifnull(avg(tmin), 0) as avg_tmin, ifnull(avg(tmax), 0) as avg_tmax
        from transformed_results group by all order by month""", ("transformed_results",)),
    "extreme_temperature_by_state": ("""
        select state, ifnull(max(tmax), 0) as max_temp, ifnull(min(tmin), 0) as min_temp
        from station_days group by all order by state""", ("station_days",)),
    "avg_temp_by_season": ("""
        select season, ifnull(avg(tavg), 0) as avg_temp
        from months join transformed_results on month(date) = m
        group by season, place order by place""", ("months", "transformed_results")),
    "preciptation_by_season": ("""
        select season, ifnull(sum(prcp), 0) as total_precipitation
        from months join transformed_results on month(date) = m
        group by season, place order by place""", ("months", "transformed_results")),
    "precipitation_anomaly_by_state_by_year": ("""
        , totals as (select state, year, sum(prcp) as mm from station_days group by all),
        beside as (select *, avg(mm) over (partition by state) as usual from totals)
        select state, year, ifnull(mm, 0) as total_precipitation,
               ifnull(usual, 0) as historical_avg_precipitation, ifnull(mm - usual, 0) as anomaly_mm,
               case when usual <> 0 and mm is not null then (mm - usual) / usual * 100 else 0 end as anomaly_pct
        from beside order by state, year""", ("station_days",)),
    "rainy_days_by_state_by_year": ("""
        select state, year, cast(count(distinct date) as integer) as rainy_days
        from station_days where prcp > 0 group by all order by state, year""", ("station_days",)),
}


def view_sql(name: str, overrides: dict | None = None) -> str:
    body, views = VIEW_BODIES[name]
    return with_views(body, *views, overrides=overrides)


VIEW_SQL = {name: view_sql(name) for name in VIEW_BODIES}
VIEW_SQL["total_stations_by_state"] = view_sql("total_stations_by_state", {
    "transformed_stations": ("select * from fx_all_stations", ("fx_all_stations",))})


# --- operator entries ---------------------------------------------------------

OBS_TYPED = ("select station, cast(cast(date as timestamp) as date) as date, datatype, "
             "cast(value as double) as value from fx_observations")
REQ = ("select station, min(date) as s, max(date) as e from (" + OBS_TYPED + ") "
       "group by station")
MONTHLY = f"""select station, greatest(cast(g as date), s) as start,
       least(cast(g + interval 1 month as date) - 1, e) as "end"
from (select station, s, e,
             unnest(generate_series(cast(date_trunc('month', s) as timestamp),
                                    cast(e as timestamp), interval 1 month)) as g
      from ({REQ}))"""
# Station records after D6 (+ D5 + D4) over every catalog id.
ENRICHED_CATALOG = """select c.id, c.name, c.latitude, c.longitude, c.elevation,
       c.elevationUnit as elevation_unit, k.code as state, c.datacoverage,
       c.mindate, c.maxdate
from fx_full_catalog c
left join fx_region_cells g
  on g.cell_lat = cast(floor(c.latitude) as int) and g.cell_lon = cast(floor(c.longitude) as int)
left join fx_state_codes k on k.state_name = g.state_name"""
# The same without the ids that the lookup source does not have.
ENRICHED = f"select * from ({ENRICHED_CATALOG}) where id in (select id from fx_station_catalog)"
NEW_IDS = """select distinct station as id from fx_observations
where station is not null and station <> ''
  and station not in (select id from fx_stations)"""
RECORD_COLS = ("id", "name", "latitude", "longitude", "elevation", "elevation_unit",
               "state", "datacoverage", "mindate", "maxdate")
AS_RECORDS = ", ".join(f"cast({c} as varchar) as {c}" for c in RECORD_COLS)
TYPED_COLS = ", ".join(RECORD_COLS)
CAT = ("fx_full_catalog", "fx_station_catalog", "fx_region_cells", "fx_state_codes")
OBS = ("fx_observations",)
RAW = ("fx_raw_observations",)
# A landed row: the raw fields and its day folder.
LANDED = """select station, date, datatype, attributes, value, cast(year(d) as integer) as year,
       cast(month(d) as integer) as month, cast(day(d) as integer) as day, d
from (select *, cast(left(date, 10) as date) as d from fx_raw_observations)"""
KNOWN_STATES = "[" + ", ".join(f"'{name}'" for name, _ in STATE_CODES) + "]"
KNOWN_CODES = "[" + ", ".join(f"'{code}'" for _, code in STATE_CODES) + "]"
RESULT_COLS = "id, station, date, tmax, tmin, tavg, prcp"

CHANGE_VALUES = [c for c in RECORD_COLS if c != "id"]
# The feed from the known stations to the catalog without ids that end in 4 or 8.
STATION_CHANGES = f"""
    select coalesce(n.id, o.id) as id,
           case when o.id is null then 'insert' when n.id is null then 'delete' else 'update' end as change,
           case when o.id is null or n.id is null then cast([] as varchar[]) else list_filter([{', '.join(
               f"case when o.{c} is distinct from n.{c} then '{c}' end" for c in CHANGE_VALUES)}],
               lambda x: x is not null) end as changed,
           {', '.join(f'n.{c}' for c in CHANGE_VALUES)}
    from (select {AS_RECORDS} from fx_stations) o full join (
        select {AS_RECORDS} from ({ENRICHED_CATALOG}) where right(id, 1) not in ('4', '8')) n on n.id = o.id
    where o.id is null or n.id is null or ({', '.join(f'o.{c}' for c in CHANGE_VALUES)}) is distinct from
          ({', '.join(f'n.{c}' for c in CHANGE_VALUES)})"""


def _w(body: str, *views: str) -> str:
    return with_views(body, *views)


OPERATOR_SQL = {
    # B
    "periods_last_month": _w(f"""
        select as_of, cast(date_trunc('month', as_of - interval 1 month) as date) as start,
               last_day(cast(as_of - interval 1 month as date)) as "end"
        from (select distinct date as as_of from ({OBS_TYPED}))""", *OBS),
    "periods_daily": _w(f"""
        select station, cast(g as date) as start, cast(g as date) as "end"
        from (select station, unnest(generate_series(cast(s as timestamp), cast(e as timestamp),
                                                     interval 1 day)) as g from ({REQ}))""", *OBS),
    "periods_monthly": _w(MONTHLY, *OBS),
    "periods_yearly": _w(f"""
        select station, greatest(cast(g as date), s) as start,
               least(cast(g + interval 1 year as date) - 1, e) as "end"
        from (select station, s, e,
                     unnest(generate_series(cast(date_trunc('year', s) as timestamp),
                                            cast(e as timestamp), interval 1 year)) as g
              from ({REQ}))""", *OBS),
    "periods_custom": _w(f"""
        select station, s + cast(i as integer) as start,
               least(s + cast(i + 6 as integer), e) as "end"
        from (select station, s, e, unnest(generate_series(0, datediff('day', s, e), 7)) as i
              from ({REQ}))""", *OBS),
    "expand_days": _w(f"""
        select station, start, "end", cast(d as date) as day
        from (select station, start, "end",
                     unnest(generate_series(cast(start as timestamp), cast("end" as timestamp),
                                            interval 1 day)) as d
              from ({MONTHLY}))""", *OBS),
    "expected_loads": _w(f"""
        select p.station, p.start, p."end", t.datatype
        from ({MONTHLY}) p
        cross join (values ('TMAX'), ('TMIN'), ('TAVG'), ('PRCP')) t(datatype)
        where not exists (
            select 1 from ({OBS_TYPED}) o
            where o.station = p.station and o.datatype = t.datatype
              and date_trunc('month', o.date) = date_trunc('month', p.start))""", *OBS),
    "expected_pages": _w(f"""
        select datatype, year, total, o as "offset",
               cast((o - 1) // 1000 + 1 as integer) as page
        from (select datatype, year, total, unnest(generate_series(1, total, 1000)) as o
              from (select datatype, cast(year(date) as integer) as year, count(*) as total
                    from ({OBS_TYPED}) group by 1, 2))""", *OBS),
    "missing_pages": _w(f"""
        , requests as (
            select datatype, 'm' || strftime(d, '%Y%m') as request, month(d) as mm, count(*) as total
            from ({LANDED}) group by all),
        lost as (
            select *, p - row_number() over (partition by datatype, request order by p) as run
            from (select *, unnest(range(0, (total + 9) // 10)) as p from requests)
            where p % 7 between 2 and 4 or mm % 6 = 0)
        select datatype, request, min(p) * 10 + 1 as "offset", count(*) as pages,
               least(count(*) * 10, total - min(p) * 10) as rows
        from lost group by datatype, request, total, run""", *RAW),
    "gap_requests": _w(f"""
        , days as (select distinct station, datatype, date from ({OBS_TYPED})),
        span as (select min(date) as low, max(date) as high from days),
        wanted as (
            select station, datatype, cast(unnest(generate_series(cast(low as timestamp), cast(high as timestamp),
                                                                  interval 1 day)) as date) as date
            from (select distinct station, datatype from days), span),
        islands as (
            select station, datatype, min(date) as s, max(date) as e
            from (select *, date - cast(row_number() over (partition by station, datatype order by date) as integer) as run
                  from wanted anti join days using (station, datatype, date))
            group by station, datatype, run)
        select station, datatype, s + cast(i as integer) as start, least(s + cast(i + 29 as integer), e) as "end"
        from (select *, unnest(generate_series(0, datediff('day', s, e), 30)) as i from islands)""", *OBS),
    # C
    "observation_key": _w(f"""
        select station, date, datatype, value,
               concat(replace(station, 'GHCND:', ''), '_', strftime(date, '%Y%m%d')) as id
        from ({OBS_TYPED})""", *OBS),
    "typed_observations": _w(OBS_TYPED, *OBS),
    "observation_day_parts": _w("""
        select station, date, datatype, value,
               cast(year(cast(cast(date as timestamp) as date)) as integer) as year,
               lpad(cast(month(cast(date as timestamp)) as varchar), 2, '0') as month,
               lpad(cast(day(cast(date as timestamp)) as varchar), 2, '0') as day
        from fx_observations""", *OBS),
    "valid_station_ids": _w("""
        select * from fx_observations where station is not null and station <> ''""", *OBS),
    "station_projection": _w("""
        select id, name, latitude, longitude, elevation, elevationUnit as elevation_unit,
               datacoverage, mindate, maxdate from fx_full_catalog""", *CAT),
    "typed_stations": _w(f"""
        select {TYPED_COLS} from ({ENRICHED_CATALOG}) where state is not null""", *CAT),
    "reject_stations": _w(f"""
        select {AS_RECORDS}, 'missing state' as reason
        from ({ENRICHED_CATALOG}) where state is null""", *CAT),
    "contract_violations": _w("""
        , broken as (select case when right(station, 1) <> '9' then station end as station,
                            case when day(date) <> 5 then date end as date from transformed_results)
        select 'id' as "column", count(*) filter (where station is null or date is null) as violations from broken
        union all select 'station', count(*) filter (where station is null) from broken
        union all select 'date', count(*) filter (where date is null) from broken""", "transformed_results"),
    "conform_schema": _w(f"select {RESULT_COLS} from transformed_results",
                         "transformed_results"),
    "rainy_filter": _w(f"select {RESULT_COLS} from transformed_results where prcp > 0",
                       "transformed_results"),
    "datatype_filter": _w("select * from fx_observations where datatype in ('TMAX', 'PRCP')",
                          *OBS),
    "period_filter": _w(f"""
        select * from ({OBS_TYPED})
        where date between date '1996-01-01' and date '1998-12-31'""", *OBS),
    # D
    "join_observations_stations": _w("""
        select id, station, date, tmax, tmin, tavg, prcp, state from station_days""", "station_days"),
    "join_bucketed": _w("""
        select id, station, date, tmax, tmin, tavg, prcp, state from station_days""", "station_days"),
    "join_annual_to_history": _w("""
        , totals as (select state, year, sum(prcp) as total_precipitation from station_days group by all)
        select *, avg(total_precipitation) over (partition by state) as historical_avg_precipitation
        from totals""", "station_days"),
    "new_station_ids": _w(NEW_IDS, "fx_observations", "fx_stations"),
    "lookup_state_code": _w(f"""
        select id, ifnull({KNOWN_STATES}[n], 'Nowhere') as state_name, {KNOWN_CODES}[n] as code
        from (select id, cast(right(id, -7) as bigint) % 28 + 1 as n from fx_all_stations)""",
                            "fx_all_stations"),
    "assign_state": _w("""
        select c.id, c.latitude, c.longitude, g.state_name
        from fx_full_catalog c left join fx_region_cells g
          on g.cell_lat = cast(floor(c.latitude) as int)
         and g.cell_lon = cast(floor(c.longitude) as int)""", *CAT),
    "assign_region": _w("""
        , crossings as (
            select p.id, s.state_name, count(*) as n
            from fx_places p join fx_region_sides s on s.y1 <= p.latitude and p.latitude < s.y2
             and p.longitude < (s.x2 - s.x1) * (p.latitude - s.y1) / (s.y2 - s.y1) + s.x1
            group by all)
        select p.id, p.latitude, p.longitude, min(c.state_name) as state_name
        from fx_places p left join crossings c on c.id = p.id and c.n % 2 = 1 group by all""",
                        "fx_places", "fx_region_sides"),
    "enrich_stations": _w(f"""
        select e.* from ({ENRICHED}) e where e.id in ({NEW_IDS})""",
                          "fx_observations", "fx_stations", *CAT),
    "unresolved_stations": _w(f"""
        select id from ({NEW_IDS}) where id not in (select id from fx_station_catalog)""",
                              "fx_observations", "fx_stations", "fx_station_catalog"),
    # E
    "pivot_daily": _w(f"select {RESULT_COLS} from transformed_results", "transformed_results"),
    "distinct_station_ids": _w("""
        select distinct station as id from fx_observations
        where station is not null and station <> ''""", *OBS),
    "agg_avg": _w("""select station, coalesce(avg(tavg), 0) as avg_tavg
                     from transformed_results group by station""", "transformed_results"),
    "agg_sum": _w("""select station, coalesce(sum(prcp), 0) as total_prcp
                     from transformed_results group by station""", "transformed_results"),
    "agg_min_max": _w("""select station, coalesce(max(tmax), 0) as max_tmax,
                                coalesce(min(tmin), 0) as min_tmin
                         from transformed_results group by station""", "transformed_results"),
    "agg_count": _w(f"""select station, datatype, cast(count(*) as integer) as n
                        from ({OBS_TYPED}) group by 1, 2""", *OBS),
    "agg_count_distinct": _w(f"""select station, cast(count(distinct date) as integer) as days
                                 from ({OBS_TYPED}) group by 1""", *OBS),
    "agg_of_agg": _w("""
        select station, coalesce(avg(total), 0) as mean_yearly_prcp
        from (select station, date_trunc('year', date) as y, sum(prcp) as total
              from transformed_results group by 1, 2)
        group by station""", "transformed_results"),
    "group_by_expression": _w(f"""
        select cast(date_trunc('year', date) as timestamp) as year, season,
               cast(count(*) as integer) as station_days
        from transformed_results join months on month(date) = m group by 1, 2""", "transformed_results", "months"),
    "month_cube": _w(f"""
        select station, year(date) as year, month(date) as month, count(*) as days, {', '.join(
            f'count({m}) as {m}_n, sum({m}) as {m}_sum, min({m}) as {m}_min, max({m}) as {m}_max' for m in MEASURES)},
               cast(bit_or(1 << (day(date) - 1)::integer) filter (where prcp > 0) as integer) as wet
        from transformed_results group by station, year(date), month(date)""", "transformed_results"),
    "stations_by_region": _w("""
        select coalesce(nullif(state, ''), 'unknown') as region, count(*) as stations
        from fx_all_stations group by 1""", "fx_all_stations"),
    "manifest_summary": _w(f"""
        select date '2002-01-01' as last_updated, cast(count(*) as integer) as total_stations,
               list_sort(list(distinct coalesce(nullif(state, ''), 'unknown'))) as regions,
               cast([] as varchar[]) as files
        from ({ENRICHED_CATALOG})""", *CAT),
    "row_counts": _w("""
        select 'transformed_results' as "table", count(*) as rows from transformed_results
        union all
        select 'transformed_stations', count(*) from transformed_stations""", *R_S),
    "dedupe_last_wins": _w(f"""
        select id, snapshot_date, {', '.join(c for c in RECORD_COLS if c != 'id')}
        from (select *, row_number() over (partition by id order by snapshot_date desc) as rn
              from (select {AS_RECORDS}, date '2001-01-01' as snapshot_date from fx_stations
                    union all
                    select {AS_RECORDS}, date '2002-01-01' as snapshot_date
                    from ({ENRICHED_CATALOG})))
        where rn = 1""", "fx_stations", *CAT),
    # G
    "sort_by_keys": _w(f"select {RESULT_COLS} from transformed_results order by station, date",
                       "transformed_results"),
    "sort_by_count_desc": _w("""
        select station, count(*) as observations from fx_observations
        group by station order by 2 desc, 1""", *OBS),
    "sort_by_season": _w(f"""
        select season, ifnull(avg(tmax), 0) as avg_tmax
        from transformed_results join months on month(date) = m
        group by season, place order by place""", "transformed_results", "months"),
    "station_union": _w(f"""
        select {AS_RECORDS} from ({ENRICHED})
        union all
        select {AS_RECORDS} from fx_all_stations where id not in (select id from ({ENRICHED}))""",
                        "fx_all_stations", *CAT),
    "append_observations": _w(OBS_TYPED, *OBS),
    # A
    "scan_observations": _w(f"""
        select * exclude (d) from ({LANDED})
        where d between date '1996-01-01' and date '1998-12-31'""", *RAW),
    "scan_observations_by_type": _w(f"""
        select * exclude (d) from ({LANDED})
        where d between date '1996-01-01' and date '1998-12-31'
          and datatype in ('TMAX', 'PRCP')""", *RAW),
    "explode_pages": _w("select station, date, datatype, attributes, value from fx_raw_observations", *RAW),
    "page_completeness": _w(f"""
        , requests as (
            select datatype, 'm' || strftime(d, '%Y%m') as request, month(d) as mm, count(*) as n
            from ({LANDED}) group by all),
        pages as (
            select *, datatype = 'TMAX' and mm % 3 = 0 as short, datatype = 'PRCP' and mm % 4 = 0 as broken,
                   cast(ceil(n / 100.0) as bigint) as whole from requests)
        select datatype, request, n as declared, case when short then (whole - 1) * 100 else n end as received,
               case when short then whole - 1 else whole end as pages, whole as expected_pages,
               cast(broken as bigint) as unreadable, not short and not broken as complete
        from pages where not (short and whole = 1)""", *RAW),
    "scan_station_snapshot": _w(f"""
        select {AS_RECORDS}, date '2002-01-01' as snapshot_date,
               coalesce(state, 'unknown') as region
        from ({ENRICHED_CATALOG})""", *CAT),
    "scan_table": _w(f"select {RESULT_COLS} from transformed_results", "transformed_results"),
    "stations_from_rows": _w(f"select {AS_RECORDS} from ({ENRICHED_CATALOG})", *CAT),
    "tolerant_scan": _w(f"""
        , landed as ({LANDED})
        select * exclude (d) from landed
        where d not in (select min(d) from landed) and d not in (select max(d) from landed)""", *RAW),
    # H
    "land_observations": _w(f"""
        select * exclude (d), cast(null as varchar) as reason from ({LANDED})
        union all
        select min(station), 'not a date', 'TMAX', 'x', 1.0, null, null, null, 'unparseable date'
        from fx_raw_observations""", *RAW),
    "write_manifest": _w(f"""
        , regions as (
            select list_sort(list(distinct ifnull(nullif(state, ''), 'unknown'))) as found, count(*) as n
            from ({ENRICHED_CATALOG}))
        select date '2002-01-01' as last_updated, cast(n as integer) as total_stations,
               found as regions, found as file_regions from regions""", *CAT),
    "compacted_scan": _w(f"select * exclude (d) from ({LANDED})", *RAW),
    "station_changes": _w(STATION_CHANGES, "fx_stations", *CAT),
    "apply_station_changes": _w(f"""
        select {AS_RECORDS} from ({ENRICHED_CATALOG}) where right(id, 1) not in ('4', '8')""", *CAT),
    "write_station_snapshot": _w(f"""
        select {AS_RECORDS}, date '2002-01-01' as snapshot_date,
               coalesce(state, 'unknown') as region
        from ({ENRICHED_CATALOG})""", *CAT),
    "upsert_observations": _w(f"""
        , later as (select * replace (cast(null as double) as tmax, cast(null as double) as tmin)
                    from transformed_results
                    where (tavg is not null or prcp is not null) and date >= date '1998-01-01'),
        first as (select * replace (cast(null as double) as prcp) from transformed_results
                  where tmax is not null or tmin is not null or tavg is not null)
        select {RESULT_COLS} from later
        union all by name
        select {RESULT_COLS} from first anti join later using (id)""", "transformed_results"),
    "upsert_stations": _w(f"""
        , good as (select {TYPED_COLS} from ({ENRICHED_CATALOG}) where state is not null)
        select {TYPED_COLS.replace('state', 'right(id, 2) as state')} from fx_stations
        where id not in (select id from good)
        union all select * from good""", "fx_stations", *CAT),
    "overwrite_view": VIEW_SQL["precipitation_anomaly_by_state_by_year"],
    # J
    "incremental_load": _w(f"select {RESULT_COLS} from transformed_results", "transformed_results"),
    "job_transform_observations": _w(f"select {RESULT_COLS} from transformed_results",
                                     "transformed_results"),
    "job_refresh_stations": _w(f"""
        select {TYPED_COLS} from fx_stations
        union all
        select {TYPED_COLS} from ({ENRICHED})
        where id in ({NEW_IDS}) and state is not null""",
                               "fx_observations", "fx_stations", *CAT),
    "rejected_stations": _w(f"""
        select {AS_RECORDS}, 'missing state' as reason from ({ENRICHED})
        where id in ({NEW_IDS}) and state is null
        union all by name
        select id, 'not in the catalog' as reason from ({NEW_IDS})
        where id not in (select id from fx_station_catalog)""", "fx_observations", "fx_stations", *CAT),
    "job_presentation": " union all ".join(
        f"({values_sql(v, view_sql(v))})" for v in VIEW_BODIES),
}

OPERATOR_SQL["job_delta_refresh"] = OPERATOR_SQL["job_presentation"]
OPERATOR_SQL["rainy_days_bitmap"] = VIEW_SQL["rainy_days_by_state_by_year"]

# J4 starts from an empty deployment and loads the observed span but for the calendar month in
# its middle: every station observed there is new, so the dimension is the typed, resolvable part of
# the enriched catalog.
SPANS = {
    "fx_observations": ("""
        select station, date, datatype, value
        from (select *, cast(left(date, 10) as date) as d, min(d) over () as low, max(d) over () as high
              from fx_raw_observations)
        where date_trunc('month', d) <> date_trunc('month', low + cast((high - low) // 2 as integer))""",
                        ("fx_raw_observations",)),
    "transformed_stations": (f"""
        select {TYPED_COLS} from ({ENRICHED})
        where state is not null and id in (select station from fx_observations)""", (*CAT, "fx_observations")),
}
OPERATOR_SQL["job_pipeline"] = " union all ".join(
    [f"({values_sql(t, with_views(f'select * from {t}', t, overrides=SPANS))})" for t in R_S]
    + [f"({values_sql(v, view_sql(v, SPANS))})" for v in VIEW_BODIES])

# H7: what every table is made of, and its rows once the curated tables are loaded.
TABLE_COLUMNS = {
    "transformed_results": "id string!, station string!, date date!, tmax double, tmin double, tavg double, "
                           "prcp double, year int*, month int*",
    "transformed_stations": "id string!, name string!, latitude double!, longitude double!, elevation double!, "
                            "elevation_unit string!, state string!*, datacoverage double!, mindate date!, "
                            "maxdate date!",
    "monthly_avg_temp": "state string!, month timestamp_ntz!, avg_temp double!",
    "station_summary": "station_id string!, state string!, total_measurements int!, avg_temp double!",
    "total_stations_by_state": "state string!, total_stations int!",
    "total_measurements_by_station": "station_id string!, total_measurements int!",
    "precipitation_by_state_by_year": "state string!, year timestamp_ntz!, total_precipitation double!",
    "central_tendence_tmin_tmax_by_month": "month timestamp_ntz!, avg_tmin double!, avg_tmax double!",
    "extreme_temperature_by_state": "state string!, max_temp double!, min_temp double!",
    "avg_temp_by_season": "season string!, avg_temp double!",
    "preciptation_by_season": "season string!, total_precipitation double!",
    "precipitation_anomaly_by_state_by_year":
        "state string!, year timestamp_ntz!, total_precipitation double!, historical_avg_precipitation double!, "
        "anomaly_mm double!, anomaly_pct double!",
    "rainy_days_by_state_by_year": "state string!, year timestamp_ntz!, rainy_days int!",
}


def _table_columns_sql() -> str:
    rows = []
    for name, columns in TABLE_COLUMNS.items():
        label = name if name in R_S else f"presentation_{name}"
        for column in columns.split(", "):
            c, kind = column.split(" ")
            rows.append(f"('{label}', '{c}', '{kind.rstrip('!*')}', {'!' in kind}, {'*' in kind})")
    return f"""
        , described as (select * from (values {', '.join(rows)}) t("table", "column", type, required, "partition"))
        select d.*, case d."table" when 'transformed_results' then (select count(*) from transformed_results)
                                   when 'transformed_stations' then (select count(*) from transformed_stations)
                                   else 0 end as rows
        from described d"""


OPERATOR_SQL["ensure_tables"] = _w(_table_columns_sql(), *R_S)
ALL_SQL = {**VIEW_SQL, **OPERATOR_SQL}

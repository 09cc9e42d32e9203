"""Bridge views from the TPC-H-style test tables to the weather data model.

Each ``fx_*`` builder derives, with Spark, a weather-shaped input from the
driver's tables so every query's work grows with them. The ``SQL_*``
strings are the same views for the DuckDB oracle (tables ``lineitem``,
``supplier``, ``nation`` pre-registered there). Values are whole-numbered
doubles on purpose: sums are then exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _padded(key, width: int) -> F.Column:
    """Zero-padded to at least ``width`` digits; longer keys stay whole."""
    digits = key.cast("string")
    return F.concat(F.repeat(F.lit("0"), F.lit(width) - F.length(digits)), digits)


def _station_code(key) -> F.Column:
    return F.concat(F.lit("GHCND:S"), _padded(key, 6))


def _place(key) -> tuple[F.Column, F.Column]:
    """(row, column) of a supplier on a 35 x 35 grid."""
    return key % 35, F.floor(key / 35) % 35


def fx_raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw long observations as the API gives them, one per line item."""
    li = table(spark, sf_dir, "lineitem")
    slot = F.col("l_linenumber") % 4
    return li.select(
        _station_code(F.col("l_suppkey")).alias("station"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        F.when(slot == 0, "TMAX").when(slot == 1, "TMIN").when(slot == 2, "TAVG")
         .otherwise("PRCP").alias("datatype"),
        F.concat_ws(",", "l_returnflag", "l_linestatus").alias("attributes"),
        F.when(slot == 0, F.col("l_quantity"))
         .when(slot == 1, F.col("l_quantity") - 30)
         .when(slot == 2, F.col("l_quantity") - 15)
         .otherwise(F.round(F.col("l_discount") * 100)).alias("value"),
    )


def fx_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw observations without their attributes."""
    return fx_raw_observations(spark, sf_dir).drop("attributes")


def fx_all_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station dimension of all suppliers."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    row, column = _place(F.col("s_suppkey"))
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        _station_code(F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"),
        (row.cast("double") - 34.5).alias("latitude"), (column.cast("double") - 69.5).alias("longitude"),
        F.col("s_acctbal").alias("elevation"), F.lit("METERS").alias("elevation_unit"),
        F.col("n_name").alias("state"), F.lit(1.0).alias("datacoverage"),
        F.lit("1995-01-01").cast("date").alias("mindate"),
        F.lit("2001-12-31").cast("date").alias("maxdate"),
    )


def fx_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known station dimension; ids ending in 9 are withheld as new (the
    feature of the new-station queries and of unknown stations in joins)."""
    return fx_all_stations(spark, sf_dir).where(~F.col("id").endswith("9"))


def fx_full_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station lookup source of all suppliers (no state)."""
    row, column = _place(F.col("s_suppkey"))
    return table(spark, sf_dir, "supplier").select(
        _station_code(F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"),
        (row.cast("double") - 34.5).alias("latitude"), (column.cast("double") - 69.5).alias("longitude"),
        F.col("s_acctbal").alias("elevation"), F.lit("METERS").alias("elevationUnit"),
        F.lit(1.0).alias("datacoverage"),
        F.lit("1995-01-01").cast("date").alias("mindate"),
        F.lit("2001-12-31").cast("date").alias("maxdate"),
    )


def fx_station_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup source without every 20th supplier (the feature of
    unresolved stations)."""
    missing = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 20 == 19)
    return fx_full_catalog(spark, sf_dir).join(
        missing.select(_station_code(F.col("s_suppkey")).alias("id")), "id", "left_anti")


def fx_region_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-degree grid cells of all suppliers -> state name; some cells absent."""
    row, column = _place(F.col("s_suppkey"))
    cells = (table(spark, sf_dir, "supplier").select(row.cast("int").alias("r"), column.cast("int").alias("c"))
             .distinct().where((F.col("r") + F.col("c")) % 11 != 0))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return cells.join(n, n.n_nationkey == (F.col("r") * 7 + F.col("c")) % 25).select(
        (F.col("r") - 35).alias("cell_lat"), (F.col("c") - 70).alias("cell_lon"), F.col("n_name").alias("state_name"))


def fx_state_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State name -> code; one nation left out to exercise the NULL case.
    Some codes have a space and an accent, as folder names may."""
    n = table(spark, sf_dir, "nation").where(F.col("n_nationkey") != 24)
    key = F.col("n_nationkey")
    return n.select(F.col("n_name").alias("state_name"), F.concat(
        F.when(key % 5 == 0, "São ").otherwise("S"), _padded(key, 2)).alias("code"))


def _corner(row: F.Column, column: F.Column) -> F.Column:
    """A corner of the 6 x 6 lattice between the nations, moved by quarter degrees."""
    return F.struct((row * 7 - 35 + ((row * 3 + column * 5) % 7 - 3) * 0.25).cast("double").alias("latitude"),
                    (column * 7 - 70 + ((row * 5 + column * 2) % 7 - 3) * 0.5).cast("double").alias("longitude"))


def fx_region_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Borders of all nations: crooked quadrilaterals that tile the plane of
    the stations. Every third nation has a lake, which is in no state."""
    key = F.col("n_nationkey")
    row, column = F.floor(key / 5), key % 5
    border = F.array(_corner(row, column), _corner(row, column + 1), _corner(row + 1, column + 1), _corner(row + 1, column))
    middle = [(-1.25, -1.0), (0.0, 1.5), (1.25, -0.5)]
    lake = F.array(*[F.struct((row * 7 - 31.5 + y).cast("double").alias("latitude"),
                              (column * 7 - 66.5 + x).cast("double").alias("longitude")) for y, x in middle])
    rings = F.array_compact(F.array(border, F.when(key % 3 == 0, lake)))
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("state_name"), F.explode(rings).alias("ring"))


def fx_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coordinate for each order, many of them on borders and corners."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"), ((key * 7919 % 1441) * 0.025 - 35.5).alias("latitude"),
        ((key * 104729 % 1477) * 0.025 - 71).alias("longitude"))


# --- the same views in DuckDB SQL (oracle side) ----------------------------

def _sql_padded(key: str, width: int) -> str:
    digits = f"cast({key} as varchar)"
    return f"lpad({digits}, cast(greatest({width}, length({digits})) as integer), '0')"


def _sql_code(key: str) -> str:
    return f"'GHCND:S' || {_sql_padded(key, 6)}"


SQL_FX_RAW_OBSERVATIONS = f"""
select {_sql_code('l_suppkey')} as station,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') as date,
       case l_linenumber % 4 when 0 then 'TMAX' when 1 then 'TMIN'
                             when 2 then 'TAVG' else 'PRCP' end as datatype,
       l_returnflag || ',' || l_linestatus as attributes,
       case l_linenumber % 4 when 0 then l_quantity when 1 then l_quantity - 30
                             when 2 then l_quantity - 15
                             else round(l_discount * 100) end as value
from lineitem"""

SQL_FX_ALL_STATIONS = f"""
select {_sql_code('s_suppkey')} as id, s_name as name,
       cast(s_suppkey % 35 as double) - 34.5 as latitude,
       cast((s_suppkey // 35) % 35 as double) - 69.5 as longitude,
       s_acctbal as elevation, 'METERS' as elevation_unit, n_name as state,
       cast(1 as double) as datacoverage, date '1995-01-01' as mindate,
       date '2001-12-31' as maxdate
from supplier join nation on s_nationkey = n_nationkey"""

SQL_FX_FULL_CATALOG = f"""
select {_sql_code('s_suppkey')} as id, s_name as name,
       cast(s_suppkey % 35 as double) - 34.5 as latitude,
       cast((s_suppkey // 35) % 35 as double) - 69.5 as longitude,
       s_acctbal as elevation, 'METERS' as elevationUnit,
       cast(1 as double) as datacoverage, date '1995-01-01' as mindate,
       date '2001-12-31' as maxdate
from supplier"""

SQL_FX_REGION_CELLS = """
select distinct cast(s_suppkey % 35 as integer) - 35 as cell_lat,
       cast((s_suppkey // 35) % 35 as integer) - 70 as cell_lon, n_name as state_name
from supplier join nation on n_nationkey = ((s_suppkey % 35) * 7 + (s_suppkey // 35) % 35) % 25
where (s_suppkey % 35 + (s_suppkey // 35) % 35) % 11 <> 0"""

SQL_FX_STATE_CODES = f"""
select n_name as state_name,
       case when n_nationkey % 5 = 0 then 'São ' else 'S' end || {_sql_padded('n_nationkey', 2)} as code
from nation where n_nationkey <> 24"""

# Sides of the rings, from south to north.
SQL_FX_REGION_SIDES = """
select state_name, least(a, b).y as y1, least(a, b).x as x1, greatest(a, b).y as y2, greatest(a, b).x as x2
from (select state_name, unnest(ring) as a, unnest(list_concat(ring[2:], ring[1:1])) as b
      from (select n_name as state_name, unnest(case when n_nationkey % 3 = 0 then [border, lake] else [border] end) as ring
            from (select *, [{'y': c.r * 7 - 31.5 - 1.25, 'x': c.c * 7 - 66.5 - 1.0},
                             {'y': c.r * 7 - 31.5, 'x': c.c * 7 - 66.5 + 1.5},
                             {'y': c.r * 7 - 31.5 + 1.25, 'x': c.c * 7 - 66.5 - 0.5}] as lake,
                         list_transform([{'r': c.r, 'c': c.c}, {'r': c.r, 'c': c.c + 1}, {'r': c.r + 1, 'c': c.c + 1},
                                         {'r': c.r + 1, 'c': c.c}], lambda p: {
                             'y': cast(p.r * 7 - 35 as double) + ((p.r * 3 + p.c * 5) % 7 - 3) * 0.25,
                             'x': cast(p.c * 7 - 70 as double) + ((p.r * 5 + p.c * 2) % 7 - 3) * 0.5}) as border
                  from (select *, {'r': n_nationkey // 5, 'c': n_nationkey % 5} as c from nation))))"""

SQL_FX_PLACES = """
select o_orderkey as id, (o_orderkey * 7919 % 1441) * cast(0.025 as double) - 35.5 as latitude,
       (o_orderkey * 104729 % 1477) * cast(0.025 as double) - 71 as longitude
from orders"""

# transformed_results over the fixture: one row per (station, day), MAX per type.
SQL_RESULTS = """
select replace(station, 'GHCND:', '') || '_' || strftime(day, '%Y%m%d') as id, station, day as date,
       max(value) filter (where datatype = 'TMAX') as tmax,
       max(value) filter (where datatype = 'TMIN') as tmin,
       max(value) filter (where datatype = 'TAVG') as tavg,
       max(value) filter (where datatype = 'PRCP') as prcp
from (select *, cast(left(date, 10) as date) as day from fx_observations)
group by station, day"""

# Facts with the state of their station, and the first day of their month and year.
SQL_STATION_DAYS = """
select f.*, d.state, cast(date_trunc('month', f.date) as timestamp) as month,
       cast(date_trunc('year', f.date) as timestamp) as year
from transformed_results f join transformed_stations d on d.id = f.station"""

# The month table: season of each month, and the order in which seasons are shown.
SQL_MONTHS = """
select * from (values (1, 'Verão', 1), (2, 'Verão', 1), (3, 'Outono', 2), (4, 'Outono', 2), (5, 'Outono', 2),
                      (6, 'Inverno', 3), (7, 'Inverno', 3), (8, 'Inverno', 3), (9, 'Primavera', 4),
                      (10, 'Primavera', 4), (11, 'Primavera', 4), (12, 'Verão', 1)) m(m, season, place)"""

SQL_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_raw_observations": (SQL_FX_RAW_OBSERVATIONS, ()),
    "fx_observations": ("select station, date, datatype, value from fx_raw_observations", ("fx_raw_observations",)),
    "fx_all_stations": (SQL_FX_ALL_STATIONS, ()),
    "fx_stations": ("select * from fx_all_stations where right(id, 1) <> '9'", ("fx_all_stations",)),
    "fx_full_catalog": (SQL_FX_FULL_CATALOG, ()),
    "fx_station_catalog": (f"""select * from fx_full_catalog where id not in (
        select {_sql_code('s_suppkey')} from supplier where s_suppkey % 20 = 19)""", ("fx_full_catalog",)),
    "fx_region_cells": (SQL_FX_REGION_CELLS, ()),
    "fx_state_codes": (SQL_FX_STATE_CODES, ()),
    "fx_region_sides": (SQL_FX_REGION_SIDES, ()),
    "fx_places": (SQL_FX_PLACES, ()),
    "transformed_results": (SQL_RESULTS, ("fx_observations",)),
    "transformed_stations": ("select * from fx_stations", ("fx_stations",)),
    "station_days": (SQL_STATION_DAYS, ("transformed_results", "transformed_stations")),
    "months": (SQL_MONTHS, ()),
}


def with_views(body: str, *views: str, overrides: dict | None = None) -> str:
    """Prefix ``body`` with the named bridge views, and those they need, as
    CTEs (DuckDB). ``overrides`` maps a view name to ``(sql, dependencies)``."""
    known = SQL_VIEWS | (overrides or {})
    needed: list[str] = []

    def add(name: str) -> None:
        for d in known[name][1]:
            add(d)
        if name not in needed:
            needed.append(name)

    for v in views:
        add(v)
    return "with " + ",\n".join(f"{name} as ({known[name][0]})" for name in needed) + f"\n{body}"

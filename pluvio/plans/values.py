"""The curated and presentation tables in one shape, to compare them by value.

Every row becomes (table, key, day, v1 .. v4): key columns joined, the date
if there is one, and the numbers as doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: table -> (key columns, day column or None, value columns)
SHAPE: dict[str, tuple[tuple[str, ...], str | None, tuple[str, ...]]] = {
    "transformed_results": (("id", "station"), "date", ("tmax", "tmin", "tavg", "prcp")),
    "transformed_stations": (("id", "name", "state", "elevation_unit"), "mindate",
                             ("latitude", "longitude", "elevation", "datacoverage")),
    "monthly_avg_temp": (("state",), "month", ("avg_temp",)),
    "station_summary": (("station_id", "state"), None, ("total_measurements", "avg_temp")),
    "total_stations_by_state": (("state",), None, ("total_stations",)),
    "total_measurements_by_station": (("station_id",), None, ("total_measurements",)),
    "precipitation_by_state_by_year": (("state",), "year", ("total_precipitation",)),
    "central_tendence_tmin_tmax_by_month": ((), "month", ("avg_tmin", "avg_tmax")),
    "extreme_temperature_by_state": (("state",), None, ("max_temp", "min_temp")),
    "avg_temp_by_season": (("season",), None, ("avg_temp",)),
    "preciptation_by_season": (("season",), None, ("total_precipitation",)),
    "precipitation_anomaly_by_state_by_year": (
        ("state",), "year", ("total_precipitation", "historical_avg_precipitation", "anomaly_mm", "anomaly_pct")),
    "rainy_days_by_state_by_year": (("state",), "year", ("rainy_days",)),
}


def as_values(name: str, df: DataFrame) -> DataFrame:
    keys, day, values = SHAPE[name]
    padded = [*values, *[None] * (4 - len(values))]
    return df.select(
        F.lit(name).alias("table"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"),
        (F.col(day) if day else F.lit(None)).cast("date").alias("day"),
        *[(F.col(v) if v else F.lit(None)).cast("double").alias(f"v{i}") for i, v in enumerate(padded, 1)])


def values_sql(name: str, sql: str) -> str:
    keys, day, values = SHAPE[name]
    padded = [*values, *["null"] * (4 - len(values))]
    key = " || '|' || ".join(f"cast({k} as varchar)" for k in keys) or "''"
    return (f"select '{name}' as \"table\", {key} as key, cast({day or 'null'} as date) as day, "
            + ", ".join(f"cast({v} as double) as v{i}" for i, v in enumerate(padded, 1)) + f" from ({sql})")

"""Table contracts.

Every source is read with an explicit schema (never inferred) and every
table is conformed to one of these before it is written. ``required``
columns are the non-null ones of the contract; parquet does not enforce
them, so ``operators.conform`` checks them.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, DT, TS, I, L = (T.StringType(), T.DoubleType(), T.DateType(),
                      T.TimestampNTZType(), T.IntegerType(), T.LongType())


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- raw inputs -----------------------------------------------------------

# One observation as the API returns it (long / entity-attribute-value).
# ``date`` stays a string here: it is ``yyyy-MM-dd'T'HH:mm:ss`` on the wire.
RAW_OBSERVATION = _schema(
    ("station", S, True), ("date", S, True), ("datatype", S, True),
    ("attributes", S, True), ("value", D, True),
)

# A page envelope: declared total plus the page's results.
RESULTSET = _schema(("offset", L, True), ("count", L, True), ("limit", L, True))
PAGE_ENVELOPE = _schema(
    ("metadata", _schema(("resultset", RESULTSET, True)), True),
    ("results", T.ArrayType(RAW_OBSERVATION), True),
)

# Station record after enrichment, before typing (dates still strings,
# numbers possibly unparsed text when they come from loose JSON).
STATION_RECORD = _schema(
    ("id", S, True), ("name", S, True), ("latitude", S, True),
    ("longitude", S, True), ("elevation", S, True), ("elevation_unit", S, True),
    ("state", S, True), ("datacoverage", S, True), ("mindate", S, True),
    ("maxdate", S, True),
)

# Snapshot rows carry the run date and the region folder they live in.
STATION_SNAPSHOT = T.StructType(
    STATION_RECORD.fields + [T.StructField("snapshot_date", DT, False),
                             T.StructField("region", S, False)])

MANIFEST = _schema(
    ("last_updated", DT, False), ("total_stations", I, False),
    ("regions", T.ArrayType(S, False), False), ("files", T.ArrayType(S, False), False),
)

PERIOD = _schema(("start", DT, False), ("end", DT, False))

# --- curated tables -------------------------------------------------------

TRANSFORMED_RESULTS = _schema(
    ("id", S, False), ("station", S, False), ("date", DT, False),
    ("tmax", D, True), ("tmin", D, True), ("tavg", D, True), ("prcp", D, True),
)

TRANSFORMED_STATIONS = _schema(
    ("id", S, False), ("name", S, False), ("latitude", D, False),
    ("longitude", D, False), ("elevation", D, False), ("elevation_unit", S, False),
    ("state", S, False), ("datacoverage", D, False), ("mindate", DT, False),
    ("maxdate", DT, False),
)

# Station rows that were refused, as they came, and why.
REJECTED_STATIONS = T.StructType(
    [T.StructField("id", S, False)] + STATION_RECORD.fields[1:]
    + [T.StructField("reason", S, False)])

# Measures of a daily row, and what the month cube keeps of them by station and month.
MEASURES = ("tmax", "tmin", "tavg", "prcp")
MONTH_CUBE = _schema(
    ("station", S, False), ("days", L, False),
    *[(f"{m}_{x}", L if x == "n" else D, x != "n") for m in MEASURES for x in ("n", "sum", "min", "max")],
    ("wet", I, True), ("year", I, False), ("month", I, False),
)

# --- presentation tables (public names, misspellings kept) ----------------

PRESENTATION = {
    "monthly_avg_temp": _schema(
        ("state", S, False), ("month", TS, False), ("avg_temp", D, False)),
    "station_summary": _schema(
        ("station_id", S, False), ("state", S, False),
        ("total_measurements", I, False), ("avg_temp", D, False)),
    "total_stations_by_state": _schema(
        ("state", S, False), ("total_stations", I, False)),
    "total_measurements_by_station": _schema(
        ("station_id", S, False), ("total_measurements", I, False)),
    "precipitation_by_state_by_year": _schema(
        ("state", S, False), ("year", TS, False), ("total_precipitation", D, False)),
    "central_tendence_tmin_tmax_by_month": _schema(
        ("month", TS, False), ("avg_tmin", D, False), ("avg_tmax", D, False)),
    "extreme_temperature_by_state": _schema(
        ("state", S, False), ("max_temp", D, False), ("min_temp", D, False)),
    "avg_temp_by_season": _schema(("season", S, False), ("avg_temp", D, False)),
    "preciptation_by_season": _schema(
        ("season", S, False), ("total_precipitation", D, False)),
    "precipitation_anomaly_by_state_by_year": _schema(
        ("state", S, False), ("year", TS, False), ("total_precipitation", D, False),
        ("historical_avg_precipitation", D, False), ("anomaly_mm", D, False),
        ("anomaly_pct", D, False)),
    "rainy_days_by_state_by_year": _schema(
        ("state", S, False), ("year", TS, False), ("rainy_days", I, False)),
}

# Table layout: partition columns per curated table.
PARTITIONING = {
    "transformed_results": ["year", "month"],
    "transformed_stations": ["state"],
    "month_cube": ["year", "month"],
}

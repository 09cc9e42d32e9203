"""The eleven presentation views.

Each view is a function ``(results, stations) -> DataFrame`` over the
curated tables ``transformed_results`` (R) and ``transformed_stations``
(S). Views that need the station's state use ``join_observations_stations``
(RS); observations of unknown stations drop out there, while the
per-station, per-month and per-season views read R alone and keep them.

The only job that runs while a view is built is the size check of the
dimension; a caller with several views checks it once and passes
``checked=True``. Output is ordered as published; a sink, whose files
promise no order, passes ``ordered=False``.

Every aggregate is algebraic (sum / count / min / max / avg, or a
distinct count planned as a two-level aggregate), so Spark aggregates
partially before each shuffle and a hot state or station never lands in
one task as raw rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as PF
from ..operators.joins import join_annual_to_history, join_observations_stations


def _rs(results: DataFrame, stations: DataFrame, checked: bool) -> DataFrame:
    return join_observations_stations(results, stations, checked=checked)


def _sorted(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    return df.orderBy(*keys) if ordered else df


def monthly_avg_temp(results: DataFrame, stations: DataFrame, ordered: bool = True,
                     checked: bool = False) -> DataFrame:
    made = (_rs(results, stations, checked).groupBy("state", PF.month_start("date").alias("month"))
            .agg(PF.zero_if_null(F.avg("tavg")).alias("avg_temp")))
    return _sorted(made, ordered, "state", "month")


def station_summary(results: DataFrame, stations: DataFrame, ordered: bool = True,
                    checked: bool = False) -> DataFrame:
    made = (_rs(results, stations, checked).groupBy(F.col("station").alias("station_id"), "state")
            .agg(F.count(F.lit(1)).cast("int").alias("total_measurements"),
                 PF.zero_if_null(F.avg("tavg")).alias("avg_temp")))
    return _sorted(made, ordered, F.desc("total_measurements"), "station_id")


def total_stations_by_state(results: DataFrame, stations: DataFrame, ordered: bool = True,
                            checked: bool = False) -> DataFrame:
    made = stations.groupBy("state").agg(F.count(F.lit(1)).cast("int").alias("total_stations"))
    return _sorted(made, ordered, F.desc("total_stations"), "state")


def total_measurements_by_station(results: DataFrame, stations: DataFrame, ordered: bool = True,
                                  checked: bool = False) -> DataFrame:
    made = (results.groupBy(F.col("station").alias("station_id"))
            .agg(F.count(F.lit(1)).cast("int").alias("total_measurements")))
    return _sorted(made, ordered, F.desc("total_measurements"), "station_id")


def precipitation_by_state_by_year(results: DataFrame, stations: DataFrame, ordered: bool = True,
                                   checked: bool = False) -> DataFrame:
    made = (_rs(results, stations, checked).groupBy("state", PF.year_start("date").alias("year"))
            .agg(PF.zero_if_null(F.sum("prcp")).alias("total_precipitation")))
    return _sorted(made, ordered, "state", "year")


def central_tendence_tmin_tmax_by_month(results: DataFrame, stations: DataFrame, ordered: bool = True,
                                        checked: bool = False) -> DataFrame:
    made = (results.groupBy(PF.month_start("date").alias("month"))
            .agg(PF.zero_if_null(F.avg("tmin")).alias("avg_tmin"),
                 PF.zero_if_null(F.avg("tmax")).alias("avg_tmax")))
    return _sorted(made, ordered, "month")


def extreme_temperature_by_state(results: DataFrame, stations: DataFrame, ordered: bool = True,
                                 checked: bool = False) -> DataFrame:
    made = (_rs(results, stations, checked).groupBy("state")
            .agg(PF.zero_if_null(F.max("tmax")).alias("max_temp"),
                 PF.zero_if_null(F.min("tmin")).alias("min_temp")))
    return _sorted(made, ordered, "state")


def avg_temp_by_season(results: DataFrame, stations: DataFrame, ordered: bool = True,
                       checked: bool = False) -> DataFrame:
    made = (results.groupBy(PF.season("date").alias("season"))
            .agg(PF.zero_if_null(F.avg("tavg")).alias("avg_temp")))
    return _sorted(made, ordered, PF.season_rank("season"))


def preciptation_by_season(results: DataFrame, stations: DataFrame, ordered: bool = True,
                           checked: bool = False) -> DataFrame:
    made = (results.groupBy(PF.season("date").alias("season"))
            .agg(PF.zero_if_null(F.sum("prcp")).alias("total_precipitation")))
    return _sorted(made, ordered, PF.season_rank("season"))


def precipitation_anomaly_by_state_by_year(results: DataFrame, stations: DataFrame, ordered: bool = True,
                                           checked: bool = False) -> DataFrame:
    """Yearly total per state, the state's mean of yearly totals, and the
    difference in mm and percent.

    Each output column is coalesced on its own: a year whose total is NULL
    shows total 0 and anomaly 0 (not minus the mean); the mean skips NULL
    years; a zero mean gives a 0 percentage (NULLIF, no ANSI /0 error).
    """
    annual = (_rs(results, stations, checked).groupBy("state", PF.year_start("date").alias("year"))
              .agg(F.sum("prcp").alias("total_precipitation")))
    return _sorted(anomaly_columns(join_annual_to_history(annual)), ordered, "state", "year")


def anomaly_columns(hist: DataFrame) -> DataFrame:
    """The published columns of a table of yearly totals with the state's mean."""
    total, mean = F.col("total_precipitation"), F.col("historical_avg_precipitation")
    diff = total - mean
    return hist.select(
        "state", "year",
        PF.zero_if_null(total).alias("total_precipitation"),
        PF.zero_if_null(mean).alias("historical_avg_precipitation"),
        PF.zero_if_null(diff).alias("anomaly_mm"),
        PF.zero_if_null(PF.safe_ratio(diff, mean) * 100).alias("anomaly_pct"))


def rainy_days_by_state_by_year(results: DataFrame, stations: DataFrame, ordered: bool = True,
                                checked: bool = False) -> DataFrame:
    """Distinct dates with ``prcp > 0`` at any station of the state.

    The filter is applied before the join so it reaches the parquet scan.
    """
    made = (_rs(results.where(F.col("prcp") > 0), stations, checked)
            .groupBy("state", PF.year_start("date").alias("year"))
            .agg(F.count_distinct("date").cast("int").alias("rainy_days")))
    return _sorted(made, ordered, "state", "year")


VIEWS: dict[str, Callable[..., DataFrame]] = {
    "monthly_avg_temp": monthly_avg_temp,
    "station_summary": station_summary,
    "total_stations_by_state": total_stations_by_state,
    "total_measurements_by_station": total_measurements_by_station,
    "precipitation_by_state_by_year": precipitation_by_state_by_year,
    "central_tendence_tmin_tmax_by_month": central_tendence_tmin_tmax_by_month,
    "extreme_temperature_by_state": extreme_temperature_by_state,
    "avg_temp_by_season": avg_temp_by_season,
    "preciptation_by_season": preciptation_by_season,
    "precipitation_anomaly_by_state_by_year": precipitation_anomaly_by_state_by_year,
    "rainy_days_by_state_by_year": rainy_days_by_state_by_year,
}

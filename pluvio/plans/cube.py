"""The month cube: one mergeable row per station and month, and the views rolled up from it.

One pass over the daily rows gives, for every station and month, the number
of rows, and count, sum, least and greatest value of each measure, and the
wet days as bits (bit 0 is the first of the month). All of these merge: counts
and sums add up, extremes and bits combine. So every presentation table is
a roll-up of the cube, months can be replaced one by one, and the distinct
rainy days of a state are the bits of its stations put together: exact,
without shuffling a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as PF
from ..operators.joins import bounded_broadcast, join_annual_to_history
from ..schemas import MEASURES
from . import views
from .views import _sorted


def wet_day(date: str = "date", prcp: str = "prcp") -> Column:
    """The bit of a rainy day in its month; NULL for a day without rain."""
    return F.when(F.col(prcp) > 0, F.call_function("shiftleft", F.lit(1), F.dayofmonth(date) - 1))


def month_cube(results: DataFrame) -> DataFrame:
    """Daily rows -> (station, year, month) with mergeable aggregates: one
    scan and one shuffle of at most a row per station, month and task."""
    per_measure = [made for m in MEASURES for made in (
        F.count(m).alias(f"{m}_n"), F.sum(m).alias(f"{m}_sum"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"))]
    return (results.groupBy("station", F.year("date").alias("year"), F.month("date").alias("month"))
            .agg(F.count(F.lit(1)).alias("days"), *per_measure, F.bit_or(wet_day()).alias("wet"))
            .select("station", "days", *[f"{m}_{x}" for m in MEASURES for x in ("n", "sum", "min", "max")], "wet",
                    "year", "month"))


def rainy_days_by_bitmap(results: DataFrame, stations: DataFrame, ordered: bool = True,
                         checked: bool = False) -> DataFrame:
    """F11 from the daily rows: 31 bits a state and month instead of distinct dates."""
    rs = views._rs(results.where(F.col("prcp") > 0), stations, checked)
    months = rs.groupBy("state", F.trunc("date", "MM").alias("month")).agg(F.bit_or(wet_day()).alias("wet"))
    return _sorted(_days_of(months, PF.year_start("month")), ordered, "state", "year")


def _days_of(months: DataFrame, year: Column) -> DataFrame:
    return months.groupBy("state", year.alias("year")).agg(
        F.sum(F.bit_count("wet")).cast("int").alias("rainy_days"))


# --- roll-ups: (cube, stations) -> the rows of the view of that name ---------------

def _rs(cube: DataFrame, stations: DataFrame, checked: bool) -> DataFrame:
    """The cube with the state of each station; months of unknown stations drop out."""
    dim = stations.select(F.col("id").alias("_sid"), "state")
    return cube.join(dim if checked else bounded_broadcast(dim), F.col("station") == F.col("_sid")).drop("_sid")


def _mean(measure: str) -> Column:
    """COALESCE(AVG, 0) of a measure; without values the sum is NULL."""
    return PF.zero_if_null(F.sum(f"{measure}_sum") / F.nullif(F.sum(f"{measure}_n"), F.lit(0)))


def _first_day(month: bool) -> Column:
    return F.make_date("year", F.col("month") if month else F.lit(1), F.lit(1)).cast("timestamp_ntz")


def _count(c: str) -> Column:
    return F.sum(c).cast("int")


def monthly_avg_temp(cube, stations, ordered=True, checked=False):
    made = _rs(cube, stations, checked).groupBy("state", _first_day(True).alias("month")).agg(
        _mean("tavg").alias("avg_temp"))
    return _sorted(made, ordered, "state", "month")


def station_summary(cube, stations, ordered=True, checked=False):
    made = _rs(cube, stations, checked).groupBy(F.col("station").alias("station_id"), "state").agg(
        _count("days").alias("total_measurements"), _mean("tavg").alias("avg_temp"))
    return _sorted(made, ordered, F.desc("total_measurements"), "station_id")


def total_measurements_by_station(cube, stations, ordered=True, checked=False):
    made = cube.groupBy(F.col("station").alias("station_id")).agg(_count("days").alias("total_measurements"))
    return _sorted(made, ordered, F.desc("total_measurements"), "station_id")


def _annual(cube, stations, checked):
    return _rs(cube, stations, checked).groupBy("state", _first_day(False).alias("year")).agg(
        F.sum("prcp_sum").alias("total_precipitation"))


def precipitation_by_state_by_year(cube, stations, ordered=True, checked=False):
    made = _annual(cube, stations, checked).withColumn(
        "total_precipitation", PF.zero_if_null(F.col("total_precipitation")))
    return _sorted(made, ordered, "state", "year")


def central_tendence_tmin_tmax_by_month(cube, stations, ordered=True, checked=False):
    made = cube.groupBy(_first_day(True).alias("month")).agg(
        _mean("tmin").alias("avg_tmin"), _mean("tmax").alias("avg_tmax"))
    return _sorted(made, ordered, "month")


def extreme_temperature_by_state(cube, stations, ordered=True, checked=False):
    made = _rs(cube, stations, checked).groupBy("state").agg(
        PF.zero_if_null(F.max("tmax_max")).alias("max_temp"), PF.zero_if_null(F.min("tmin_min")).alias("min_temp"))
    return _sorted(made, ordered, "state")


def _by_season(cube):
    return cube.groupBy(PF.season(_first_day(True)).alias("season"))


def avg_temp_by_season(cube, stations, ordered=True, checked=False):
    return _sorted(_by_season(cube).agg(_mean("tavg").alias("avg_temp")), ordered, PF.season_rank("season"))


def preciptation_by_season(cube, stations, ordered=True, checked=False):
    made = _by_season(cube).agg(PF.zero_if_null(F.sum("prcp_sum")).alias("total_precipitation"))
    return _sorted(made, ordered, PF.season_rank("season"))


def precipitation_anomaly_by_state_by_year(cube, stations, ordered=True, checked=False):
    hist = join_annual_to_history(_annual(cube, stations, checked))
    return _sorted(views.anomaly_columns(hist), ordered, "state", "year")


def rainy_days_by_state_by_year(cube, stations, ordered=True, checked=False):
    wet = _rs(cube.where("wet is not null"), stations, checked)
    months = wet.groupBy("state", "year", "month").agg(F.bit_or("wet").alias("wet"))
    return _sorted(_days_of(months, _first_day(False)), ordered, "state", "year")


VIEWS = {name: globals().get(name, views.VIEWS[name]) for name in views.VIEWS}

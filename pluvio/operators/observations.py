"""Observation operators: typing, keys, filters and the daily pivot."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as PF
from ..functions.constants import DATATYPES
from .sizing import dealt


def typed_observations(raw: DataFrame) -> DataFrame:
    """Cast station/date/value; rows that do not parse are flagged, not raised.

    ``date`` may be ``yyyy-MM-dd`` or an ISO timestamp; both cast to a date.
    Returns the typed rows with a boolean ``_valid`` column, so callers
    choose between filtering and rejecting (see ``split_valid``).
    """
    return raw.select(
        F.col("station").cast("string").alias("station"),
        F.col("date").try_cast("timestamp_ntz").cast("date").alias("date"),
        F.col("datatype").cast("string").alias("datatype"),
        F.col("value").try_cast("double").alias("value"),
        F.col("date").alias("_raw_date"),
    ).withColumn("_valid", F.col("station").isNotNull() & F.col("date").isNotNull())


def split_valid(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with a reason)."""
    good = typed.where("_valid").drop("_valid", "_raw_date")
    bad = typed.where(~F.col("_valid")).select(
        "station", F.col("_raw_date").alias("date"), "datatype", "value",
        F.when(F.col("station").isNull(), "missing station")
         .otherwise("unparseable date").alias("reason"))
    return good, bad


def observed_span(raw: DataFrame) -> DataFrame:
    """First and last day of the rows that type (one row). Least and greatest
    pass over dates that do not parse, so each is parsed once, without a
    filter that parses it too."""
    day = F.col("date").try_cast("timestamp_ntz").cast("date")
    return raw.where(F.col("station").isNotNull()).agg(F.min(day).alias("first"), F.max(day).alias("last"))


def observation_key(df: DataFrame, station: str = "station", date: str = "date") -> DataFrame:
    """Add the row key ``id`` (station without prefix + ``_`` + yyyyMMdd)."""
    return df.withColumn("id", PF.observation_id(station, date))


def observation_day_parts(df: DataFrame, date: str = "date") -> DataFrame:
    """Add landing-path parts year / month / day (zero-padded strings)."""
    d = F.col(date).try_cast("timestamp_ntz").cast("date")
    parts = PF.day_parts(d)
    return df.withColumns(parts)


def rainy_filter(results: DataFrame) -> DataFrame:
    """Station-days with precipitation above zero."""
    return results.where(F.col("prcp") > 0)


def datatype_filter(df: DataFrame, datatypes) -> DataFrame:
    return df.where(F.col("datatype").isin(list(datatypes)))


def period_filter(df: DataFrame, start, end, date: str = "date") -> DataFrame:
    """Both ends inclusive. ``start``/``end`` are dates or ISO strings."""
    s = _as_date(start)
    e = _as_date(end)
    return df.where(F.col(date).between(F.lit(s), F.lit(e)))


def _as_date(v):
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v)[:10])


def pivot_daily(observations: DataFrame, rows: int | None = None) -> DataFrame:
    """Long observations -> one wide row per (station, day).

    Duplicate values of a (station, day, datatype) collapse with MAX; an
    absent datatype gives NULL; a station-day with only other datatypes
    still yields an all-NULL row. One conditional aggregate per column keeps
    this to a single shuffle on (station, date) with map-side partial
    aggregation (``groupBy().pivot()`` would plan a second pass), and
    partial aggregation also absorbs hot stations.

    A task's groups grow with the input where the number of tasks does not.
    With ``rows``, which the observations have at most, there are as many
    tasks as they need; where that is more than the deployment's number, the
    rows are dealt by (station, day) before they are grouped, still in one
    shuffle.

    Grouping is by the cast day, so ``id`` stays unique even if times differ.
    A row without a station or a date that parses has no key and gives no
    row (``split_valid`` returns such rows); a value that is no number
    counts as absent.
    """
    typed, _ = split_valid(typed_observations(observations))
    if rows is not None:
        typed = dealt(typed, rows, "station", "date")
    aggs = [F.max(F.when(F.col("datatype") == t, F.col("value"))).alias(t.lower())
            for t in DATATYPES]
    wide = typed.groupBy("station", "date").agg(*aggs)
    return wide.select(PF.observation_id("station", "date").alias("id"),
                       "station", "date", *[t.lower() for t in DATATYPES])


def append_observations(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)

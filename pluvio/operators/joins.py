"""Join operators.

Broadcasting is decided by a proven bound, never by a guess: a side is
broadcast only after ``rows_at_most`` has shown it holds at most
``max_rows`` rows. The check is a Spark job of its own, so a caller that
joins one side several times checks it once and passes ``checked=True``.
Beyond the bound the join is left to the planner, which shuffles both sides
on the key (AQE may still switch strategy from runtime sizes and splits
skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import STATE_CODES

# Largest dimension we are willing to copy to every executor. A station
# row is ~100 bytes, so this bounds a broadcast to tens of MB.
DEFAULT_BROADCAST_ROWS = 500_000


def rows_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    At most ``max_rows + 1`` rows of each task's output are looked at. What
    lies below the limit (a distinct, an aggregate) still runs, so give it a
    side that is stored or cheap to derive.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if its size is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if rows_at_most(df, max_rows) else df


def join_observations_stations(results: DataFrame, stations: DataFrame,
                               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                               checked: bool = False) -> DataFrame:
    """Fact to dimension on ``results.station = stations.id`` (inner).

    Observations of stations missing from the dimension drop out. Only the
    dimension's ``id`` and ``state`` are carried; column pruning reaches the
    scan. With the dimension broadcast, the fact side is not shuffled at
    all, so a station holding a third of the rows costs nothing extra.
    """
    dim = stations.select(F.col("id").alias("_sid"), "state")
    if not checked:
        dim = bounded_broadcast(dim, max_broadcast_rows)
    return results.join(dim, results["station"] == dim["_sid"], "inner").drop("_sid")


def join_annual_to_history(annual: DataFrame, key: str = "state",
                           value: str = "total_precipitation",
                           out: str = "historical_avg_precipitation") -> DataFrame:
    """Attach the per-key mean of ``value`` to every row of ``annual``.

    Same rows as joining ``annual`` to its own grouped mean on ``key``
    (for non-null keys), but as a window: one exchange, no self join.
    The window input is already aggregated (keys x years), so its size does
    not grow with the observations.
    """
    return annual.withColumn(out, F.avg(value).over(Window.partitionBy(key)))


def new_station_ids(observations: DataFrame, existing: DataFrame,
                    station: str = "station",
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Distinct non-empty station ids seen in ``observations`` that are not
    in ``existing.id`` (set difference)."""
    seen = distinct_station_ids(observations, station)
    known = bounded_broadcast(existing.select("id").distinct(), max_broadcast_rows)
    return seen.join(known, "id", "left_anti")


def distinct_station_ids(observations: DataFrame, station: str = "station") -> DataFrame:
    """Unique, non-null, non-empty ids (partial aggregation before the shuffle)."""
    return (observations.select(F.col(station).alias("id"))
            .where(F.col("id").isNotNull() & (F.col("id") != ""))
            .distinct())


def state_codes(spark: SparkSession) -> DataFrame:
    """(state_name, code): the 27 states that the published tables know."""
    return spark.createDataFrame(STATE_CODES, "state_name string, code string")


def lookup_state_code(df: DataFrame, codes: DataFrame | None = None, name_col: str = "state_name",
                      out: str = "state") -> DataFrame:
    """State name -> code via a left join on a small code table (by default
    the 27 known states); unknown names give NULL."""
    if codes is None:
        codes = state_codes(df.sparkSession)
    c = bounded_broadcast(codes.select(F.col("state_name").alias("_sn"),
                                       F.col("code").alias(out)), 100_000)
    return df.join(c, df[name_col] == c["_sn"], "left").drop("_sn")


def assign_state(df: DataFrame, cells: DataFrame, resolution: float = 1.0,
                 lat: str = "latitude", lon: str = "longitude",
                 out: str = "state_name") -> DataFrame:
    """Coordinate -> region name by an equi join on its grid cell.

    The cell is ``floor(lat / resolution), floor(lon / resolution)``. A
    point without a cell gets NULL. Cells are deduplicated by key (the
    smallest name wins), so a point never becomes two rows. The cell table
    is broadcast up to the size of the grid or of any other dimension,
    whichever is smaller.
    """
    max_cells = min(int((180 / resolution + 1) * (360 / resolution + 1)), DEFAULT_BROADCAST_ROWS)
    res = F.lit(float(resolution))
    keyed = df.withColumns({
        "_clat": F.floor(F.col(lat) / res).cast("int"),
        "_clon": F.floor(F.col(lon) / res).cast("int"),
    })
    c = bounded_broadcast(cells.groupBy(F.col("cell_lat").alias("_clat"), F.col("cell_lon").alias("_clon"))
                          .agg(F.min("state_name").alias(out)), max_cells)
    return keyed.join(c, ["_clat", "_clon"], "left").drop("_clat", "_clon")


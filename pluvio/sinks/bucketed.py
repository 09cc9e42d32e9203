"""Facts and dimension bucketed by station: their join shuffles neither.

For a dimension beyond the broadcast bound. Both tables are written once
into the same number of buckets of the station id, sorted in each, so that
every later join reads bucket against bucket. A fact table has one row a
station and day, so no station outgrows its bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import join_observations_stations

BUCKETS = 64


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int = BUCKETS) -> str:
    """Write ``df`` as the catalog table ``table`` at ``path``, bucketed and
    sorted by ``key``; returns its name. Dealing the rows to the buckets first
    gives one file a bucket."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return table


def join_bucketed(spark: SparkSession, results: str, stations: str) -> DataFrame:
    """``join_observations_stations`` of two tables that are bucketed alike."""
    return join_observations_stations(spark.table(results), spark.table(stations), max_broadcast_rows=0)

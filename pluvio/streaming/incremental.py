"""Incremental loading of newly landed observation days.

The batch job re-runs a period; this runs the same transform only for the
days that received new files since the last run. A file stream over the
landing zone (``trigger(availableNow=True)``, checkpointed in the shared
folder) reports which day folders got files, by their paths and without
opening them; for each micro-batch, ``foreachBatch`` re-reads those whole days
from the landing zone with a partition-pruned batch scan, pivots them and
upserts the result. Reading
the whole day (not just the new files) keeps the day-level rule: a day is
never upserted from a partial set of its datatypes, and a day holding an
unreadable file is skipped whole.

The stream's checkpoint makes a re-run pick up only unseen files; a
micro-batch that fails is replayed, and the upsert is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.observations import pivot_daily
from ..sinks import tables
from ..sources.observations import DAY_KEYS, PIVOTED, tolerant_scan
from ..staging import scratch, stage

# A row per file (its content is never asked for) plus the folder keys, which Spark fills from the path.
_STREAM_SCHEMA = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
     T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
     T.StructField("datatype", T.StringType()), *(T.StructField(k, T.IntegerType()) for k in DAY_KEYS)])


def load_days(spark: SparkSession, raw_root: str, results_path: str, days: DataFrame) -> dict:
    """Re-read, pivot and upsert the given days (columns year, month, day).

    One scan over the span of the days keeps these days only.
    """
    keys = [F.col(k).cast("int").alias(k) for k in DAY_KEYS]
    with scratch(spark):
        days, _path = stage(days.select(*keys).distinct(), spark, "touched-days")
        bounds = days.select(F.make_date("year", "month", "day").alias("d")) \
            .agg(F.min("d").alias("s"), F.max("d").alias("e")).first()
        if bounds["s"] is None:
            return {"written": False, "rows": 0}
        rows, _bad = tolerant_scan(spark, raw_root, bounds["s"], bounds["e"], days=days, columns=PIVOTED)
        return tables.upsert_observations(pivot_daily(rows, rows.count()), results_path)


def start_incremental_load(spark: SparkSession, raw_root: str, results_path: str,
                           checkpoint: str, max_files_per_trigger: int = 10_000):
    """Start the availableNow stream; returns the ``StreamingQuery``.

    ``checkpoint`` is a folder of the deployment that outlives the session:
    it holds which files were seen. Call ``.awaitTermination()`` on the query
    to process everything landed so far.
    """
    tables.ensure_table(spark, results_path, "transformed_results")
    stream = (spark.readStream.schema(_STREAM_SCHEMA).format("binaryFile")
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .load(raw_root))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select(*DAY_KEYS).distinct()
        load_days(batch.sparkSession, raw_root, results_path, touched)

    return (stream.select(*DAY_KEYS).writeStream
            .foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def run_incremental_load(spark: SparkSession, raw_root: str, results_path: str, checkpoint: str) -> None:
    """Process every landed file not seen before, then stop."""
    q = start_incremental_load(spark, raw_root, results_path, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))

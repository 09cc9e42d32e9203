"""Landing raw data: observations by day, station snapshots, manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as PF
from ..operators.joins import bounded_broadcast
from ..operators.sizing import spread
from ..operators.stations import RECORD_COLUMNS, manifest_summary, region_of
from ..schemas import MANIFEST, RAW_OBSERVATION, STATION_SNAPSHOT
from . import files

OBS_PARTITIONS = ("datatype", "year", "month", "day")
SNAPSHOT_PARTITIONS = ("snapshot_date", "region")
RAW_COLUMNS = tuple(RAW_OBSERVATION.fieldNames())


def rejected_root(root: str) -> str:
    """Where observations that have no day are kept, beside the landing zone."""
    return root.rstrip("/") + "-rejected"


def land_observations(observations: DataFrame, root: str, max_records_per_file: int = 1_000_000,
                      rows: int | None = None) -> dict:
    """Write raw observations as JSON lines under
    ``datatype=/year=/month=/day=`` (month and day zero-padded), every raw
    field included.

    A rerun replaces exactly the (datatype, day) folders it writes and
    leaves every other day alone (dynamic partition overwrite). A row whose
    date does not parse has no day folder: it goes to ``rejected_root(root)``
    with a reason. Returns the rows landed and rejected.

    Rows are range-partitioned by datatype and day first: each task then
    writes a contiguous run of folders, and the sampled range bounds split a
    day that holds a large share of the rows over several tasks instead of
    sending it to one. The sample is a pass of its own over the batch, so the
    folder names are made from the day after it. ``maxRecordsPerFile`` bounds file size. The number of
    tasks follows ``rows``, which the batch has at most (counted if not given),
    as each task sorts its rows by folder.
    """
    day = F.col("date").try_cast("timestamp_ntz").cast("date")
    raw = observations.select(*[F.col(c) if c in observations.columns else F.lit(None).cast("string").alias(c)
                                for c in RAW_COLUMNS])
    counts = Observation("landing")
    rows = observations.count() if rows is None else rows
    dated = F.col("_day").isNotNull()
    counted = spread(raw.withColumn("_day", day), rows, "datatype", "_day", "station").observe(
        counts, F.count_if(dated).alias("landed"), F.count_if(~dated).alias("rejected"))
    (counted.where(dated).withColumns(PF.day_parts("_day")).drop("_day")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*OBS_PARTITIONS).json(root))
    found = {k: int(v) for k, v in counts.get.items()}
    if found["rejected"]:  # a second pass only where there is something to reject
        (raw.where(day.isNull()).withColumn("reason", F.lit("unparseable date"))
         .write.mode("append").json(rejected_root(root)))
    return found


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Rejected observations of a landing zone; empty if nothing was rejected."""
    schema = T.StructType([*RAW_OBSERVATION.fields, T.StructField("reason", T.StringType())])
    if not files.exists(spark, rejected_root(root)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(rejected_root(root))


# --- station snapshots ---------------------------------------------------------

def _fingerprints(df: DataFrame) -> DataFrame:
    """Per region: row count and two order-independent content hashes. Equal
    rows do not cancel in the sum."""
    content = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in RECORD_COLUMNS]
    return df.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*content).cast("decimal(20,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit("second"), *content)).alias("mix"))


def read_snapshot(spark: SparkSession, root: str, snapshot_date=None) -> DataFrame:
    """Snapshot rows, of one date if given (only its folders are read).
    Before the first snapshot there is no folder, and the result is empty."""
    if not files.exists(spark, root):
        return spark.createDataFrame([], STATION_SNAPSHOT)
    rows = spark.read.schema(STATION_SNAPSHOT).json(root)
    return rows if snapshot_date is None else rows.where(
        F.col("snapshot_date") == F.lit(snapshot_date).cast("date"))


def write_station_snapshot(stations: DataFrame, root: str, snapshot_date) -> DataFrame:
    """Full station snapshot of ``snapshot_date``, one folder per region.

    A region whose content equals what is already stored for the same
    snapshot date is not rewritten; content is compared by row count and two
    hashes per region (partial aggregates). Returns the regions written, as
    rows: ``state`` is free text, so their number has no bound.
    """
    spark = stations.sparkSession
    snap = (stations.select(*[F.col(c).cast("string").alias(c) for c in RECORD_COLUMNS])
            .withColumn("region", region_of("state")))
    stored = read_snapshot(spark, root, snapshot_date)
    new, old = _fingerprints(snap), _fingerprints(stored.select(*RECORD_COLUMNS, "region"))
    # kept from here on: the folders that it is compared with are about to change
    changed = new.join(old, ["region", "n", "total", "mix"], "left_anti").select("region").checkpoint()
    if not changed.isEmpty():
        (snap.join(changed, "region", "left_semi")
         .withColumn("snapshot_date", F.lit(snapshot_date).cast("date"))
         .repartitionByRange("region", "id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*SNAPSHOT_PARTITIONS).json(root))
    return changed


def snapshot_files(spark: SparkSession, root: str, snapshot_date) -> DataFrame:
    """(region, file): the distinct data files of one snapshot date."""
    return (read_snapshot(spark, root, snapshot_date)
            .select("region", F.col("_metadata.file_path").alias("file")).distinct())


def write_manifest(spark: SparkSession, snapshot_root: str, manifest_path: str,
                   snapshot_date, stations: DataFrame) -> DataFrame:
    """Persist the manifest of the current snapshot and return it re-read.

    ``stations`` is the full current station set (what the snapshot holds);
    regions are those present now, so a region emptied by a same-day rerun
    stays on disk but is no longer listed.
    """
    current = stations.select(region_of("state").alias("region")).distinct()
    listed = snapshot_files(spark, snapshot_root, snapshot_date).join(current, "region", "left_semi")
    summary = manifest_summary(stations, snapshot_date, listed.select("file"))
    summary.coalesce(1).write.mode("overwrite").json(manifest_path)
    return read_manifest(spark, manifest_path)


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """The manifest (one row); no row before the first snapshot."""
    if not files.exists(spark, manifest_path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(manifest_path)


def scan_station_snapshot(spark: SparkSession, snapshot_root: str, manifest_path: str) -> DataFrame:
    """Stations of the snapshot the manifest points to (date and regions).

    The manifest's date is read first (one row), so older snapshots are
    pruned by folder. No manifest means an empty result with the schema.
    """
    manifest = read_manifest(spark, manifest_path)
    last = manifest.select("last_updated").first()
    if last is None:
        return spark.createDataFrame([], STATION_SNAPSHOT)
    regions = bounded_broadcast(manifest.select(F.explode("regions").alias("region")))
    return read_snapshot(spark, snapshot_root, last["last_updated"]).join(regions, "region", "left_semi").select(
        *STATION_SNAPSHOT.fieldNames())

"""Compaction of landed days: whole months as parquet beside the raw day files.

Landing writes one small JSON file per datatype and day. A month that is
complete can be compacted: its rows go to parquet under (datatype, year,
month), and its raw day folders are deleted once that is written. Both zones
are then read as one. A day that is landed again is a raw day, and a raw day
wins over its compacted copy (anti join by day), so reruns and corrections
keep working, and a run that died before it deleted raw folders is harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import bounded_broadcast
from ..operators.sizing import spread
from ..schemas import RAW_OBSERVATION
from ..sources.observations import DAY_KEYS, OBSERVED, _limited, tolerant_scan
from ..staging import scratch, stage
from . import files

MONTH_FOLDERS = ("datatype", "year", "month")
DAY_FOLDERS = (*MONTH_FOLDERS, "day")
_FIELDS = [T.StructField(f.name, f.dataType) for f in RAW_OBSERVATION.fields]
SCHEMA = T.StructType([*_FIELDS, *(T.StructField(k, T.IntegerType()) for k in DAY_KEYS)])


def _zone(spark: SparkSession, root: str, kind: str, start=None, end=None, datatypes=None) -> DataFrame:
    """One zone, pruned by folder; empty if nothing was written there yet."""
    if not files.exists(spark, root) or not files.folders(spark, root):
        return spark.createDataFrame([], SCHEMA)
    reader = spark.read.schema(SCHEMA)
    rows = reader.option("mode", "FAILFAST").json(root) if kind == "json" else reader.parquet(root)
    return _limited(rows, start, end, datatypes).select(*OBSERVED, *DAY_KEYS)


def scan_landed(spark: SparkSession, raw_root: str, compact_root: str, start=None, end=None, datatypes=None) -> DataFrame:
    """Raw observations of both zones, as ``scan_observations`` gives them.

    Of a (datatype, day) that is in both, the raw rows count. The raw days
    are few after a compaction; they are broadcast if proven so.
    """
    raw = _zone(spark, raw_root, "json", start, end, datatypes)
    compact = _zone(spark, compact_root, "parquet", start, end, datatypes)
    days = bounded_broadcast(raw.select(*DAY_FOLDERS).distinct(), 1_000_000)
    return raw.unionByName(compact.join(days, list(DAY_FOLDERS), "left_anti").select(*raw.columns))


def compact_months(spark: SparkSession, raw_root: str, compact_root: str, start, end) -> dict:
    """Compact the landed days of [start, end]; returns months and rows written.

    Months that are compacted already are merged with the days that were
    landed since. A month with an unusable record (see ``tolerant_scan``)
    stays raw. Every step can be run again.
    """
    if not files.exists(spark, raw_root) or not files.folders(spark, raw_root):
        return {"months": 0, "rows": 0}
    with scratch(spark):
        rows, bad_days = tolerant_scan(spark, raw_root, start, end)
        bad = bounded_broadcast(bad_days.select("year", "month").distinct(), 100_000)
        good = rows.join(bad, ["year", "month"], "left_anti").select(*rows.columns)
        days, _ = stage(good.groupBy(*DAY_FOLDERS).agg(F.count(F.lit(1)).alias("rows")), spark, "compact-days")
        months = days.select(*MONTH_FOLDERS).distinct()
        stored = _zone(spark, compact_root, "parquet", start, end).join(
            bounded_broadcast(months, 100_000), list(MONTH_FOLDERS), "left_semi").select(*rows.columns)
        # what stays of the folders that are about to be written; the rest is staged already
        kept, _ = stage(stored.join(days.select(*DAY_FOLDERS), list(DAY_FOLDERS), "left_anti").select(*rows.columns),
                        spark, "compact-kept")
        total = (days.agg(F.sum("rows")).first()[0] or 0) + kept.count()
        merged = spread(good.unionByName(kept), total, *MONTH_FOLDERS, "station")
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*MONTH_FOLDERS).parquet(compact_root))
        found = days.groupBy(*MONTH_FOLDERS).agg(F.collect_list("day").alias("days")).collect()
        for m in found:  # a row a month folder; only days that are now in parquet go
            folder = f"{raw_root}/datatype={m['datatype']}/year={m['year']}/month={m['month']:02d}"
            for day in m["days"]:
                files.delete(spark, f"{folder}/day={day:02d}")
        return {"months": len(found), "rows": total}

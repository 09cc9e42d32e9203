"""Scans of landed raw observations and of landed API page envelopes.

Layout: ``<root>/datatype=<T>/year=<YYYY>/month=<MM>/day=<DD>/*.json``.
The scan reads the root once and filters on the partition columns, so a
period and a datatype list become ``PartitionFilters`` (only the matching
folders are listed and opened) instead of a loop over day paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as PF
from ..functions.constants import PAGE_LIMIT
from ..operators.joins import bounded_broadcast
from ..operators.periods import _lit_date
from ..schemas import PAGE_ENVELOPE, RAW_OBSERVATION
from ..staging import stage

CORRUPT = "_corrupt_record"
DAY_KEYS = ("year", "month", "day")
OBSERVED = ("station", "date", "datatype", "attributes", "value")
PIVOTED = ("station", "date", "datatype", "value")  # what the daily pivot uses of them


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _reader(spark: SparkSession, schema: T.StructType, multiline: bool, mode: str = "PERMISSIVE"):
    return (spark.read.schema(schema).option("multiLine", multiline).option("mode", mode)
            .option("columnNameOfCorruptRecord", CORRUPT))


def _limited(df: DataFrame, start, end, datatypes) -> DataFrame:
    if start is not None and end is not None:
        df = df.where(PF.make_day(*DAY_KEYS).between(_lit_date(start), _lit_date(end)))
    return df if datatypes is None else df.where(F.col("datatype").isin(list(datatypes)))


def scan_observations(spark: SparkSession, root: str, start=None, end=None,
                      datatypes=None, multiline: bool = False) -> DataFrame:
    """Raw observations of every datatype (or ``datatypes``) landed for the
    days in ``[start, end]``: the raw fields, then year, month, day. A root
    that does not exist is an error (Spark's), and so is a corrupt record;
    ``tolerant_scan`` skips the days of such records instead."""
    df = _reader(spark, RAW_OBSERVATION, multiline, "FAILFAST").json(root)
    return _limited(df, start, end, datatypes).select(*OBSERVED, *DAY_KEYS)


def scan_observations_by_type(spark: SparkSession, root: str, start, end, datatypes,
                              multiline: bool = False) -> DataFrame:
    """Scan limited to a period and a datatype list (both pruned by folder)."""
    return scan_observations(spark, root, start, end, datatypes, multiline)


def tolerant_scan(spark: SparkSession, root: str, start=None, end=None, datatypes=None,
                  multiline: bool = False, days: DataFrame | None = None,
                  columns=OBSERVED) -> tuple[DataFrame, DataFrame]:
    """Scan that skips whole days holding an unusable record.

    Returns ``(rows, bad_days)``. A day with any unusable record (a bad
    line, a whole unreadable multi-line file, or a record without a station
    or a date that parses) is dropped for every datatype, so the later
    upsert never overwrites a stored good value with a partial day.

    ``days`` (year, month, day) limits the scan to these days inside the
    period, and ``columns`` the raw fields given back (a record is checked whole
    whatever they are). The raw files are read once: the flagged rows are staged as
    parquet in the shared folder (a job does this inside ``scratch``), and the
    bad days, at most one row per day of the period, are found there by their flag
    and staged too.
    """
    # the folder columns are named, as a root whose days are all compacted has no folder to find them in
    schema = T.StructType([*RAW_OBSERVATION.fields, *(T.StructField(k, T.IntegerType()) for k in DAY_KEYS)])
    df = _limited(_reader(spark, _with_corrupt(schema), multiline).json(root), start, end, datatypes)
    keys = [F.col(k).cast("int").alias(k) for k in DAY_KEYS]
    dated = F.col("date").try_cast("timestamp_ntz").isNotNull()
    usable = F.col(CORRUPT).isNull() & F.col("station").isNotNull() & dated
    flagged = df.select(*columns, *keys, usable.alias("usable"))
    if days is not None:
        wanted = days.select(*keys).distinct()
        flagged = flagged.join(bounded_broadcast(wanted, 1_000_000), list(DAY_KEYS), "left_semi").select(
            *flagged.columns)
    staged, _path = stage(flagged, spark, "raw-days")
    # read again by every reader of the rows
    bad_days, _path = stage(staged.where(~F.col("usable")).select(*DAY_KEYS).distinct(), spark, "bad-days")
    good = staged.where("usable").join(bounded_broadcast(bad_days, 1_000_000), list(DAY_KEYS), "left_anti")
    return good.select(*columns, *DAY_KEYS), bad_days


# --- page envelopes ---------------------------------------------------------

def read_pages(spark: SparkSession, root: str, multiline: bool = False) -> DataFrame:
    """Landed page envelopes; request keys come from the folder names. A page
    that does not parse is a row with its text in ``_corrupt_record``."""
    return _reader(spark, _with_corrupt(PAGE_ENVELOPE), multiline).json(root)


def explode_pages(pages: DataFrame, keep=()) -> DataFrame:
    """Flatten envelopes to observation rows; a page without ``results``
    contributes nothing (``page_completeness`` reports it)."""
    keep = list(keep)
    return (pages.select(*keep, F.explode("results").alias("r"))
            .select(*keep, "r.station", "r.date", "r.datatype", "r.attributes", "r.value"))


def distinct_pages(pages: DataFrame, keys) -> DataFrame:
    """One page per request and offset, so that a page that was landed twice
    counts once: the one with most results. Unreadable pages drop out."""
    best = F.max(F.struct(F.coalesce(F.size("results"), F.lit(0)).alias("size"), "results", "metadata"))
    return (pages.where(F.col("metadata.resultset.offset").isNotNull())
            .groupBy(*keys, F.col("metadata.resultset.offset").alias("offset")).agg(best.alias("page"))
            .select(*keys, "offset", "page.results", "page.metadata"))


def page_completeness(pages: DataFrame, keys=("datatype", "start", "end"), limit: int = PAGE_LIMIT) -> DataFrame:
    """Per request: the declared total against the rows and pages landed.

    A page that was landed twice counts once. ``complete`` is false when an
    expected offset is missing, rows are missing, or a page is unreadable
    (the reference stops paging on a failed page and keeps the partial
    result silently).
    """
    keys = list(keys)
    set_ = F.col("metadata.resultset")
    got = F.greatest(F.coalesce(F.size("results"), F.lit(0)), F.lit(0))
    unreadable = F.col(CORRUPT).isNotNull() if CORRUPT in pages.columns else F.lit(False)
    offset = F.when(~unreadable, F.coalesce(set_["offset"], F.lit(1)))
    per_page = pages.groupBy(*keys, offset.alias("offset")).agg(
        F.max(set_["count"]).alias("declared"), F.max(set_["limit"]).alias("limit"),
        F.max(got).alias("rows"), F.count_if(unreadable).alias("unreadable"))
    steps = F.coalesce("limit", F.lit(limit))
    expected = F.col("offset").isNotNull() & ((F.col("offset") - 1) % steps == 0)
    per_request = per_page.groupBy(*keys).agg(
        F.coalesce(F.max("declared"), F.lit(0)).alias("declared"),
        F.coalesce(F.sum(F.when(F.col("offset").isNotNull(), F.col("rows"))), F.lit(0)).alias("received"),
        F.count_if(expected & (F.col("rows") > 0)).alias("pages"),
        F.ceil(F.coalesce(F.max("declared"), F.lit(0)) / F.coalesce(F.max("limit"), F.lit(limit))).alias("expected_pages"),
        F.sum("unreadable").alias("unreadable"))
    return per_request.withColumn(
        "complete", (F.col("unreadable") == 0) & (F.col("received") >= F.col("declared"))
        & (F.col("pages") >= F.col("expected_pages")))

"""Helpers shared by the operators: staging, ranking, column bookkeeping."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pluvio
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.staging import stage

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared work folder and read it back.

    The written files cut the lineage: a lost executor costs a reread, and
    what reads the result sees one fixed set of rows. Inside ``scratch`` the
    copy is deleted at the end of the block.
    """
    return stage(df, df.sparkSession, f"llm-{label}")[0]


_SHIPPED: set[str] = set()  # application ids whose executors have the package


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that
    their Python workers can import it wherever the driver runs."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(pluvio.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="pluvio-package-"), "pluvio.zip")
    with zipfile.ZipFile(archive, "w") as made:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    made.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table, in a session whose Python workers know this package."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df: DataFrame, made: list[str]) -> list[Column]:
    """The columns of ``df`` whose names an operator does not produce itself
    (names are compared as Spark compares them, without case)."""
    taken = {name.lower() for name in made}
    return [df[f"`{c}`"] for c in df.columns if c.lower() not in taken]


def free_prefix(df: DataFrame, wanted: str) -> str:
    """``wanted``, with as many underscores before it as make it begin no column of ``df``."""
    while any(c.lower().startswith(wanted.lower()) for c in df.columns):
        wanted = "_" + wanted
    return wanted


def global_rank(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Add ``name``: the row's position (from 0) in the total order.

    The rows are sorted by range and numbered inside each part. Only the
    count of each part meets in one place, so no task sees all rows.
    """
    part, row = f"{name}_part", f"{name}_row"
    sorted_parts = staged(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(part, F.spark_partition_id())
        .withColumn(row, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "rank")
    counts = sorted_parts.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return (sorted_parts.join(starts, part)
            .withColumn(name, F.col("start") + F.col(row)).drop(part, row, "start"))

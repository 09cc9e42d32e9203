"""Table layer over parquet folders: create, overwrite, keyed upserts.

New content is always staged first: merged with what stays, checked against
the contract, and only then written over the table from the staged copy. A
check that fails, or a run that dies before, leaves the table as it was. The
observation table and the month cube are replaced by (year, month) folder,
the other tables whole.

A write from the staged copy that fails raises ``ReplaceFailed`` and leaves
that copy, which ``restore_table`` writes again. A run that died in between is
repaired like this or by running its load again: upserts are idempotent, and
a landed month or snapshot holds all rows of its folders. Readers hold no
state and repair nothing; they should not run while a table is replaced.

Staged copies are deleted when they are no longer needed. A table must have
been created (``ensure_table``): a mistyped path is an error, not an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import ContractError, conform_schema
from ..operators.joins import bounded_broadcast
from ..operators.sizing import dealt, spread
from ..schemas import (MONTH_CUBE, PARTITIONING, PRESENTATION, REJECTED_STATIONS, TRANSFORMED_RESULTS,
                       TRANSFORMED_STATIONS)
from ..staging import keep, stage
from . import files

CURATED = {
    "transformed_results": TRANSFORMED_RESULTS,
    "transformed_stations": TRANSFORMED_STATIONS,
}
UNPUBLISHED = {"rejected_stations": REJECTED_STATIONS, "month_cube": MONTH_CUBE}
MONTH_KEYS = ("year", "month")


class MissingTable(FileNotFoundError):
    """The table was never created at this path."""


class ReplaceFailed(RuntimeError):
    """A table was not written completely; its new content is staged."""

    def __init__(self, path: str, staged: str) -> None:
        super().__init__(f"{path} was not replaced completely: restore_table it from {staged}")
        self.path, self.staged = path, staged


def table_names() -> list[str]:
    """The thirteen published tables."""
    return list(CURATED) + [f"presentation_{v}" for v in PRESENTATION]


def table_schema(name: str) -> T.StructType:
    if name in CURATED or name in UNPUBLISHED:
        return (CURATED | UNPUBLISHED)[name]
    return PRESENTATION[name.removeprefix("presentation_")]


def _stored_schema(name: str) -> T.StructType:
    """The contract and the folder columns that are derived from it."""
    schema = table_schema(name)
    return T.StructType(schema.fields + [T.StructField(p, T.IntegerType()) for p in PARTITIONING.get(name, [])
                                         if p not in schema.fieldNames()])


def _with_partition_columns(df: DataFrame, name: str) -> DataFrame:
    if name == "transformed_results":
        return df.withColumns({"year": F.year("date"), "month": F.month("date")})
    return df


# --- replacing ------------------------------------------------------------------

def _spread(df: DataFrame, partition_by: list[str], rows: int) -> DataFrame:
    """Range-partition on the folder columns and a tie-breaker: each task
    writes a run of folders and sorts a bounded number of rows, and a folder
    with a large share of the rows is split over several tasks."""
    if not partition_by:
        return df
    tie = [c for c in df.columns if c not in partition_by][:1]
    return spread(df, rows, *partition_by, *tie)


def _write(df: DataFrame, path: str, name: str, by_folder: bool = False) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if by_folder else "static")
    if PARTITIONING.get(name):
        writer = writer.partitionBy(*PARTITIONING[name])
    writer.parquet(path)


def _replace(df: DataFrame, path: str, name: str, by_folder: bool = False) -> None:
    """Stage ``df``, then write the table (or, ``by_folder``, the folders that
    ``df`` has) from that copy."""
    copy, staged = stage(df, df.sparkSession, f"{name}-next")
    _replace_staged(copy, staged, copy.count(), path, name, by_folder)


def _replace_staged(copy: DataFrame, staged: str, rows: int, path: str, name: str, by_folder: bool) -> None:
    """Write the table from a staged copy in the order of its folders."""
    try:
        _write(_spread(copy, PARTITIONING.get(name, []), rows), path, name, by_folder)
    except Exception as error:
        keep(staged)
        raise ReplaceFailed(path, staged) from error
    files.delete(copy.sparkSession, staged)


def restore_table(spark: SparkSession, path: str, name: str, staged: str) -> None:
    """Write what a failed replacement left staged."""
    schema = _stored_schema(name)
    _write(spark.read.schema(schema).parquet(staged), path, name, by_folder=tuple(PARTITIONING.get(name, ())) == MONTH_KEYS)
    files.delete(spark, staged)


# --- contract checks ----------------------------------------------------------

def _observed(df: DataFrame, schema: T.StructType, label: str) -> tuple[DataFrame, Observation]:
    """``df`` and what is counted in the job that writes it: rows, NULLs of
    required columns, empty strings in folder columns (they have no folder)."""
    counts = Observation(f"contract-{label}")
    required = [F.count_if(F.col(f.name).isNull()).alias(f.name) for f in schema.fields if not f.nullable]
    empty = [F.count_if(F.col(p) == "").alias(f"empty {p}") for p in PARTITIONING.get(label, [])
             if p in schema.fieldNames() and schema[p].dataType == T.StringType()]
    return df.observe(counts, F.count(F.lit(1)).alias("_rows"), *required, *empty), counts


def _verified(counts: Observation, label: str) -> int:
    found = counts.get
    bad = {k: v for k, v in found.items() if k != "_rows" and v}
    if bad:
        raise ContractError(f"NULL or empty values in required columns of {label}: {bad}")
    return int(found.get("_rows", 0))


def _unique(df: DataFrame, key: str, label: str, rows: int) -> None:
    """An upsert replaces rows by key, so a batch holds each key once. Keys
    are shuffled as hashes; those that share one are compared themselves."""
    hashed = df.select(key, F.xxhash64(key).alias("_hash"))
    shared = dealt(hashed.select("_hash"), rows, "_hash").groupBy("_hash").count().where("count > 1").select("_hash")
    if shared.agg(F.min("_hash")).first()[0] is None:  # all tasks at once; a limit would try a few at a time
        return
    again = hashed.join(shared, "_hash", "left_semi").groupBy(key).count().where("count > 1")
    found = [r[0] for r in again.select(key).limit(5).collect()]
    if found:
        raise ContractError(f"repeated {key} in {label}: {found}")


def _staged_batch(df: DataFrame, name: str, key: str | None = "id") -> tuple[DataFrame, str, int]:
    """A batch, staged once and checked against its contract and for repeated keys."""
    spark = df.sparkSession
    checked, counts = _observed(df, table_schema(name), name)
    batch, path = stage(checked, spark, f"{name}-batch")
    try:
        rows = _verified(counts, name)
        if key:
            _unique(batch, key, name, rows)
    except ContractError:
        files.delete(spark, path)
        raise
    return batch, path, rows


# --- tables -------------------------------------------------------------------

def ensure_table(spark: SparkSession, path: str, name: str) -> bool:
    """Create an empty table if there is none. True when it was created."""
    if files.exists(spark, path):
        return False
    _write(spark.createDataFrame([], _stored_schema(name)), path, name)
    return True


def ensure_tables(spark: SparkSession, root: str, names=None) -> dict[str, bool]:
    """Create the curated and presentation tables under ``root`` if absent."""
    return {n: ensure_table(spark, f"{root.rstrip('/')}/{n}", n) for n in names or table_names()}


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table with its contract schema, then the folder columns derived from
    it. Raises ``MissingTable`` if it was never created."""
    if not files.exists(spark, path):
        raise MissingTable(f"no table at {path}: create it with ensure_table")
    return spark.read.schema(_stored_schema(name)).parquet(path)


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether the last write over the whole table came to its end, by the
    marker that Spark leaves then (unless that is turned off); writes by
    folder do not touch it."""
    return files.exists(spark, _marker(path))


def _marker(path: str) -> str:
    return f"{path.rstrip('/')}/_SUCCESS"


def overwrite_view(df: DataFrame, path: str, view: str) -> int:
    """Replace a presentation table with ``df`` conformed to its contract;
    returns the rows written. A failing check leaves the published table."""
    name = f"presentation_{view.removeprefix('presentation_')}"
    spark = df.sparkSession
    made, staged, rows = _staged_batch(conform_schema(df, table_schema(name)), name, key=None)
    try:
        _write(made, path, name)
    except Exception as error:
        keep(staged)
        raise ReplaceFailed(path, staged) from error
    files.delete(spark, staged)
    return rows


# --- observations and the cube: replaced by month -------------------------------------

def months_between(first: tuple[int, int], last: tuple[int, int]):
    """Folders from one (year, month) to another, as literals that prune the scan."""
    y, m = F.col("year"), F.col("month")
    return (y.between(first[0], last[0]) & ((y > first[0]) | (m >= first[1]))
            & ((y < last[0]) | (m <= last[1])))


def touched_months(existing: DataFrame, batch: DataFrame) -> DataFrame | None:
    """The stored rows of the months that ``batch`` touches: first the span
    from its first to its last month by literal, so that only these folders
    are listed and read, then the months themselves by semi join. None for
    an empty batch."""
    months = batch.select(*MONTH_KEYS).distinct()
    span = months.agg(F.min(F.struct(*MONTH_KEYS)).alias("first"), F.max(F.struct(*MONTH_KEYS)).alias("last")).first()
    if span["first"] is None:
        return None
    inside = existing.where(months_between(tuple(span["first"]), tuple(span["last"])))
    return inside.join(bounded_broadcast(months, 100_000), list(MONTH_KEYS), "left_semi")


def upsert_observations(new: DataFrame, path: str) -> dict:
    """Full-row upsert of daily rows by ``id`` into ``transformed_results``.

    Only the (year, month) folders that the batch touches are read and
    rewritten (``id`` embeds the date, so a key never moves). Within them,
    stored rows whose id is in the batch are replaced whole, NULLs included.
    An empty batch writes nothing; a batch with a repeated id is refused.
    """
    spark, name = new.sparkSession, "transformed_results"
    existing = read_table(spark, path, name)
    batch, batch_path, rows = _staged_batch(_with_partition_columns(conform_schema(new, TRANSFORMED_RESULTS), name),
                                            name)
    if rows:
        cols = _stored_schema(name).fieldNames()
        stored = touched_months(existing, batch)
        if stored.isEmpty():  # nothing to merge with: the staged batch is what its months will hold
            _replace_staged(batch.select(*cols), batch_path, rows, path, name, by_folder=True)
        else:
            kept = stored.join(batch.select(*MONTH_KEYS, "id"), [*MONTH_KEYS, "id"], "left_anti")
            _replace(kept.select(*cols).unionByName(batch.select(*cols)), path, name, by_folder=True)
    files.delete(spark, batch_path)
    return {"written": bool(rows), "rows": rows}


def replace_months(cube: DataFrame, path: str, name: str = "month_cube", whole: bool = False) -> int:
    """Write the months of ``cube`` over those stored (or, ``whole``, over the
    table); returns the rows written. A whole write that fails leaves no empty
    table that could be taken for a made one."""
    spark = cube.sparkSession
    if not whole:
        ensure_table(spark, path, name)
    made, staged, rows = _staged_batch(conform_schema(cube, table_schema(name)), name, key=None)
    try:
        if whole:  # first: a run that dies while it deletes the old months leaves no marker
            files.delete(spark, _marker(path))
        if rows or whole:
            _write(made.repartition(*MONTH_KEYS), path, name, by_folder=not whole)
    except Exception as error:
        keep(staged)
        raise ReplaceFailed(path, staged) from error
    files.delete(spark, staged)
    return rows


# --- stations and rejects: replaced whole -------------------------------------------

def _upsert(new: DataFrame, path: str, name: str, without: DataFrame | None = None) -> dict:
    """Rows of ``new`` replace stored rows of the same id; ids of ``without`` go."""
    spark = new.sparkSession
    existing = read_table(spark, path, name)
    batch, batch_path, rows = _staged_batch(conform_schema(new, table_schema(name)), name)
    gone = batch.select("id") if without is None else batch.select("id").unionByName(without.select("id"))
    if rows or without is not None:
        kept = existing.join(gone.distinct(), "id", "left_anti")
        cols = table_schema(name).fieldNames()
        _replace(kept.select(*cols).unionByName(batch.select(*cols)), path, name)
    files.delete(spark, batch_path)
    return {"written": bool(rows), "rows": rows}


def upsert_stations(new: DataFrame, path: str) -> dict:
    """Full-row upsert of stations by ``id`` over the whole table.

    A station may change state, which is its folder, so the table is merged
    and written whole. An empty batch writes nothing; a repeated id, or an
    empty state, is refused.
    """
    return _upsert(new, path, "transformed_stations")


def upsert_rejects(new: DataFrame, path: str, resolved: DataFrame) -> dict:
    """Record rejected stations by ``id``; those of ``resolved`` leave the table."""
    return _upsert(new, path, "rejected_stations", resolved)

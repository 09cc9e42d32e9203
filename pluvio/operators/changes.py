"""The change feed between two station snapshots, and its application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stations import RECORD_COLUMNS, dedupe_last_wins

INSERT, UPDATE, DELETE = "insert", "update", "delete"
VALUES = tuple(c for c in RECORD_COLUMNS if c != "id")


def row_hash(columns=VALUES) -> Column:
    """SHA-256 of the values; NULL differs from any text."""
    shown = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns]
    sized = [F.concat(F.char_length(s).cast("string"), F.lit(":"), s) for s in shown]
    return F.sha2(F.concat(*sized), 256)


def _side(snapshot: DataFrame, name: str) -> DataFrame:
    rows = snapshot.select("id", *VALUES)
    one = dedupe_last_wins(rows, "id", ())
    return one.select(F.col("id").alias(f"{name}_id"), row_hash().alias(f"{name}_hash"),
                      F.struct(*VALUES).alias(name), F.lit(True).alias(f"{name}_there"))


def snapshot_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What turns ``old`` into ``new``: id, change (insert, update, delete),
    changed (names of the columns that differ), and the new values (NULL for
    a delete).

    A null-safe full outer join of the two by id compares their row hashes, so
    each side is read once and unchanged stations are dropped before their
    values are looked at. A NULL id is an id. Of rows that share an id, the
    greatest by its values stands for the station.
    """
    both = _side(old, "old").join(_side(new, "new"), F.col("old_id").eqNullSafe(F.col("new_id")), "full_outer")
    kind = (F.when(F.col("old_there").isNull(), INSERT).when(F.col("new_there").isNull(), DELETE)
            .when(F.col("old_hash") != F.col("new_hash"), UPDATE))
    differs = F.array_compact(F.array(*[
        F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.lit(c)) for c in VALUES]))
    changed = F.when(F.col("change") == UPDATE, differs).otherwise(F.array().cast("array<string>"))
    return both.withColumn("change", kind).where("change is not null").select(
        F.when(F.col("change") == DELETE, F.col("old_id")).otherwise(F.col("new_id")).alias("id"),
        "change", changed.alias("changed"), "new.*")


def apply_changes(old: DataFrame, changes: DataFrame) -> DataFrame:
    """The snapshot after the feed: ``apply_changes(old, snapshot_changes(old,
    new))`` has the stations of ``new``. Applying a feed twice changes nothing."""
    ids = changes.select(F.col("id").alias("_id"))
    kept = old.select("id", *VALUES).join(ids, F.col("id").eqNullSafe(F.col("_id")), "left_anti")
    return kept.unionByName(changes.where(F.col("change") != DELETE).select("id", *VALUES))

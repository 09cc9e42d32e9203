"""Staged copies: written once under the shared work folder, read back, deleted with their scope.

A copy cuts the lineage, so a lost executor costs a reread and what reads it
sees one fixed set of rows. Inside ``scratch`` every copy is remembered and
deleted when the block ends, however it ends; outside, it is the caller's.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from .session import work_path
from .sinks import files

_scope: ContextVar[list[str] | None] = ContextVar("staged_copies", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the copies that are staged inside the block. A path that is
    removed from the list that this gives stays."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield paths
    finally:
        _scope.reset(token)
        for path in paths:
            files.delete(spark, path)


def stage(df: DataFrame, spark: SparkSession, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a fresh folder under the shared work area; returns the
    re-read copy (with the schema of ``df``) and its path."""
    path = work_path(spark, "stage", label, unique=True)
    paths = _scope.get()
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def keep(path: str) -> None:
    """Leave a copy of the current scope to the caller."""
    paths = _scope.get()
    if paths and path in paths:
        paths.remove(path)

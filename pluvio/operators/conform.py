"""Schema conformance (cast to a table contract, check required columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """A batch violates its table contract (e.g. NULL in a required column)."""


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns, in order, cast to its types.

    Casts run under the session's ANSI setting, so an integer overflow
    (e.g. a count above int32) raises instead of wrapping. NULLs in
    required columns are counted when the frame is written (see
    ``sinks.tables``) or by ``contract_violations``; this stays lazy.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def contract_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column, violations): how many rows hold NULL in each required column.

    A single global aggregate (partial per task), so checking a large batch
    is one cheap pass.
    """
    required = [f.name for f in schema.fields if not f.nullable]
    counts = conform_schema(df, schema).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in required])).alias("v")).select("v.*")

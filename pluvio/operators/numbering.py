"""Row numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .joins import bounded_broadcast
from .sizing import spread

_PART_BITS = 33  # monotonically_increasing_id has the task above these bits, and the row of the task in them


def number_in_groups(df: DataFrame, keys, order, rows: int) -> DataFrame:
    """``df`` (of ``rows`` rows) with ``nth``, the number from 1 of a row in its
    group of ``keys`` by ``order``, and ``total``, the rows of its group.

    A window over the groups would sort a group in one task. Here the rows are
    sorted over all tasks and staged with their place (a job does this inside
    ``scratch``); a group is a run of rows in each of some tasks, and its rows
    before a run are the sizes of its runs before that one.
    """
    keys, order = list(keys), list(order)
    placed = spread(df, rows, *keys, *order).sortWithinPartitions(*keys, *order)
    staged, _path = stage(placed.withColumn("_at", F.monotonically_increasing_id()), df.sparkSession, "numbered")
    part = F.shiftright("_at", _PART_BITS)
    group = Window.partitionBy(*keys)
    before = F.sum("_rows").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = (staged.groupBy(*keys, part.alias("_part"))
            .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
            .select(*[F.col(k).alias(f"_{k}") for k in keys], "_part", "_first",
                    F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(group).alias("total")))
    same = part == F.col("_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return (staged.join(bounded_broadcast(runs), same)
            .withColumn("nth", F.col("_at") - F.col("_first") + F.col("_before") + 1)
            .select(*df.columns, "nth", "total"))

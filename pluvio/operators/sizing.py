"""How many tasks a shuffle gets: the deployment's number, or more where that would give a task too many rows.

The number of shuffle partitions is a setting, so at a fixed setting the rows
of a task grow with the input, and beyond its memory they spill. Adaptive
execution merges small partitions, but it does not part large ones of a
repartition or an aggregate. Where the rows are known before, or cheap to
count (a parquet scan counts them from its footers), the number of tasks
follows them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Rows of a few hundred bytes in memory: a task that sorts or groups so many
# holds about a hundred megabytes.
ROWS_PER_TASK = 500_000


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int | None = None) -> int | None:
    """Tasks for a shuffle of ``rows`` rows; None where the deployment's number is enough."""
    needed = -(-rows // (rows_per_task or ROWS_PER_TASK))
    return needed if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def spread(df: DataFrame, rows: int, *keys) -> DataFrame:
    """Range-partition on ``keys``, in tasks of a bounded number of rows."""
    tasks = tasks_for(df.sparkSession, rows)
    return df.repartitionByRange(*([tasks] if tasks else []), *keys)


def dealt(df: DataFrame, rows: int, *keys) -> DataFrame:
    """Hash-partition on ``keys`` for what groups by them, if the deployment's
    number of tasks is not enough; else ``df`` itself."""
    tasks = tasks_for(df.sparkSession, rows)
    return df.repartition(tasks, *keys) if tasks else df

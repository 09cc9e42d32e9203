"""Small file operations of the driver, in whatever store Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    _, fs, target = _fs(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making; nothing if it is not there."""
    _, fs, target = _fs(spark, path)
    fs.delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``."""
    _, fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())

"""Session helpers and the shared work folder.

Staged tables and checkpoints must live in storage every executor can
reach. On a cluster that folder is named by ``spark.checkpoint.dir``, and
without it a work path is refused. Only a local session (one machine, as in
tests) falls back to a fresh local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_LOCAL_ROOTS: dict[str, str] = {}  # application id -> folder of a local session


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "pluvio", extra: dict | None = None) -> SparkSession:
    """A session for this library: AQE on, UTC, UI off.

    The number of shuffle partitions is left to the deployment unless given.
    """
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_root(spark)
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder, the same in every session of one deployment."""
    context = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_KEY, None)
    if not configured and context.getCheckpointDir():
        # set by a call instead of the setting: the context adds a folder of its own to it
        configured = context.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]
    if not configured:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        root = _LOCAL_ROOTS.setdefault(context.applicationId, "")
        configured = _LOCAL_ROOTS[context.applicationId] = root or tempfile.mkdtemp(prefix="pluvio-work-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def work_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared work folder."""
    segs = [p.strip("/") for p in parts if p]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return work_root(spark).rstrip("/") + "/pluvio/" + "/".join(segs)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can inspect local test folders."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)

"""Session construction and shared-storage helpers.

Cluster jobs must keep every intermediate they write (checkpoints, scratch
snapshots, stream state) in the shared folder named by
``spark.checkpoint.dir``. Only a local session (tests, the bench) gets a
folder of its own, and only when nothing was configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session in this library assumes (see README "Session").
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "ledgerflow", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only for a
    local session where none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; cluster jobs need a shared folder for "
            "checkpoints and scratch tables")
    path = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def prepare(spark: SparkSession) -> None:
    """Settings every registered query relies on, applied to a session built
    elsewhere: UTC session time (event-time windows and date casts of
    zone-less timestamps) and a checkpoint folder."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerflow-scratch/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it is written, and not when
    the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def keep(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """``df`` written to the shared folder and read back, for frames that are
    read several times: nothing stays in executor memory or on local disks.

    With ``rows_per_file`` a later scan task has some thirty times as many
    rows at most, as Spark packs no more files into 128 MB (each counts 4 MB
    more than it has); else narrow rows make tasks of many millions."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

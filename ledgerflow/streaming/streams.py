"""Structured Streaming operators (ST-1..3).

All three read a folder of files as a stream and run with
``trigger(availableNow=True)``: each run processes what arrived since the
last one, then stops, which is how a scheduled batch job becomes resumable.
Progress and state live in the checkpoint folder (shared storage). The
built-in file sink commits each micro-batch through its own metadata log
(ST-1, ST-2), or a batch overwrites its own folder (ST-3), so a retried batch
never appends twice. A run takes at most
``max_files_per_trigger`` files per micro-batch, so a first run over a large
folder is many bounded batches. Streams with state keep it in RocksDB, not on
the executors' heaps.

Event time must be a zoned ``timestamp`` for watermarks; the fixtures store
``timestamp_ntz`` and are read in UTC.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import Rule


# Files of one micro-batch.
MAX_FILES = 1000
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files_per_trigger).load(path)


def _run(df: DataFrame, out: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> None:
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    q = (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


# --- ST-1 --------------------------------------------------------------------
def ingest(spark: SparkSession, src: str, out: str, checkpoint: str, schema: T.StructType,
           max_files_per_trigger: int = MAX_FILES) -> None:
    """Copy new files from ``src`` to ``out``; a rerun with nothing new adds
    nothing, a crash resumes from the last committed batch."""
    _run(file_stream(spark, src, schema, max_files_per_trigger=max_files_per_trigger), out, checkpoint)


# --- ST-2 --------------------------------------------------------------------
def dq_stream(spark: SparkSession, src: str, out: str, checkpoint: str, schema: T.StructType,
              ts: str, rules: Sequence[Rule], delay: str = "1 hour", window: str = "1 day",
              max_files_per_trigger: int = MAX_FILES) -> None:
    """Tumbling-window rule counts per event-time window. Append mode emits
    a window once the watermark (max event time - ``delay``) passes its end;
    rows older than the watermark are dropped as late."""
    s = file_stream(spark, src, schema, max_files_per_trigger=max_files_per_trigger)
    s = s.withColumn("_et", F.col(ts).cast("timestamp")).withWatermark("_et", delay)
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(r.fails).alias(f"{r.name}__{r.column}") for r in rules]
    g = s.groupBy(F.window("_et", window).alias("w")).agg(*aggs)
    g = g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                 *[c for c in g.columns if c != "w"])
    _run(g, out, checkpoint)


# --- ST-3 --------------------------------------------------------------------
def dedup_stream(spark: SparkSession, src: str, out: str, checkpoint: str, schema: T.StructType,
                 keys: Sequence[str], ts: str, delay: str = "1 day", remember: str | None = "365 days",
                 max_files_per_trigger: int = MAX_FILES) -> None:
    """Every event once, tagged ``on_time`` or ``late`` in column ``arrival``.

    A key stays in the state (RocksDB, keys only) until event time has moved
    ``remember`` past it, so a late row is told from a re-sent one by the
    state itself: nothing that arrived before is read again, and a file that
    lands at any moment is simply part of a later batch. ``late`` are events more than
    ``delay`` behind the newest event of the batches before. Events more than ``remember`` behind
    are dropped by the watermark (and counted in the stream's progress);
    with ``remember=None`` keys are kept for good and none is dropped.

    A micro-batch overwrites its own folder ``batch=<id>``, so a batch that
    is run again after a failure stores its rows once. The newest event time
    so far is kept in one row per batch beside the checkpoint.
    """
    s = file_stream(spark, src, schema, max_files_per_trigger=max_files_per_trigger)
    s = s.withColumn("_et", F.col(ts).cast("timestamp"))
    s = s.dropDuplicates(list(keys)) if remember is None else s.withWatermark("_et", remember).dropDuplicatesWithinWatermark(list(keys))
    clock = checkpoint.rstrip("/") + "-clock"

    def store(batch: DataFrame, number: int) -> None:
        of = batch.sparkSession
        before = None
        if number:
            before = of.read.schema("newest timestamp, batch long").parquet(clock).filter(F.col("batch") < number).agg(F.max("newest")).first()[0]
        late = F.lit(False) if before is None else F.coalesce(F.col("_et") < F.lit(before) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        batch = batch.withColumn("arrival", F.when(late, "late").otherwise("on_time"))
        rows = f"{out}/batch={number}"
        batch.write.mode("overwrite").parquet(rows)
        newest = of.read.parquet(rows).agg(F.max("_et").alias("newest")).select(F.greatest("newest", F.lit(before).cast("timestamp")).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{clock}/batch={number}")

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    q = s.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_deduped(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """What ``dedup_stream`` has stored: the event columns and ``arrival``."""
    stored = T.StructType([*schema.fields, T.StructField("arrival", T.StringType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(stored).parquet(out).drop("batch")

"""Idempotent sinks (SNK-1..4).

Plain Parquet has no transactions. What we guarantee instead:

* SNK-1 rewrites exactly the partitions present in the batch
  (``partitionOverwriteMode=dynamic``); reruns replace, never append.
* SNK-2 never overwrites anything: a snapshot is written aside and committed
  by renaming it to the next version number, which fails if that version
  exists; the loser of a race reads again and retries.
* SNK-3 evaluates the rules once into a column; good + bad = input.
* SNK-4 writes both sides in one job, partitioned by destination and batch,
  and counts rows in and out with ``DataFrame.observe`` in that same job.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import Rule, evaluate, failed_rules, gate, gate_passes


# --- SNK-1 -------------------------------------------------------------------
def write_partitions(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet") -> None:
    """Replace the partitions of ``keys`` present in ``df`` and no others.

    ``rebalance`` on the partition keys lets AQE split a hot partition value
    over several tasks and merge small ones, so one busy month does not
    become one task and many quiet months do not become many tiny files.
    """
    (df.hint("rebalance", *keys).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys).format(fmt).save(path))


# --- SNK-2 -------------------------------------------------------------------
def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """DD-2 / SNK-2 core: the row with the greatest ``order_by`` per key.

    One ``max`` over a struct of all other columns, ``order_by`` first: the
    remaining columns break ties, so the result is deterministic, and each
    row is carried once. A hot key is reduced map-side to one candidate per
    task before the shuffle (a ``row_number() = 1`` window would sort the
    whole key in one task). The struct has variable width, so Spark sorts
    rows by key within each task rather than hashing them.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in rest if c not in order_by])
    best = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def _jpath(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _jpath(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, table_path: str) -> int:
    """Number of the newest committed snapshot; 0 for a new table. Only a
    missing folder means "new": any other error propagates (treating it as
    empty would rebuild the table from the batch alone)."""
    fs = _fs(spark, table_path)
    if not fs.exists(_jpath(spark, table_path)):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(_jpath(spark, table_path))]
    return max([int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()], default=0)


def _snapshot(table_path: str, version: int) -> str:
    return f"{table_path.rstrip('/')}/v={version:012d}"


def current_snapshot(spark: SparkSession, table_path: str) -> str | None:
    """Path of the newest committed snapshot, or None for a new table."""
    v = current_version(spark, table_path)
    return _snapshot(table_path, v) if v else None


def read_current(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.parquet(current_snapshot(spark, table_path))


def _commit(spark: SparkSession, staged: str, final: str) -> bool:
    """Rename ``staged`` to ``final`` unless ``final`` exists; False if it does."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_jpath(spark, final).toUri(), spark._jsc.hadoopConfiguration()) \
        if _jpath(spark, final).toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(_jpath(spark, staged), _jpath(spark, final), options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def upsert(spark: SparkSession, table_path: str, batch: DataFrame, keys: Sequence[str],
           order_by: Sequence[str], deleted: str | None = None, retries: int = 20) -> str:
    """New snapshot = latest row per key of (current ∪ batch); returns its path.

    ``deleted`` names a boolean column of the batch: a key whose latest row
    has it true leaves the table (the column itself is not stored).

    Applying the same batch again gives the same rows. The snapshot of
    version n+1 is written aside, then renamed to ``v=<n+1>``, which fails if
    another writer committed that version meanwhile; then the newest snapshot
    is read again and the batch applied to it. Versions are numbers counted
    from the table itself, so no clock decides which snapshot is current. A
    crash before the rename leaves the previous snapshot current.
    """
    for _ in range(retries):
        version = current_version(spark, table_path)
        rows = batch
        if version:
            now = spark.read.parquet(_snapshot(table_path, version))
            rows = (now.withColumn(deleted, F.lit(False)) if deleted else now).unionByName(batch)
        best = latest_per_key(rows, keys, order_by)
        if deleted:
            best = best.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)
        staged = f"{table_path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
        best.write.mode("errorifexists").parquet(staged)
        final = _snapshot(table_path, version + 1)
        if _commit(spark, staged, final):
            return final
        _fs(spark, staged).delete(_jpath(spark, staged), True)
    raise RuntimeError(f"{table_path}: another writer won {retries} times in a row")


# --- SNK-3 -------------------------------------------------------------------
def split_dead_letter(df: DataFrame, rules: Sequence[Rule], batch_id: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad). Bad rows carry ``failed_rules`` and ``batch_id``. Both are
    filters over ``df`` (nothing is cached); to store both, ``audited_write``
    reads the input once."""
    tagged = df.withColumn("failed_rules", failed_rules(rules))
    good = tagged.filter(F.size("failed_rules") == 0).drop("failed_rules")
    bad = tagged.filter(F.size("failed_rules") > 0).withColumn("batch_id", F.lit(batch_id))
    return good, bad


# --- SNK-4 -------------------------------------------------------------------
AUDIT_SCHEMA = ("step string, batch_id string, rows_in bigint, rows_out bigint, rows_rejected bigint, "
                "started_at timestamp, ended_at timestamp, status string")


TARGET, DEAD_LETTER = "target", "dead_letter"


def audited_write(spark: SparkSession, step: str, batch_id: str, df: DataFrame, rules: Sequence[Rule],
                  path: str, audit_path: str) -> dict:
    """Write clean rows and dead letters of one batch, then append one audit
    row, which is also returned.

    One job writes ``path/dest=<target|dead_letter>/batch_id=<id>``; writing
    the batch again replaces its own partitions and no others. Rows in are
    counted where the input enters the job, rows out and rejected where they
    leave it, so a row lost in between shows as status ``mismatch``.
    """
    if not batch_id:
        raise ValueError("a batch needs an id")
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch_id)
    started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    came, left = (Observation(f"{step}_{x}_{uuid.uuid4().hex[:8]}") for x in ("in", "out"))
    status, rows = "failed", dict(rows_in=0, rows_out=0, rows_rejected=0)
    try:
        x = df.observe(came, F.count(F.lit(1)).alias("n")).withColumn("failed_rules", failed_rules(rules))
        x = x.withColumn("dest", F.when(F.size("failed_rules") == 0, TARGET).otherwise(DEAD_LETTER)) \
             .withColumn("batch_id", F.lit(batch_id))
        x = x.observe(left, F.count_if(F.col("dest") == TARGET).alias("good"), F.count_if(F.col("dest") == DEAD_LETTER).alias("bad"))
        (x.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dest", "batch_id").parquet(path))
        rows = dict(rows_in=int(came.get["n"]), rows_out=int(left.get["good"]), rows_rejected=int(left.get["bad"]))
        # A side without rows writes no partition: what an earlier run of the batch left there goes.
        for dest, n in ((TARGET, rows["rows_out"]), (DEAD_LETTER, rows["rows_rejected"])):
            old = f"{path.rstrip('/')}/dest={dest}/batch_id={escaped}"
            if not n:
                _fs(spark, old).delete(_jpath(spark, old), True)
        status = "ok" if rows["rows_in"] == rows["rows_out"] + rows["rows_rejected"] else "mismatch"
    finally:
        ended = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        row = dict(step=step, batch_id=batch_id, **rows, started_at=started, ended_at=ended, status=status)
        spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(audit_path)
    return row


def gated_write(spark: SparkSession, step: str, batch_id: str, df: DataFrame, rules: Sequence[Rule], limits,
                path: str, audit_path: str) -> dict:
    """``audited_write`` behind the gate: rules are counted in one aggregate
    first, and if any fails more often than ``limits`` allow, nothing is
    written but an audit row with status ``blocked``. The returned audit row
    has the ``decision`` too."""
    if gate_passes(gate(evaluate(df, rules, step), limits)):
        return audited_write(spark, step, batch_id, df, rules, path, audit_path) | {"decision": "pass"}
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = dict(step=step, batch_id=batch_id, rows_in=df.count(), rows_out=0, rows_rejected=0, started_at=now, ended_at=now, status="blocked")
    spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(audit_path)
    return row | {"decision": "block"}


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Both destinations of ``audited_write``, all batches. Folder names are
    read as the text they are, so batch ``007`` does not come back as 7."""
    names = ("dest", "batch_id")
    kept = [f for f in spark.read.parquet(path).schema.fields if f.name not in names]
    return spark.read.schema(T.StructType([*kept, *(T.StructField(n, T.StringType()) for n in names)])).parquet(path)


def read_written(spark: SparkSession, path: str, dest: str) -> DataFrame:
    """Rows of one destination of ``audited_write``, all batches, with
    ``batch_id`` as text; clean rows without the (empty) ``failed_rules``."""
    df = read_batches(spark, path).filter(F.col("dest") == dest).drop("dest")
    return df.drop("failed_rules") if dest == TARGET else df

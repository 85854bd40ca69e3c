"""ST-1..3 registered queries.

Each query plays a small arrival schedule derived from the events table
into an inbox folder, runs the stream with ``availableNow`` once per
arrival (and once more with nothing new), and returns the sink read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as dq
from ..session import scratch_path
from ..sources.tables import SCHEMAS, load
from ..streaming import streams as st
from .catalog import register

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events(spark, sf):
    return load(spark, sf, "events")


def _arrive(df, inbox):
    df.write.mode("append").parquet(inbox)


def _midpoint(e):
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()
    return lo + (hi - lo) / 2


@register("st1_incremental_ingest", f"SELECT {', '.join(EVENT_COLS)} FROM events")
def st1_incremental_ingest(spark, sf):
    """Two arrivals (before / after the midpoint of event time); a rerun
    between them finds nothing new and writes nothing."""
    e = _events(spark, sf)
    base = scratch_path(spark, "st1")
    inbox, out, ck = f"{base}/inbox", f"{base}/out", f"{base}/checkpoint"
    mid = _midpoint(e)
    _arrive(e.filter(F.col("ts") < F.lit(mid)), inbox)
    st.ingest(spark, inbox, out, ck, SCHEMAS["events"])
    st.ingest(spark, inbox, out, ck, SCHEMAS["events"])  # nothing new
    _arrive(e.filter(F.col("ts") >= F.lit(mid)), inbox)
    st.ingest(spark, inbox, out, ck, SCHEMAS["events"])
    return spark.read.parquet(out).select(*EVENT_COLS)


def stream_rules():
    return [dq.in_range("value", 0, 300), dq.check("no_error", F.col("event_type") != "error", "event_type")]


@register("st2_dq_stream", """
WITH d AS (
  SELECT CAST(ts AS DATE) AS day, CAST(COUNT(*) AS BIGINT) AS rows,
         CAST(count_if(value < 0 OR value > 300) AS BIGINT) AS in_range__value,
         CAST(count_if(event_type = 'error') AS BIGINT) AS no_error__event_type
  FROM events GROUP BY 1)
SELECT * FROM d WHERE d.day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def st2_dq_stream(spark, sf):
    """Daily rule counts with a 1-hour watermark. The last day stays open
    (its window has not passed the watermark) and the re-sent first-day
    rows arrive after the watermark, so they are dropped as late."""
    e = _events(spark, sf)
    base = scratch_path(spark, "st2")
    inbox, out, ck = f"{base}/inbox", f"{base}/out", f"{base}/checkpoint"
    _arrive(e, inbox)
    st.dq_stream(spark, inbox, out, ck, SCHEMAS["events"], "ts", stream_rules(), "1 hour", "1 day")
    first_day = e.agg(F.min(F.to_date("ts"))).first()[0]
    _arrive(e.filter(F.to_date("ts") == F.lit(first_day)), inbox)
    st.dq_stream(spark, inbox, out, ck, SCHEMAS["events"], "ts", stream_rules(), "1 hour", "1 day")
    r = spark.read.parquet(out)
    return r.select(F.to_date("window_start").alias("day"), F.col("rows").cast("bigint").alias("rows"),
                    F.col("in_range__value").cast("bigint").alias("in_range__value"),
                    F.col("no_error__event_type").cast("bigint").alias("no_error__event_type"))


# Events of the first two days that arrive only after all others.
_LATE_SQL = "event_id % 50 = 0 AND ts < (SELECT min(ts) + INTERVAL 2 DAY FROM events)"


@register("st3_dedup_stream", f"""
SELECT {', '.join(EVENT_COLS)}, CASE WHEN {_LATE_SQL} THEN 'late' ELSE 'on_time' END AS arrival FROM events
""")
def st3_dedup_stream(spark, sf):
    """Every event once, although the last day and the first day are
    re-sent: all copies meet the state. Old events that were never sent before are late."""
    e = _events(spark, sf)
    base = scratch_path(spark, "st3")
    inbox, out, ck = (f"{base}/{x}" for x in ("inbox", "out", "checkpoint"))
    lo, lo_day, hi_day = e.agg(F.min("ts"), F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    delayed = (F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit(lo) + F.expr("INTERVAL 2 DAYS"))
    _arrive(e.filter(~delayed), inbox)
    st.dedup_stream(spark, inbox, out, ck, SCHEMAS["events"], ["event_id"], "ts", "1 day")
    _arrive(e.filter(delayed | F.to_date("ts").isin(lo_day, hi_day)), inbox)
    st.dedup_stream(spark, inbox, out, ck, SCHEMAS["events"], ["event_id"], "ts", "1 day")
    st.dedup_stream(spark, inbox, out, ck, SCHEMAS["events"], ["event_id"], "ts", "1 day")  # nothing new
    return st.read_deduped(spark, out, SCHEMAS["events"]).select(*EVENT_COLS, "arrival")

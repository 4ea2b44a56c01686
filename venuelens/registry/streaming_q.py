"""Streaming jobs G1-G7: the driver table is staged as time-ordered files in a landing
folder, the stream runs with ``availableNow`` (one file per micro-batch, so state
carries across batches), and the result is read back and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import jobs as G
from . import register

N_SLICES = 4
_EVENT = ("user_id", "event_id", "ts", "event_type", "value", "props")


def _staged(t, name, df, ts, order=None):
    run = G.new_run(t.spark, name)
    G.stage_slices(df, ts, run["landing"], N_SLICES, order)
    src = G.file_stream(t.spark, run["landing"] + "/*", df.schema, "parquet", 1)
    return run, src


@register("stream_upsert", """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def _stream_upsert(t):
    ev = t.events
    run, src = _staged(t, "upsert", ev, "ts")
    G.stream_upsert(src, ["user_id"], ["ts", "event_id"], run["out"], run["checkpoint"])
    return G.latest_state(t.spark, run["out"], ["user_id"], ["ts", "event_id"]).select(*_EVENT)


@register("stream_upsert_out_of_order", """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def _stream_upsert_out_of_order(t):
    """The newest slice arrives before an older one."""
    run, src = _staged(t, "upsert_late", t.events, "ts", (0, 1, 3, 2))
    G.stream_upsert(src, ["user_id"], ["ts", "event_id"], run["out"], run["checkpoint"])
    return G.latest_state(t.spark, run["out"], ["user_id"], ["ts", "event_id"]).select(*_EVENT)


@register("stream_upsert_compacted", """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def _stream_upsert_compacted(t):
    """Slices out of order, folded into a snapshot between arrivals and again after them, merged folders removed."""
    run = G.new_run(t.spark, "upsert_compacted")
    key, order = ["user_id"], ["ts", "event_id"]
    for step, slices in enumerate(((3, 0), (1,), (2,))):
        G.stage_slices(t.events, "ts", run["landing"], N_SLICES, slices, first=(0, 2, 3)[step])
        src = G.file_stream(t.spark, run["landing"] + "/*", t.events.schema, "parquet", 1)
        G.stream_upsert(src, key, order, run["out"], run["checkpoint"])
        if step < 2:
            G.compact_state(t.spark, run["out"], key, f"{run['base']}/snapshot{step}", order)
            G.drop_merged(t.spark, run["out"])
    return G.latest_state(t.spark, run["out"], key, order).select(*_EVENT)


@register("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def _stream_dedupe(t):
    ev = t.events
    run, src = _staged(t, "dedupe", ev, "ts")
    G.stream_dedupe(src, ["user_id", "event_type"], "ts", "3650 days", run["out"], run["checkpoint"])
    return t.spark.read.parquet(run["out"]).select("user_id", "event_type")


@register("stream_level_counts", """
SELECT time_bucket(INTERVAL '6 hours', create_time) AS window_start,
       time_bucket(INTERVAL '6 hours', create_time) + INTERVAL '6 hours' AS window_end, level, count(*) AS count
FROM job_log GROUP BY 1, 2, 3""", ("job_log",))
def _stream_level_counts(t):
    log = t.job_log()
    run, src = _staged(t, "levels", log, "create_time")
    G.stream_level_counts(src, "create_time", "6 hours", None, "1 hour", run["out"], run["checkpoint"])
    return G.latest_state(t.spark, run["out"], ["window_start", "window_end", "level"]).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "level", "count")


@register("stream_sessions", """
WITH s AS (SELECT task_name, create_time AS ts, record_count,
                  CASE WHEN lag(create_time) OVER w IS NULL OR create_time >= lag(create_time) OVER w + INTERVAL '30 minutes'
                       THEN 1 ELSE 0 END AS new_s
           FROM job_log WINDOW w AS (PARTITION BY task_name ORDER BY create_time)),
g AS (SELECT *, sum(new_s) OVER (PARTITION BY task_name ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT * FROM (SELECT task_name, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end,
                      count(*) AS rows, CAST(sum(record_count) AS BIGINT) AS records FROM g GROUP BY task_name, sid)
WHERE session_end <= (SELECT max(create_time) FROM job_log) - INTERVAL '1 hour'""", ("job_log",))
def _stream_sessions(t):
    """Sessions closed by the final watermark (latest event time - 1 hour); open ones stay in state."""
    log = t.job_log()
    run, src = _staged(t, "sessions", log, "create_time")
    G.stream_sessions(src, "create_time", "30 minutes", "1 hour", run["out"], run["checkpoint"])
    return t.spark.read.parquet(run["out"]).select(
        "task_name", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"), "rows", "records")


@register("stream_progress")
def _stream_progress(t):
    """Per-task counters in streaming state; milestones every 100 rows.  ``rows_seen`` depends on
    micro-batch boundaries, so this full output is checked by rows only."""
    log = t.job_log()
    run, src = _staged(t, "progress", log, "create_time")
    G.stream_progress(src, run["out"], run["checkpoint"], 100)
    return t.spark.read.parquet(run["out"])


@register("stream_progress_milestones", """
SELECT task_name, unnest(range(100, n + 1, 100)) AS milestone
FROM (SELECT task_name, count(*) AS n FROM job_log GROUP BY task_name)""", ("job_log",))
def _stream_progress_milestones(t):
    """The milestones reached per task (independent of micro-batch boundaries)."""
    log = t.job_log()
    run, src = _staged(t, "progress_m", log, "create_time")
    G.stream_progress(src, run["out"], run["checkpoint"], 100)
    return t.spark.read.parquet(run["out"]).select("task_name", "milestone")


@register("stream_enrich", """
SELECT j.*, d.severity FROM job_log j LEFT JOIN (VALUES ('INFO', 0), ('WARNING', 1), ('ERROR', 2)) AS d(level, severity)
ON d.level = j.level""", ("job_log",))
def _stream_enrich(t):
    log = t.job_log()
    dim = t.spark.createDataFrame([("INFO", 0), ("WARNING", 1), ("ERROR", 2)], "level string, severity int")
    run, src = _staged(t, "enrich", log, "create_time")
    G.stream_enrich(src, dim, "level", run["out"], run["checkpoint"])
    return t.spark.read.parquet(run["out"])


_BOUNDS = """b AS (SELECT epoch(min(create_time)) AS lo, (epoch(max(create_time)) - epoch(min(create_time))) / 4 AS step
          FROM job_log),
s AS (SELECT j.*, CASE WHEN epoch(j.create_time) < b.lo + b.step THEN 0 WHEN epoch(j.create_time) < b.lo + 2 * b.step THEN 1
                       WHEN epoch(j.create_time) < b.lo + 3 * b.step THEN 2 ELSE 3 END AS slice
      FROM job_log j, b)"""


@register("stream_late_split", f"""
WITH {_BOUNDS}
SELECT id, task_name, stage, level, record_count, create_time,
       CASE WHEN slice = 2 AND create_time < (SELECT max(create_time) FROM s WHERE slice <> 2) - INTERVAL '1 hour'
            THEN 'late' ELSE 'main' END AS route
FROM s""", ("job_log",))
def _stream_late_split(t):
    """Slices arrive out of order (0, 1, 3, 2): when the third slice arrives last, rows older
    than the high-water mark of the earlier batches minus one hour go to the late table."""
    log = t.job_log()
    run, src = _staged(t, "late", log, "create_time", order=[0, 1, 3, 2])
    G.stream_late_split(src, "create_time", 3600, run["out"], run["checkpoint"])
    main = t.spark.read.parquet(run["out"] + "/main").withColumn("route", F.lit("main"))
    late = t.spark.read.parquet(run["out"] + "/late").withColumn("route", F.lit("late"))
    return main.unionByName(late).drop("batch")


@register("stream_level_counts_sliding", """
SELECT ws AS window_start, ws + INTERVAL '6 hours' AS window_end, level, count(*) AS count FROM (
  SELECT level, time_bucket(INTERVAL '3 hours', create_time) AS ws FROM job_log
  UNION ALL SELECT level, time_bucket(INTERVAL '3 hours', create_time) - INTERVAL '3 hours' FROM job_log)
GROUP BY 1, 2, 3""", ("job_log",))
def _stream_level_counts_sliding(t):
    """Sliding windows (6 hours every 3 hours): each row counts in two windows."""
    log = t.job_log()
    run, src = _staged(t, "levels_sliding", log, "create_time")
    G.stream_level_counts(src, "create_time", "6 hours", "3 hours", "1 hour", run["out"], run["checkpoint"])
    return G.latest_state(t.spark, run["out"], ["window_start", "window_end", "level"]).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "level", "count")

"""Streams over the events table, run to their end; the SQL is that of the batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import stream, table
from ..streaming import sinks, stateful, windows
from ._registry import query

def start():
    return F.unix_micros("window.start").alias("start_us")


@query("SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(spark, sf_dir):
    out = sinks.drained(windows.tumbling(stream(spark, sf_dir, "events"), "1 day", ["event_type"]), "complete")
    return out.select(start(), "event_type", "n", F.round("total", 4).alias("total"))


@query("""WITH e AS (SELECT event_type, value, unnest([0, 1]) o, time_bucket(INTERVAL 12 HOUR, ts) b FROM events)
SELECT epoch_us(b - o * INTERVAL 12 HOUR) AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM e GROUP BY 1, 2""")
def stream_sliding(spark, sf_dir):
    out = sinks.drained(windows.sliding(stream(spark, sf_dir, "events"), "1 day", "12 hours", ["event_type"]), "complete")
    return out.select(start(), "event_type", "n", F.round("total", 4).alias("total"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END s FROM events), i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) k FROM g)
SELECT epoch_us(min(ts)) AS start_us, user_id, count(*) AS n FROM i GROUP BY user_id, k""")
def stream_session(spark, sf_dir):
    out = sinks.drained(windows.session(stream(spark, sf_dir, "events"), "6 hours", ["user_id"]), "complete")
    return out.select(start(), "user_id", "n")


@query("SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1, 2")
def stream_dedup(spark, sf_dir):
    """With a watermark over the whole table, so that each key is seen once."""
    out = sinks.drained(windows.distinct_within(stream(spark, sf_dir, "events"), ["user_id", "event_type"], delay="3650 days").select("user_id", "event_type"))
    return out.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, c_name, c_nationkey FROM events LEFT JOIN customer ON user_id = c_custkey")
def stream_static_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    return sinks.drained(windows.enriched(stream(spark, sf_dir, "events"), c, "user_id").select("event_id", "c_name", "c_nationkey"))


@query()
def stream_track_state(spark, sf_dir):
    v = F.col("value")
    d = stream(spark, sf_dir, "events").select(
        F.col("user_id").alias("video_id"), F.col("event_id").alias("det_id"), (F.unix_micros("ts") / 60_000_000).cast("long").alias("at"), F.lit(0.0).alias("shift_x"), F.lit(0.0).alias("shift_y"),
        v.alias("confidence"), v.alias("x_min"), (v / 2).alias("y_min"), (v + 60).alias("x_max"), (v / 2 + 40).alias("y_max"),
    )
    return sinks.drained(stateful.track(d))


@query("""SELECT user_id AS task_id, CASE WHEN k % 3 = 0 THEN 'done' WHEN k % 3 = 1 THEN 'queued' ELSE 'running' END AS status FROM (SELECT DISTINCT user_id, user_id k FROM events)""")
def stream_queue_fold(spark, sf_dir):
    """Each user is a task: enqueued, claimed, then completed, failed (retried) or left running."""
    e = stream(spark, sf_dir, "events").select(F.col("user_id").alias("task_id"), F.lit("x").alias("worker"))
    last = F.when(F.col("task_id") % 3 == 0, "complete").when(F.col("task_id") % 3 == 1, "fail").otherwise("heartbeat")
    kinds = F.array(*(F.struct(F.lit(i).cast("double").alias("at"), F.lit(i).alias("seq"), k.alias("kind")) for i, k in enumerate((F.lit("enqueue"), F.lit("claim"), last))))
    first = e.withColumn("ts", F.timestamp_seconds(F.lit(0))).withWatermark("ts", "1 hour").dropDuplicates(["task_id"])
    rows = first.select("task_id", "worker", F.explode(kinds).alias("k")).select("task_id", "worker", "k.*")
    return sinks.drained(stateful.queue(rows), "update", keys=["task_id"]).select("task_id", "status")


@query("""WITH t AS (SELECT event_type AS queue, CAST(event_id AS VARCHAR) AS task_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id % 7, CAST(event_id AS VARCHAR)) k FROM events),
c AS (SELECT event_type AS queue, event_id AS seq, row_number() OVER (PARTITION BY event_type ORDER BY event_id) k FROM events)
SELECT queue, seq, task_id, 1 AS attempts FROM t JOIN c USING (queue, k)""")
def stream_queue_claims(spark, sf_dir):
    """Each event is a task and then a claim of its type's queue; no lease ends."""
    e = stream(spark, sf_dir, "events")
    none = F.lit(None).cast("long")
    task = F.struct(F.col("event_id").cast("string").alias("task_id"), F.lit("enqueue").alias("kind"), F.lit(0.0).alias("at"), (F.col("event_id") % 7).cast("long").alias("priority"))
    claim = F.struct(F.lit(None).cast("string").alias("task_id"), F.lit("claim").alias("kind"), (F.col("event_id") + 1).cast("double").alias("at"), none.alias("priority"))
    rows = e.select(F.col("event_type").alias("queue"), F.col("event_id").cast("long").alias("seq"), F.explode(F.array(task, claim)).alias("k")).select("queue", "seq", "k.*", F.lit("w").alias("worker"), none.alias("most"))
    return sinks.drained(stateful.claims(rows, 1e12)).select("queue", "seq", "task_id", "attempts")


@query("SELECT user_id AS worker, max(epoch_us(ts)) AS last_seen, 2000000000000000 - max(epoch_us(ts)) AS seconds_since FROM events WHERE event_id % 2 = 0 GROUP BY 1")
def stream_worker_heartbeats(spark, sf_dir):
    e = stream(spark, sf_dir, "events").select(F.col("user_id").alias("worker"), F.when(F.col("event_id") % 2 == 0, "heartbeat").otherwise("claim").alias("kind"), F.unix_micros("ts").alias("at"))
    return sinks.drained(stateful.workers(e, F.lit(2_000_000_000_000_000)), "update", keys=["worker"])

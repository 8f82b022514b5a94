"""Time-ordered observations: top-k, islands, grids, elections over events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import elections, motion, ordering, quality, tracking
from ..sources.tables import table
from ._registry import query


def observations(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query("SELECT user_id, event_id, value, i AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) i FROM events) WHERE i <= 3")
def top_k_per_track(spark, sf_dir):
    out = ordering.top_k(observations(spark, sf_dir), ["user_id"], [F.desc("value"), F.col("event_id")], 3)
    return out.select("user_id", "event_id", "value", F.col("rank").cast("long").alias("rank"))


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) i FROM events) WHERE i = 1")
def best_per_track(spark, sf_dir):
    return ordering.elect(observations(spark, sf_dir), ["user_id"], ["value", -F.col("event_id")], ["event_id", "value"])


@query("""WITH m AS (SELECT user_id, ts, event_id, value, list_sort(list(value) OVER w) a, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) i FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
s AS (SELECT *, CASE WHEN len(a) % 2 = 1 THEN a[len(a) // 2 + 1] ELSE (a[len(a) // 2] + a[len(a) // 2 + 1]) / 2 END sm FROM m),
f AS (SELECT *, sm <= 40 AND (i = 1 OR event_id % 10 >= 3 OR sm <= 40 * 0.45) stop FROM s),
g AS (SELECT *, sum(CASE WHEN stop THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) g FROM f)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*) AS n FROM g WHERE stop GROUP BY user_id, g""")
def stop_windows(spark, sf_dir):
    df = observations(spark, sf_dir).withColumn("at", F.unix_micros("ts"))
    order = ["at", "event_id"]
    df = df.withColumn("smoothed", motion.rolling_median("value", "user_id", order, 5))
    first = F.row_number().over(Window.partitionBy("user_id").orderBy(*order)) == 1
    df = df.withColumn("first", first)
    df = df.withColumn("stop", motion.stop_flag(F.col("smoothed"), F.lit(40.0), F.col("event_id") % 10, 3, F.col("first")))
    out = motion.islands(df, "user_id", order, "stop", "at")
    return out.select("user_id", F.col("start").alias("start_us"), F.col("end").alias("end_us"), "n")


@query("SELECT round(quantile_cont(value, 0.45), 6) AS threshold FROM (SELECT value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) i FROM events) WHERE i > 1")
def percentile_threshold(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    df = observations(spark, sf_dir).withColumn("i", F.row_number().over(w)).where("i > 1")
    return df.agg(F.round(F.percentile("value", F.lit(0.45)), 6).alias("threshold"))


@query("""WITH s AS (SELECT user_id, epoch_us(min(ts)) // 1000000 lo, epoch_us(max(ts)) // 1000000 hi FROM events GROUP BY user_id),
g AS (SELECT user_id, unnest(generate_series(lo, hi, 86400)) AS "at" FROM s UNION SELECT user_id, unnest(generate_series(lo, hi, 64800)) FROM s UNION SELECT user_id, hi FROM s)
SELECT user_id, "at" FROM g""")
def sampling_grid(spark, sf_dir):
    at = (F.unix_micros("ts") / 1000000).cast("long")
    span = observations(spark, sf_dir).groupBy("user_id").agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    parts = [motion.grid(span, F.col("lo"), F.col("hi"), F.lit(step), ["user_id"]) for step in (86400, 64800)]
    return parts[0].union(parts[1]).union(span.select("user_id", F.col("hi"))).distinct()


@query("""SELECT event_id, round(coalesce(value - lag(value) OVER w, 0.0), 6) AS delta, round(coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6, 0.0), 6) AS gap_s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def lag_speed(spark, sf_dir):
    out = motion.lagged(observations(spark, sf_dir), "user_id", ["ts", "event_id"], "value")
    return out.select("event_id", F.round("delta", 6).alias("delta"), F.round("gap_s", 6).alias("gap_s"))


@query("""WITH a AS (SELECT user_id, event_type, round(value / 10) AS v, max(value) top, count(*) n, count(DISTINCT CAST(ts AS DATE)) t FROM events GROUP BY 1, 2, 3)
SELECT user_id, event_type, v, round(top + 0.07 * least(n, 8) + 0.05 * least(t, 4), 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY top + 0.07 * least(n, 8) + 0.05 * least(t, 4) DESC, v) i FROM a) WHERE i = 1""")
def consensus_value(spark, sf_dir):
    df = observations(spark, sf_dir).withColumn("v", F.round(F.col("value") / 10))
    g = df.groupBy("user_id", "event_type", "v").agg(F.max("value").alias("top"), F.count(F.lit(1)).alias("n"), F.count_distinct(F.to_date("ts")).alias("t"))
    g = g.withColumn("s", F.col("top") + F.least("n", F.lit(8)) * 0.07 + F.least("t", F.lit(4)) * 0.05)
    return ordering.elect(g, ["user_id", "event_type"], ["s", -F.col("v")], ["v", "s"]).select("user_id", "event_type", "v", F.round("s", 6).alias("score"))


@query("""WITH r AS (SELECT conv_id, turn, role, length(text) l, substr(text, 1, 3) v, CASE WHEN role = 'assistant' AND length(text) >= 200 THEN 0 WHEN role = 'assistant' THEN 1 ELSE 2 END tier FROM conversations),
m AS (SELECT conv_id, min(tier) t FROM r GROUP BY conv_id), k AS (SELECT r.* FROM r JOIN m USING (conv_id) WHERE tier = t),
g AS (SELECT conv_id, v, max(l / 1000.0) + 0.045 * least(count(*), 5) s, min(turn) o, count(*) n FROM k GROUP BY 1, 2)
SELECT conv_id, v AS value, n FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY s DESC, o) i FROM g) WHERE i = 1""")
def name_election(spark, sf_dir):
    r = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("ordinal"), "role", F.length("text").alias("l"), F.substring("text", 1, 3).alias("value"), (F.length("text") / 1000.0).alias("score"))
    kept = elections.first_tier(r, ["conv_id"], [(F.col("role") == "assistant") & (F.col("l") >= 200), F.col("role") == "assistant"])
    return elections.name_election(kept, ["conv_id"]).select("conv_id", "value", "n")


@query("""WITH q AS (SELECT user_id % 50 AS track, event_id % 3 AS rank, event_type AS variant, max(value) fine FROM events WHERE event_type <> 'view' GROUP BY 1, 2, 3), c AS (SELECT track, rank, max(fine) coarse FROM q GROUP BY 1, 2),
r AS (SELECT event_id, user_id % 50 AS track, event_id % 3 AS rank, event_type AS variant, value FROM events)
SELECT event_id, round(value + 0.05 * coalesce(fine, coarse, 0.0), 6) AS score FROM (SELECT r.*, fine, coarse, row_number() OVER (PARTITION BY r.track ORDER BY value + 0.05 * coalesce(fine, coarse, 0.0) DESC, event_id) i
 FROM r LEFT JOIN q USING (track, rank, variant) LEFT JOIN c ON r.track = c.track AND r.rank = c.rank) WHERE i = 1""")
def quality_fallback(spark, sf_dir):
    e = observations(spark, sf_dir).select("event_id", (F.col("user_id") % 50).alias("track"), (F.col("event_id") % 3).alias("rank"), F.col("event_type").alias("variant"), "value")
    q = e.where("variant <> 'view'").withColumnRenamed("value", "quality")
    rows = e.withColumn("score", F.col("value")).withColumn("ordinal", F.col("event_id")).withColumn("value", F.col("event_id"))
    out = elections.quality_choice(rows, q, ["track"])
    return out.select(F.col("value").alias("event_id"), F.round(F.col("score") + 0.05 * F.col("quality"), 6).alias("score"))


TYPES = ["click", "login", "logout", "purchase", "view"]


@query("""WITH b AS (SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) i FROM events) WHERE i = 1)
SELECT user_id, max(CASE WHEN event_type = 'click' THEN event_id END) AS click, max(CASE WHEN event_type = 'purchase' THEN event_id END) AS purchase, max(CASE WHEN event_type = 'view' THEN event_id END) AS view FROM b GROUP BY user_id""")
def field_pivot(spark, sf_dir):
    best = ordering.elect(observations(spark, sf_dir), ["user_id", "event_type"], ["value", -F.col("event_id")], ["event_id"])
    return best.groupBy("user_id").pivot("event_type", ["click", "purchase", "view"]).agg(F.first("event_id"))


@query("""WITH c AS (SELECT user_id, props, count(*) n, max(value) v, min(event_id) e FROM events GROUP BY 1, 2) SELECT user_id, props, n, conflicts FROM (SELECT *, count(*) OVER (PARTITION BY user_id) conflicts, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, v DESC, e) i FROM c) WHERE i = 1""")
def qr_majority(spark, sf_dir):
    c = observations(spark, sf_dir).groupBy("user_id", "props").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("v"), F.min("event_id").alias("e"))
    best = ordering.elect(c, ["user_id"], ["n", "v", -F.col("e")], ["props", "n"])
    return best.join(c.groupBy("user_id").agg(F.count(F.lit(1)).alias("conflicts")), "user_id").select("user_id", "props", "n", "conflicts")


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_payload(spark, sf_dir):
    return observations(spark, sf_dir).select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("""WITH t AS (SELECT *, count(*) OVER (PARTITION BY user_id) n, max(value) OVER (PARTITION BY user_id) m FROM events)
SELECT user_id, event_id, i AS rank FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) i FROM t WHERE (n >= 2 OR m >= 0.45) AND value >= 5) WHERE i <= 2""")
def track_export(spark, sf_dir):
    e = observations(spark, sf_dir).select(F.col("user_id").alias("track_id"), "event_id", F.col("value").alias("confidence"), F.col("value").alias("quality_score"), F.col("value").alias("crop_score"), F.col("event_id").alias("arrival"))
    return quality.exported(e, 2, 5.0, 5.0).select(F.col("track_id").alias("user_id"), "event_id", F.col("rank").cast("long").alias("rank"))


@query("""SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN value < 10 THEN 'low' END, CASE WHEN value > 90 THEN 'high' END, CASE WHEN event_id % 7 = 0 THEN 'seventh' END], lambda x: x IS NOT NULL)) AS reason FROM events) GROUP BY reason""")
def reject_reasons(spark, sf_dir):
    from ..operators.metrics import reject_counts

    gated = quality.gate(observations(spark, sf_dir), {"low": F.col("value") >= 10, "high": F.col("value") <= 90, "seventh": F.col("event_id") % 7 != 0})
    return reject_counts(gated, "reject_reasons")


def detections(spark, sf_dir):
    """Events as detections of a moving box: a user is a video."""
    v = F.col("value")
    return observations(spark, sf_dir).select(
        F.col("user_id").alias("video_id"), F.col("event_id").alias("det_id"), (F.unix_micros("ts") / 60_000_000).cast("long").alias("at"), F.lit(0.0).alias("shift_x"), F.lit(0.0).alias("shift_y"),
        v.alias("confidence"), v.alias("x_min"), (v / 2).alias("y_min"), (v + 60).alias("x_max"), (v / 2 + 40).alias("y_max"),
    )


@query()
def track_assign(spark, sf_dir):
    return tracking.assign(detections(spark, sf_dir))

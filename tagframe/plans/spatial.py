"""Boxes: overlap, suppression, tiles, truth matching, spatial duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import dedup, lookups, metrics, tracking
from ..sources.tables import table
from ._registry import query

BOX = """SELECT vec_id, label, 50.0 * (1 + CAST(embedding[1] AS DOUBLE)) AS x_min, 50.0 * (1 + CAST(embedding[2] AS DOUBLE)) AS y_min,
 50.0 * (1 + CAST(embedding[1] AS DOUBLE)) + 20 + 20 * abs(CAST(embedding[3] AS DOUBLE)) AS x_max, 50.0 * (1 + CAST(embedding[2] AS DOUBLE)) + 20 + 20 * abs(CAST(embedding[4] AS DOUBLE)) AS y_max FROM embeddings"""
IOU = """(greatest(0, least(a.x_max, b.x_max) - greatest(a.x_min, b.x_min)) * greatest(0, least(a.y_max, b.y_max) - greatest(a.y_min, b.y_min)))"""


def boxes(spark, sf_dir):
    e = lambda i: F.element_at("embedding", i).cast("double")
    x, y = (F.lit(50.0) * (1 + e(i)) for i in (1, 2))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", x.alias("x_min"), y.alias("y_min"), (x + 20 + 20 * F.abs(e(3))).alias("x_max"), (y + 20 + 20 * F.abs(e(4))).alias("y_max"))


def side(df, p):
    return df.select(*(F.col(c).alias(f"{p}_{c}") for c in df.columns))


@query(f"""WITH x AS ({BOX}), p AS (SELECT a.vec_id a_id, b.vec_id b_id, {IOU} i, (a.x_max - a.x_min) * (a.y_max - a.y_min) + (b.x_max - b.x_min) * (b.y_max - b.y_min) s,
  sqrt(power((a.x_min + a.x_max - b.x_min - b.x_max) / 2, 2) + power((a.y_min + a.y_max - b.y_min - b.y_max) / 2, 2)) d FROM x a JOIN x b ON a.label = b.label AND a.vec_id < b.vec_id)
SELECT a_id, b_id, round(i / (s - i), 6) AS iou, round(d, 6) AS distance FROM p WHERE i / (s - i) >= 0.25""")
def iou_pairs(spark, sf_dir):
    # Overlapping boxes share a grid cell, so the join is on cells, not on all pairs of a label.
    a, b = (side(boxes(spark, sf_dir), p).withColumn("label", F.col(f"{p}_label")) for p in "bt")
    cols = [c for p in "bt" for c in (f"{p}_vec_id", f"{p}_x_min", f"{p}_y_min", f"{p}_x_max", f"{p}_y_max")]
    both = lookups.cell_join(a, b, ["label"], 32, cols[:5], cols[5:]).where("b_vec_id < t_vec_id")
    x, y = geometry.box("b_"), geometry.box("t_")
    out = both.withColumn("iou", geometry.iou(x, y)).where("iou >= 0.25")
    return out.select(F.col("b_vec_id").alias("a_id"), F.col("t_vec_id").alias("b_id"), F.round("iou", 6).alias("iou"), F.round(geometry.centre_distance(x, y), 6).alias("distance"))


@query(f"""WITH x AS ({BOX}), t AS (SELECT i * 40.0 AS x0, j * 40.0 AS y0 FROM range(-1, 4) a(i), range(-1, 4) b(j)),
c AS (SELECT vec_id, x0, y0, greatest(x_min, x0) a, greatest(y_min, y0) b, least(x_max, x0 + 40) c, least(y_max, y0 + 40) d, (x_max - x_min) * (y_max - y_min) s FROM x, t WHERE x_min < x0 + 40 AND x_max > x0 AND y_min < y0 + 40 AND y_max > y0)
SELECT vec_id, x0 AS tile_x, y0 AS tile_y, round((c - a) * (d - b) / s, 6) AS visible FROM c WHERE (c - a) * (d - b) / s >= 0.2 AND c - a > 4 AND d - b > 4""")
def tile_overlap_join(spark, sf_dir):
    # Tiles are a grid: a box names its tiles itself, no join is needed.
    b = boxes(spark, sf_dir)
    at = lambda c: F.least(F.lit(3), F.greatest(F.lit(-1), F.floor(F.col(c) / 40)))
    t = b.withColumn("i", F.explode(F.sequence(at("x_min"), at("x_max")))).withColumn("j", F.explode(F.sequence(at("y_min"), at("y_max"))))
    x0, y0 = F.col("i") * 40.0, F.col("j") * 40.0
    own = geometry.box()
    c = geometry.clip(own, (x0, y0, x0 + 40, y0 + 40))
    visible = geometry.area(c) / geometry.area(own)
    out = t.select("vec_id", x0.alias("tile_x"), y0.alias("tile_y"), visible.alias("v"), (c[2] - c[0]).alias("w"), (c[3] - c[1]).alias("h"))
    return out.where("v >= 0.2 and w > 4 and h > 4").select("vec_id", "tile_x", "tile_y", F.round("v", 6).alias("visible"))


@query()
def nms_fold(spark, sf_dir):
    """Greedy suppression within groups of boxes of one label and grid cell."""
    b = boxes(spark, sf_dir).withColumn("cell", F.floor(F.col("x_min") / 10))
    row = F.struct((F.col("vec_id") % 97).cast("double").alias("score"), F.col("vec_id").alias("ordinal"), "x_min", "y_min", "x_max", "y_max")
    kept = b.groupBy("label", "cell").agg(F.collect_list(row).alias("a")).select("label", "cell", F.explode(geometry.nms(F.col("a"), 0.5)).alias("k"))
    return kept.select("label", F.col("k.ordinal").alias("vec_id"), F.col("k.score").alias("score"))


@query()
def gt_match_eval(spark, sf_dir):
    """Truth: even vectors; predictions: odd ones; an image is a label."""
    b = boxes(spark, sf_dir)
    both = b.where("vec_id % 2 in (0, 1)").select(F.col("label").alias("image_id"), F.col("vec_id").alias("id"), (F.col("vec_id") % 2 == 1).alias("is_pred"), "x_min", "y_min", "x_max", "y_max")
    found = tracking.matched_boxes(both)
    n = b.count()
    return metrics.evaluation(found, (n + 1) // 2, n // 2)


ROWS = f"""x AS ({BOX}), r AS (SELECT vec_id AS idx, label AS price, vec_id % 3 = 0 AS strong, ['t' || (vec_id % 4), 'u' || (vec_id % 3)] AS tokens, vec_id * 1.0 AS identity, CASE WHEN vec_id % 5 = 0 THEN CAST(vec_id // 10 AS VARCHAR) ELSE '' END AS barcode, * FROM x),
g AS (SELECT barcode FROM r WHERE barcode <> '' GROUP BY barcode HAVING count(*) = 2),
d1 AS (SELECT idx, kept_idx, 'exact_barcode' AS rule FROM (SELECT idx, first_value(idx) OVER (PARTITION BY barcode ORDER BY identity DESC, idx) AS kept_idx FROM r JOIN g USING (barcode)) WHERE idx <> kept_idx),
l AS (SELECT * FROM r WHERE idx NOT IN (SELECT idx FROM d1)),
p AS (SELECT b.idx, a.idx AS kept_idx FROM l a JOIN l b ON a.price = b.price AND a.strong AND NOT b.strong AND len(list_intersect(a.tokens, b.tokens)) > 0
  AND ({IOU} / ((a.x_max - a.x_min) * (a.y_max - a.y_min) + (b.x_max - b.x_min) * (b.y_max - b.y_min) - {IOU}) >= 0.25
    OR sqrt(power((a.x_min + a.x_max - b.x_min - b.x_max) / 2, 2) + power((a.y_min + a.y_max - b.y_min - b.y_max) / 2, 2)) <= 9)),
d2 AS (SELECT idx, min(kept_idx) AS kept_idx, 'same_price_spatial_identity' AS rule FROM p GROUP BY idx)"""


def table_rows(spark, sf_dir):
    b = boxes(spark, sf_dir)
    v = F.col("vec_id")
    return b.select(
        v.alias("idx"), F.col("label").alias("price"), (v % 3 == 0).alias("strong"), F.array(F.concat(F.lit("t"), (v % 4).cast("string")), F.concat(F.lit("u"), (v % 3).cast("string"))).alias("tokens"),
        (v * 1.0).alias("identity"), F.when(v % 5 == 0, F.floor(v / 10).cast("string")).otherwise("").alias("barcode"), "x_min", "y_min", "x_max", "y_max",
    )


@query(f"WITH {ROWS} SELECT idx, kept_idx FROM d1")
def dedup_pairs(spark, sf_dir):
    return dedup.barcode_drops(table_rows(spark, sf_dir)).select("idx", "kept_idx")


@query(f"WITH {ROWS} SELECT idx, kept_idx FROM d2")
def dedup_spatial(spark, sf_dir):
    rows = table_rows(spark, sf_dir)
    return dedup.spatial_drops(rows, dedup.barcode_drops(rows), most_distance=9.0).select("idx", "kept_idx")


@query(f"WITH {ROWS} SELECT rule, count(*) AS n FROM (SELECT * FROM d1 UNION ALL SELECT * FROM d2) GROUP BY rule")
def dedup_report(spark, sf_dir):
    return dedup.drops(table_rows(spark, sf_dir), most_distance=9.0).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {ROWS} SELECT idx FROM r WHERE idx NOT IN (SELECT idx FROM d1) AND idx NOT IN (SELECT idx FROM d2)")
def dedup_kept(spark, sf_dir):
    return dedup.deduplicated(table_rows(spark, sf_dir), most_distance=9.0).select("idx")


@query(f"""WITH x AS ({BOX}) SELECT vec_id, (x_max - x_min) * (y_max - y_min) BETWEEN 600 AND 1500 AND (x_max - x_min) / (y_max - y_min) BETWEEN 0.8 AND 1.6 AS ok FROM x""")
def box_gate(spark, sf_dir):
    from ..operators.quality import box_gate as gate

    b = boxes(spark, sf_dir)
    return b.select("vec_id", gate(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min"), 600, 1500, 0.8, 1.6).alias("ok"))

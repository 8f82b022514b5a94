"""Duplicate rows: exact barcode pairs, then same-price rows in the same place.

Rule 2 is a left semi-join: exactly one side of its pairs has a strong identity and the other
side goes, so a strong row never goes by it and a weak row never drops another.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry
from . import lookups
from .ordering import elect


def barcode_drops(rows: DataFrame, barcode: str = "barcode", score: str = "identity", idx: str = "idx") -> DataFrame:
    """Of groups of two the lower score goes, the later row on ties: idx, kept_idx, rule."""
    have = rows.where(F.col(barcode) != "")
    size = have.groupBy(barcode).agg(F.count(F.lit(1)).alias("n")).where("n = 2").drop("n")
    pairs = have.join(size, barcode)
    keep = elect(pairs, [barcode], [score, -F.col(idx)], [idx]).withColumnRenamed(idx, "kept_idx")
    return pairs.join(keep, barcode).where(F.col(idx) != F.col("kept_idx")).select(idx, "kept_idx", F.lit("exact_barcode").alias("rule"))


def skipped_groups(rows: DataFrame, barcode: str = "barcode") -> DataFrame:
    return rows.where(F.col(barcode) != "").groupBy(barcode).agg(F.count(F.lit(1)).alias("n")).where("n > 2")


def spatial_pairs(rows: DataFrame, gone: DataFrame, *, price: str = "price", strong: str = "strong", tokens: str = "tokens", idx: str = "idx", least_iou: float = 0.25, most_distance: float = 90.0) -> DataFrame:
    """(weak idx, strong idx) of equal price, near boxes and a common token; ``gone``: idx dropped before.

    The join is on price and grid cell, as few prices are very frequent.  A weak box grown by the distance
    meets every box that overlaps it or whose centre is within it.
    """
    live = rows.join(gone.select(idx), idx, "left_anti").where(F.col(price).isNotNull())
    box = ["x_min", "y_min", "x_max", "y_max"]

    def side(df: DataFrame, p: str, grow: float) -> DataFrame:
        low, high = (lambda c: F.least(f"{c}_min", f"{c}_max") - grow), (lambda c: F.greatest(f"{c}_min", f"{c}_max") + grow)
        edges = (low("x"), low("y"), high("x"), high("y"))
        return df.select(F.col(price).alias("price"), F.col(idx).alias(f"{p}_idx"), F.col(tokens).alias(f"{p}_tokens"), F.struct(*box).alias(f"{p}_box"), *(e.alias(f"{p}_{c}") for e, c in zip(edges, box)))

    keep = [[f"{p}_{c}" for c in ("idx", "tokens", "box")] for p in "bt"]
    both = lookups.cell_join(side(live.where(~F.col(strong)), "b", most_distance), side(live.where(strong), "t", 0.0), ["price"], max(1, math.ceil(4 * most_distance)), *keep)
    a, b = (tuple(F.col(f"{p}_box")[c] for c in box) for p in "bt")
    near = (geometry.iou(a, b) >= least_iou) | (geometry.centre_distance(a, b) <= most_distance)
    return both.where(near & F.arrays_overlap("b_tokens", "t_tokens")).select(F.col("b_idx").alias(idx), F.col("t_idx").alias("kept_idx"))


def spatial_drops(rows: DataFrame, gone: DataFrame, **options) -> DataFrame:
    pairs = spatial_pairs(rows, gone, **options)
    return pairs.groupBy("idx").agg(F.min("kept_idx").alias("kept_idx")).withColumn("rule", F.lit("same_price_spatial_identity"))


def drops(rows: DataFrame, **options) -> DataFrame:
    """idx, kept_idx, rule of every row that goes."""
    first = barcode_drops(rows)
    return first.unionByName(spatial_drops(rows, first, **options))


def deduplicated(rows: DataFrame, **options) -> DataFrame:
    return rows.join(drops(rows, **options).select("idx"), "idx", "left_anti")


def report(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The drops with both rows' boxes compared."""
    a, b = (rows.select(*(F.col(c).alias(f"{x}_{c}") for c in rows.columns)) for x in ("d", "k"))
    both = found.join(a, found.idx == a.d_idx).join(b, found.kept_idx == b.k_idx)
    x, y = geometry.box("d_"), geometry.box("k_")
    return both.select("idx", "kept_idx", "rule", F.col("d_identity").alias("score"), F.col("k_identity").alias("kept_score"), geometry.iou(x, y).alias("iou"), geometry.centre_distance(x, y).alias("center_distance"), F.array_intersect("d_tokens", "k_tokens").alias("common_tokens"))


def identity(accepted: Column, barcode: Column, tokens: Column, filled: Column, recovery: Column, margin: Column, quality: Column, crop: Column, ocr: Column, seen: Column) -> Column:
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return (
        F.when(accepted, 5.0).otherwise(0.0) + F.when(barcode != "", 2.0).otherwise(0.0) + F.least(F.size(tokens), F.lit(8)) * 0.12 + z(recovery) + z(margin) * 0.05
        + z(quality) + z(crop) * 0.5 + z(ocr) * 0.25 + F.least(z(seen), F.lit(10.0)) * 0.04 + filled * 0.02
    )


def is_rerun(rows: DataFrame, recovery: DataFrame, has_backup: bool) -> bool:
    """A table with a backup and fewer rows than recovery ids was deduplicated before."""
    return has_backup and rows.count() < recovery.count()


def group_guard(rows: DataFrame, key: str, most: int = 2) -> DataFrame:
    """Rows of groups of at most ``most``, by a window."""
    return rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key))).where(F.col("_n") <= most).drop("_n")

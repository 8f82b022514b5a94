"""Boxes as four columns: overlap, distance, clipping, tiles, suppression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "") -> Box:
    return tuple(F.col(f"{prefix}{c}") for c in ("x_min", "y_min", "x_max", "y_max"))


def area(b: Box) -> Column:
    return F.greatest(F.lit(0.0), b[2] - b[0]) * F.greatest(F.lit(0.0), b[3] - b[1])


def intersection(a: Box, b: Box) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def iou(a: Box, b: Box) -> Column:
    """0 for a missing box and for an empty union."""
    inter = intersection(a, b)
    union = area(a) + area(b) - inter
    return F.coalesce(F.when(union != 0, inter / union), F.lit(0.0))


def centre_distance(a: Box, b: Box) -> Column:
    """Infinite for a missing box."""
    d = F.hypot((a[0] + a[2] - b[0] - b[2]) / 2, (a[1] + a[3] - b[1] - b[3]) / 2)
    return F.coalesce(d, F.lit(float("inf")))


def scaled_distance(a: Box, b: Box) -> Column:
    """Centre distance over the larger box's side."""
    return centre_distance(a, b) / F.greatest(F.sqrt(area(a)), F.sqrt(area(b)), F.lit(1.0))


def tile_starts(length: Column, tile: Column, step: Column) -> Column:
    """Starts at a fixed step; the last tile is flush with the end; one tile if it covers all."""
    last = length - tile
    return F.when(last <= 0, F.array(last - last)).otherwise(F.array_union(F.sequence(F.lit(0), last, step), F.array(last)))


def clip(b: Box, into: Box) -> Box:
    return F.greatest(b[0], into[0]), F.greatest(b[1], into[1]), F.least(b[2], into[2]), F.least(b[3], into[3])


def padded(b: Box, share: float, width: Column, height: Column) -> Box:
    """Grown by a share of its sides, rounded half-even, within the image."""
    px, py = (b[2] - b[0]) * share, (b[3] - b[1]) * share
    low = lambda v: F.greatest(F.lit(0.0), F.bround(v, 0))
    return low(b[0] - px), low(b[1] - py), F.least(width, F.bround(b[2] + px, 0)), F.least(height, F.bround(b[3] + py, 0))


def nms(boxes: Column, threshold: float) -> Column:
    """Greedy suppression as a fold over array<struct<score, ordinal, x_min, y_min, x_max, y_max, ...>>:
    a box stays if it overlaps every kept one of higher score by less than the threshold."""
    ordered = F.array_sort(boxes, lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).when(a["ordinal"] < b["ordinal"], -1).when(a["ordinal"] > b["ordinal"], 1).otherwise(0))
    sides = lambda s: tuple(s[c] for c in ("x_min", "y_min", "x_max", "y_max"))
    return F.aggregate(ordered, F.slice(ordered, 1, 0), lambda kept, b: F.when(F.exists(kept, lambda k: iou(sides(k), sides(b)) >= threshold), kept).otherwise(F.concat(kept, F.array(b))))

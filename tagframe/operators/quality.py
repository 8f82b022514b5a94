"""Quality gates, crop scores and track exports of detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import top_k


def reasons(tests: dict[str, Column]) -> Column:
    """Names of the failed tests, in order; a null test fails."""
    return F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in tests.items())))


def gate(df: DataFrame, tests: dict[str, Column], mode: str = "track") -> DataFrame:
    """``track``: all rows, with reasons and whether they pass; ``candidate``: passing rows only, the
    first reason being what a dropped row would have shown."""
    out = df.withColumn("reject_reasons", reasons(tests)).withColumn("passes", F.size("reject_reasons") == 0)
    return out.where("passes") if mode == "candidate" else out


def box_gate(width: Column, height: Column, low: float = 8000, high: float = 180000, narrow: float = 0.25, wide: float = 1.60) -> Column:
    aspect = F.when(height > 0, width / height).otherwise(0.0)
    return (width * height).between(low, high) & aspect.between(narrow, wide)


def bounded(df: DataFrame, k: int = 24) -> DataFrame:
    """The k best candidates of each track, by gate, score and arrival: the same as truncating at each arrival."""
    return top_k(df, ["track_id"], [F.desc("passes"), F.desc("crop_score"), F.col("arrival")], k, "candidate_rank")


def exported(df: DataFrame, k: int, least_quality: float, least_score: float, least_detections: int = 2, lone_confidence: float = 0.45) -> DataFrame:
    """Ranks within tracks that have enough candidates, or one confident one."""
    w = Window.partitionBy("track_id")
    out = df.withColumn("track_candidates", F.count(F.lit(1)).over(w)).withColumn("track_confidence", F.max("confidence").over(w))
    out = out.where((F.col("track_candidates") >= least_detections) | (F.col("track_confidence") >= lone_confidence))
    out = out.where((F.col("quality_score") >= least_quality) & (F.col("crop_score") >= least_score))
    return top_k(out, ["track_id"], [F.desc("crop_score"), F.col("arrival")], k)


def preferred(*paths: Column) -> Column:
    """The first path that there is."""
    return F.coalesce(*(F.when(F.trim(p) != "", p) for p in paths))


def variants(*paths: Column) -> Column:
    """Existing paths in order, each once."""
    return F.array_distinct(F.array_compact(F.array(*(F.when(F.trim(p) != "", p) for p in paths))))

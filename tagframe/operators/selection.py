"""Which rows a stage takes, its template, diagnostics and the row formats at its boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import first_by


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """Rows of rank ``k`` at most, by video, track and rank as numbers, and zone."""
    return rows.where(F.col("rank").cast("int") <= k).orderBy("video_id", F.col("track_id").cast("long"), F.col("rank").cast("int"), "zone")


def first_tracks(rows: DataFrame, n: int) -> DataFrame:
    """Rows of the first ``n`` (video, track), tracks in order of their numbers.  Only n keys are broadcast."""
    number = F.col("track_id").cast("long")
    keys = rows.select("video_id", number.alias("_track")).distinct().orderBy("video_id", "_track").limit(n)
    return rows.withColumn("_track", number).join(F.broadcast(keys), ["video_id", "_track"], "left_semi").drop("_track")


def in_zones(rows: DataFrame, zones: list[str]) -> DataFrame:
    """Rows of the given zones, all where none is given; a plain comparison, which reaches the scan."""
    wanted = [z.strip() for z in zones if z.strip()]
    return rows.where(F.col("zone").isin(*wanted)) if wanted else rows


def template(rows: DataFrame, fields: list[str], ordinal: str, per_crop: bool = False) -> DataFrame:
    """The result table without values: one row per track (its first of rank 1) or per crop."""
    first = rows.where(F.col("rank").cast("int") == 1) if not per_crop else rows
    keys = ["video_id", "track_id"] + (["rank"] if per_crop else [])
    keep = [c for c in rows.columns if c not in (*keys, ordinal)]
    return first_by(first, keys, [ordinal], keep).select("*", *(F.lit(None).cast("string").alias(f) for f in fields))


def diagnostics(candidates: DataFrame, exported: DataFrame) -> DataFrame:
    """Every candidate with its rank, the size of its track, and whether its track and it were exported."""
    w = Window.partitionBy("track_id")
    tracks = exported.select("track_id").distinct().withColumn("track_exported", F.lit(1))
    crops = exported.select("track_id", "timestamp_ms", "frame_index").distinct().withColumn("selected", F.lit(1))
    out = candidates.withColumn("track_candidates", F.count(F.lit(1)).over(w)).join(tracks, "track_id", "left")
    out = out.join(crops, ["track_id", "timestamp_ms", "frame_index"], "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("track_exported", "selected")})


#: Decimal places of a row's numbers when a stage writes them: later stages elect on what was written.
PLACES = {"score": 4, "confidence": 4, "quality_score": 6, "crop_score": 6, "x_min": 2, "y_min": 2, "x_max": 2, "y_max": 2}


def serialised(rows: DataFrame, places: dict[str, int] | None = None) -> DataFrame:
    """Numbers as the stages write them; missing ones are empty."""
    places = PLACES if places is None else places
    show = lambda c, n: F.when(F.col(c).isNull(), "").otherwise(F.format_string(f"%.{n}f", F.col(c).cast("double")))
    return rows.withColumns({c: show(c, n) for c, n in places.items() if c in rows.columns})


def reread(rows: DataFrame, places: dict[str, int] | None = None) -> DataFrame:
    """The numbers that a reader of ``serialised`` rows gets."""
    places = PLACES if places is None else places
    return rows.withColumns({c: F.col(c).try_cast("double") for c in places if c in rows.columns})


def identity(barcode: Column, accepted: Column) -> tuple[Column, Column]:
    """(accepted, strong identity) of a row: accepted is the text 1, strong a barcode or accepted."""
    ok = F.trim(F.coalesce(accepted.cast("string"), F.lit(""))) == "1"
    return ok, ok | (F.trim(F.coalesce(barcode.cast("string"), F.lit(""))) != "")

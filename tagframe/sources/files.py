"""Readers of the pipeline's files."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """All-string table with the header as schema; a byte-order mark is dropped, empty cells are empty."""
    df = spark.read.csv(path, header=True, sep=sep, encoding=encoding, multiLine=True, escape='"')
    return df.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c.lstrip("﻿").strip()) for c in df.columns))


def header(spark: SparkSession, path: str) -> list[str]:
    return csv(spark, path).limit(0).columns


def sniffed(spark: SparkSession, path: str, peek: int = 8192) -> tuple[str, str]:
    """(separator, encoding) from the first bytes, read through Spark: UTF-8, else cp1251."""
    head = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, peek).alias("c")).first()
    raw = bytes(head.c)
    try:
        text, encoding = raw[: raw.rfind(b"\n") + 1 or None].decode("utf-8-sig"), "UTF-8"
    except UnicodeDecodeError:
        text, encoding = raw.decode("cp1251"), "windows-1251"
    line = text.split("\n", 1)[0]
    return ";" if line.count(";") > line.count(",") else ",", encoding


NAMES = ("fullname", "full_name", "name", "product_name")
CODES = ("code", "barcode", "id", "id_sku")


def _coalesced(df: DataFrame, names: tuple[str, ...]) -> Column:
    have = {c.lower(): c for c in df.columns}
    parts = [F.when(F.trim(F.col(have[n]).cast("string")) != "", F.trim(F.col(have[n]).cast("string"))) for n in names if n in have]
    return F.coalesce(*parts, F.lit("")) if parts else F.lit("")


def catalog(spark: SparkSession, path: str, codes: tuple[str, ...] = CODES) -> DataFrame:
    """name, code and what else the file has of prices, weights and addresses; nameless rows go.  CSV or JSON."""
    if path.lower().endswith(".json"):
        df = spark.read.json(path, multiLine=True)
        if df.columns == ["_corrupt_record"] or not df.columns:
            raw = spark.read.text(path, wholetext=True)
            df = raw.select(F.explode(F.from_json("value", "array<string>")).alias("name"))
    else:
        sep, encoding = sniffed(spark, path)
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
        df = csv(spark, path, sep, encoding)
    have = {c.lower(): c for c in df.columns}
    extra = [F.col(have[c]).cast("string").alias(c) if c in have else F.lit("").alias(c) for c in ("weight_volume", "price_regular_rub", "price_promo_rub", "url")]
    return df.select(_coalesced(df, NAMES).alias("name"), _coalesced(df, codes).alias("code"), *extra).where("name <> ''")


def barcode_catalog(spark: SparkSession, path: str) -> DataFrame:
    """As catalog(), without the SKU as a code; rows need digits."""
    df = catalog(spark, path, CODES[:-1])
    return df.withColumn("code", F.regexp_replace("code", r"\D", "")).where("code <> ''").select("name", "code")


def timestamps(spark: SparkSession, path: str) -> DataFrame:
    """Extra sampling times: bare lines or a CSV's first column, comma decimals; distinct."""
    first = F.regexp_replace(F.split("value", "[;\\t]")[0], ",", ".")
    return spark.read.text(path).select(F.floor(first.try_cast("double")).alias("at")).where("at is not null").distinct()


def truth_boxes(df: DataFrame, least_area: float = 16.0) -> DataFrame:
    """Annotated boxes by time; unparsable ones and slivers go."""
    n = lambda c: F.trim(F.regexp_replace(F.col(c).cast("string"), ",", ".")).try_cast("double")
    out = df.select(n("frame_timestamp").cast("long").alias("at"), *(n(c).alias(c) for c in ("x_min", "y_min", "x_max", "y_max")))
    return out.where("at is not null and (x_max - x_min) * (y_max - y_min) > " + str(least_area))


def coco(spark: SparkSession, path: str) -> DataFrame:
    """image_id, file_name, boxes (x1, y1, x2, y2): images without boxes stay, with none."""
    df = spark.read.json(path, multiLine=True)
    images = df.select(F.explode("images").alias("i")).select(F.col("i.id").alias("image_id"), "i.file_name", "i.width", "i.height")
    b = F.col("a.bbox")
    boxes = df.select(F.explode("annotations").alias("a")).select(F.col("a.image_id").alias("image_id"), F.struct(b[0].alias("x_min"), b[1].alias("y_min"), (b[0] + b[2]).alias("x_max"), (b[1] + b[3]).alias("y_max")).alias("box"))
    grouped = boxes.groupBy("image_id").agg(F.collect_list("box").alias("boxes"))
    return images.join(grouped, "image_id", "left").withColumn("boxes", F.coalesce("boxes", F.array().cast(grouped.schema["boxes"].dataType)))


def tag_files(spark: SparkSession, folder: str) -> DataFrame:
    """track_id, rank, timestamp_ms, path of ``track_N_rank_N_ts_N_full.jpg`` files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "track_*_full.jpg").option("recursiveFileLookup", "true").load(folder).select("path")
    part = lambda i: F.regexp_extract("path", r"track_(\d+)_rank_(\d+)_ts_(\d+)_full\.jpg$", i).try_cast("long")
    return files.select(part(1).alias("track_id"), part(2).alias("rank"), part(3).alias("timestamp_ms"), "path").where("track_id is not null")


def annotated_videos(spark: SparkSession, folder: str) -> DataFrame:
    """Folders <d> with <d>.mp4 and <d>.csv."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    parts = files.select("path", F.regexp_extract("path", r"/([^/]+)/([^/]+)\.(mp4|csv)$", 1).alias("d"), F.regexp_extract("path", r"/([^/]+)/([^/]+)\.(mp4|csv)$", 2).alias("n"), F.regexp_extract("path", r"\.(mp4|csv)$", 1).alias("k")).where("d = n and d <> ''")
    return parts.groupBy("d").pivot("k", ["mp4", "csv"]).agg(F.first("path")).where("mp4 is not null and csv is not null").withColumnRenamed("d", "video_id")


def mp4_seconds(raw: bytes) -> float | None:
    """Duration in the movie header (versions 0 and 1)."""
    at = raw.find(b"mvhd")
    if at < 0 or at + 36 > len(raw):
        return None
    body = raw[at + 4 :]
    scale, length = struct.unpack_from(">II", body, 12) if body[0] == 0 else struct.unpack_from(">IQ", body, 20)
    return length / scale if scale else None


def durations(spark: SparkSession, path: str) -> DataFrame:
    """path, seconds of videos."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b.path, "seconds": [mp4_seconds(bytes(c)) for c in b.content]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, seconds double")


def tsv_lines(spark_df: DataFrame, keys: list[str], text: str = "tsv") -> DataFrame:
    """Recogniser output with 12 tab-separated columns per word to lines: keys, text, confidence.

    Words are level 5; weak short ones go; confidence is the mean of those that have one, over 100.
    """
    rows = spark_df.select(*keys, F.posexplode(F.split(text, "\r?\n")).alias("i", "line"))
    c = F.split("line", "\t", 12)
    words = rows.select(*keys, "i", *(F.try_element_at(c, F.lit(k)).try_cast("int").alias(n) for k, n in ((1, "level"), (3, "block"), (4, "par"), (5, "line_no"))), F.try_element_at(c, F.lit(11)).try_cast("double").alias("conf"), F.trim(F.try_element_at(c, F.lit(12))).alias("word"))
    short = F.length(F.regexp_replace("word", r"(?U)\W", "")) <= 3
    words = words.where("level = 5 and word <> ''").where(~((F.col("conf") >= 0) & (F.col("conf") < 5) & short))
    out = words.groupBy(*keys, "block", "par", "line_no").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w"), F.avg(F.when(F.col("conf") >= 0, F.col("conf") / 100)).alias("confidence"))
    return out.select(*keys, "block", "par", "line_no", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("text"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def job_states(memory: DataFrame, disk: DataFrame) -> DataFrame:
    """Job states of both, the disk's over memory's, newest first."""
    from pyspark.sql import Window

    both = memory.withColumn("_o", F.lit(1)).unionByName(disk.withColumn("_o", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy("job_id").orderBy("_o")
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_o").orderBy(F.desc(F.coalesce("finished_at", "updated_at", "started_at")), "job_id")


def log_tail(spark: SparkSession, path: str, chars: int = 240_000) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.expr(f"right(value, {chars})").alias("tail"))

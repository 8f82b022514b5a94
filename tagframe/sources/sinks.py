"""Writers of the pipeline's results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SUBMISSION


def submission_csv(df: DataFrame, path: str) -> None:
    """The final columns in order, absent ones empty, prices as written."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in SUBMISSION]
    df.select(*cols).write.mode("overwrite").csv(path, header=True, emptyValue="")


def union_csv(frames: list[DataFrame], path: str) -> None:
    """Columns of all frames in the order first seen."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    out.write.mode("overwrite").csv(path, header=True)


def upsert_partitions(df: DataFrame, path: str, key: str = "job_id") -> None:
    """Replaces the rows of the jobs in df, leaves others: dynamic partition overwrite."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def coco_json(images: DataFrame) -> DataFrame:
    """One JSON text per split.  ``images``: split, image_id, file_name, width, height, boxes."""
    ann = F.transform("boxes", lambda b: F.struct(b["x_min"].alias("x"), b["y_min"].alias("y"), (b["x_max"] - b["x_min"]).alias("w"), (b["y_max"] - b["y_min"]).alias("h")))
    row = F.struct("image_id", "file_name", "width", "height", ann.alias("annotations"))
    return images.groupBy("split").agg(F.to_json(F.struct(F.sort_array(F.collect_list(row)).alias("images"))).alias("json"))


def summary_json(df: DataFrame, counts: dict) -> DataFrame:
    return df.agg(F.to_json(F.struct(*(c.alias(n) for n, c in counts.items()))).alias("json"))


def manifest(spark, paths: list[str]) -> DataFrame:
    """path, bytes and SHA-256 of the inputs."""
    return spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))

"""Running a bounded stream to its end and reading what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import scratch


def drained(df: DataFrame, mode: str = "append", name: str = "stream", keys: list[str] | None = None) -> DataFrame:
    """All of a stream's input by now (``availableNow``), as a table in the shared folder.

    append: the file sink.  complete: the last batch's result.  update: each batch's rows under its own
    number; the last batch of each of ``keys`` counts.  A batch that is run again overwrites its own rows.
    """
    if mode == "update" and not keys:
        raise ValueError("update mode needs the keys whose last rows count")
    spark = df.sparkSession
    path, state = scratch(spark, name), scratch(spark, f"{name}-state")
    if mode != "append":  # input without rows makes no batch
        spark.createDataFrame([], df.schema).write.parquet(f"{path}/_batch=-1" if mode == "update" else path)
    writer = df.writeStream.option("checkpointLocation", state).trigger(availableNow=True).outputMode(mode)
    if mode == "append":
        query = writer.format("parquet").start(path)
    else:
        query = writer.foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/_batch={i}")).start()
    query.awaitTermination()
    if mode != "update":
        return spark.read.schema(df.schema).parquet(path)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_batch", T.LongType())])).parquet(path)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), "_batch").alias("_r")).select("_r.*")

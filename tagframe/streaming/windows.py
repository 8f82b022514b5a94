"""Windowed aggregations over streams: tumbling, sliding, session; deduplication; enrichment.

Each takes a stream (or a table: the same plan) and leaves the sink to the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def late(df: DataFrame, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Rows later than ``delay`` behind the newest are dropped by stateful operators downstream."""
    return df.withWatermark(ts, delay) if df.isStreaming else df


def tumbling(df: DataFrame, width: str, by: list[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    return _summed(late(df, ts, delay).groupBy(F.window(ts, width), *by))


def sliding(df: DataFrame, width: str, slide: str, by: list[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    return _summed(late(df, ts, delay).groupBy(F.window(ts, width, slide), *by))


def session(df: DataFrame, gap: str, by: list[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    out = late(df, ts, delay).groupBy(F.session_window(ts, gap), *by).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumnRenamed("session_window", "window")


def _summed(grouped) -> DataFrame:
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def distinct_within(df: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The first row of each key while the watermark remembers it."""
    return late(df, ts, delay).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def enriched(df: DataFrame, static: DataFrame, on: str, how: str = "left") -> DataFrame:
    """A stream joined with a table, which is read anew for each batch."""
    return df.join(static, on, how)

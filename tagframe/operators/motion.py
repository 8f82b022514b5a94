"""Time-ordered motion samples: speeds, stop windows, sampling grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lagged(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Adds previous, delta and seconds since the previous sample (0 at the first)."""
    w = Window.partitionBy(key).orderBy(*order)
    ts = F.unix_micros(F.col(order[0]).cast("timestamp"))
    return df.withColumn("previous", F.lag(value).over(w)).withColumn("delta", F.coalesce(F.col(value) - F.lag(value).over(w), F.lit(0.0))).withColumn("gap_s", F.coalesce((ts - F.lag(ts).over(w)) / 1e6, F.lit(0.0)))


def rolling_median(value: str, key: str, order: list[str], width: int) -> Column:
    """Centred, truncated at the ends; the mean of the middle two for even counts."""
    half = width // 2
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(-half, half)
    a = F.sort_array(F.collect_list(value).over(w))
    n = F.size(a)
    mid = F.floor(n / 2).cast("int")
    return F.when(n % 2 == 1, F.element_at(a, mid + 1)).otherwise((F.element_at(a, F.greatest(mid, F.lit(1))) + F.element_at(a, mid + 1)) / 2)


def stop_flag(smoothed: Column, threshold: Column, response: Column, least_response: float, first: Column) -> Column:
    return (smoothed <= threshold) & (first | (response >= least_response) | (smoothed <= threshold * 0.45))


def islands(df: DataFrame, key: str, order: list[str], flag: str, at: str) -> DataFrame:
    """Runs of rows with ``flag``: key, start, end, n."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    runs = df.withColumn("_island", F.sum((~F.col(flag)).cast("int")).over(w)).where(F.col(flag))
    return runs.groupBy(key, "_island").agg(F.min(at).alias("start"), F.max(at).alias("end"), F.count(F.lit(1)).alias("n")).drop("_island")


def grid(df: DataFrame, start: Column, stop: Column, step: Column, keep: list[str]) -> DataFrame:
    """Sampling times from start to stop at a fixed step."""
    return df.where(start <= stop).select(*keep, F.explode(F.sequence(start, stop, step)).alias("at"))


def selected_times(motion: DataFrame, windows: DataFrame, key: str, step: int, stop_step: int, pad: int) -> DataFrame:
    """Union of the moving grid, padded grids of stop windows, their midpoints and ends, within the
    recording; distinct."""
    span = motion.groupBy(key).agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    moving = grid(span, F.col("lo"), F.col("hi"), F.lit(step), [key])
    inside = windows.join(span, key)
    low, high = F.greatest(F.col("start") - pad, F.col("lo")), F.least(F.col("end") + pad, F.col("hi"))
    still = grid(inside.withColumn("a", low).withColumn("b", high), F.col("a"), F.col("b"), F.lit(stop_step), [key])
    points = inside.select(key, F.explode(F.array(F.expr("(start + end) div 2"), F.col("end"))).alias("at"))
    return moving.union(still).union(points).distinct()

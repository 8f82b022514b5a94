"""Elections with explicit tie-breaks: the first extremum in a given order wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group; ``order`` must be total.  Spark prunes groups before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def elect(df: DataFrame, by: Sequence[str], best: Sequence[str | Column], keep: Sequence[str]) -> DataFrame:
    """One row per group: the columns ``keep`` of the row with the largest ``best``.

    A grouped max of a struct, which is summed up before the shuffle, unlike a window.
    """
    pick = F.max(F.struct(*(c.alias(f"_{i}") for i, c in enumerate(_cols(best))), *keep)).alias("_best")
    return df.groupBy(*by).agg(pick).select(*by, *(F.col(f"_best.{c}").alias(c) for c in keep))


def margin(df: DataFrame, by: Sequence[str], score: str, order: Sequence[Column]) -> DataFrame:
    """Rank 1 of each group, with the runner-up's score and the distance to it."""
    w = Window.partitionBy(*by).orderBy(*order)
    rows = df.withColumn("_n", F.row_number().over(w)).withColumn("second_score", F.lead(score).over(w))
    return rows.where("_n = 1").drop("_n").withColumn("margin", F.col(score) - F.coalesce("second_score", F.lit(0.0)))


def last_by(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str | Column], keep: Sequence[str]) -> DataFrame:
    """Build side of a keyed look-up in which the last row of a key wins."""
    return elect(df, keys, ordinal, keep)


def first_by(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str | Column], keep: Sequence[str]) -> DataFrame:
    pick = F.min(F.struct(*(c.alias(f"_{i}") for i, c in enumerate(_cols(ordinal))), *keep)).alias("_best")
    return df.groupBy(*keys).agg(pick).select(*keys, *(F.col(f"_best.{c}").alias(c) for c in keep))

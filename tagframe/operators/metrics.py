"""Roll-ups over jobs and result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share(condition: Column) -> Column:
    """Percentage of rows, two places; 0 of an empty table."""
    return F.coalesce(F.round(100.0 * F.sum(condition.cast("int")) / F.count(F.lit(1)), 2), F.lit(0.0))


def fill_rates(df: DataFrame, columns: list[str], missing) -> DataFrame:
    return df.agg(*(share(~missing(F.col(c))).alias(f"{c}_rate") for c in columns))


def suspicious(default: Column, card: Column, percent: Column) -> dict[str, Column]:
    """Flags of doubtful rows; a row is suspicious if any holds."""
    no = F.lit(False)
    flags = {
        "big_discount": percent >= 80, "huge_price": (default > 10000) | (card > 10000), "discount_without_default": percent.isNotNull() & default.isNull(),
        "card_without_default": card.isNotNull() & default.isNull(), "card_over_default": card > default,
    }
    return {k: F.coalesce(v, no) for k, v in flags.items()}


def by_key(df: DataFrame, key: str | Column) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def queue_summary(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("attempts").alias("attempts"))


def progress(done_weight: Column, total_weight: Column, elapsed: Column) -> Column:
    """struct(progress, eta_s, low_s, high_s): the spread is 35 % below a quarter done, else 25 %."""
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), done_weight / total_weight))
    eta = F.when(p > 0, elapsed * (1 - p) / p)
    spread = F.when(p < 0.25, 0.35).otherwise(0.25)
    return F.struct(p.alias("progress"), eta.alias("eta_s"), (eta * (1 - spread)).alias("low_s"), (eta * (1 + spread)).alias("high_s"))


def duration_scale(seconds: Column, reference: float = 32.0) -> Column:
    return F.greatest(F.lit(0.35), seconds / reference)


def stage_summary(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("value") != "").cast("int")).alias("filled"), F.sum(F.col("valid").cast("int")).alias("valid"))


def reject_counts(df: DataFrame, reasons: str) -> DataFrame:
    return df.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def evaluation(matches: DataFrame, truths: int, predictions: int) -> DataFrame:
    """Mean matched overlap, recall and precision at an overlap of one half."""
    good = F.sum((F.col("iou") >= 0.5).cast("int"))
    return matches.agg(F.avg("iou").alias("mean_iou"), (good / truths).alias("recall_50"), (good / predictions).alias("precision_50"))

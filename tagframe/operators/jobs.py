"""Jobs: durations, the summary, and their states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES = ("queued", "running", "done", "failed")
NEXT = {"uploading": ("queued",), "queued": ("running", "failed"), "running": ("done", "failed", "queued")}


def seconds(manifest: Column, started: Column, finished: Column, updated: Column) -> Column:
    """Of a finished job: the manifest's if positive, else from start to end (the last update if there is no end), else 0."""
    end = F.coalesce(F.when(finished != 0, finished), updated)
    return F.when(manifest > 0, manifest).when(end >= started, end - started).otherwise(0.0)


def elapsed(started: Column, now: Column) -> Column:
    return F.when(started > 0, F.greatest(F.lit(0.0), now - started)).otherwise(0.0)


def summary(jobs: DataFrame, today: Column) -> DataFrame:
    """One row over ``jobs`` (status, day finished, seconds): counts by state (uploading counts as queued), done and
    failed today, and the mean seconds of done jobs that took any."""
    state = F.when(F.col("status") == "uploading", "queued").otherwise(F.col("status"))
    n = lambda test: F.sum(F.coalesce(test, F.lit(False)).cast("long"))
    mean = F.avg(F.when((F.col("status") == "done") & (F.col("seconds") > 0), F.col("seconds")))
    return jobs.agg(
        *(F.coalesce(n(state == s), F.lit(0)).alias(s) for s in STATES),
        *(F.coalesce(n((F.col("status") == s) & (F.col("day") == today)), F.lit(0)).alias(f"today_{s}") for s in ("done", "failed")),
        F.coalesce(F.round(mean, 1), F.lit(0.0)).alias("avg_processing_sec"),
    )


def latest(jobs: DataFrame, order: list[Column], n: int = 12) -> DataFrame:
    """The report's last jobs."""
    return jobs.orderBy(*order).limit(n)


def final_state(events: Column) -> Column:
    """Fold of array<struct<at, state>> in time: a state is taken only where the one before allows it."""
    allowed = F.create_map(*(x for k, v in NEXT.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    step = lambda s, e: F.when(F.coalesce(F.array_contains(F.try_element_at(allowed, s), e["state"]), F.lit(False)), e["state"]).otherwise(s)
    return F.aggregate(F.array_sort(events), F.lit("uploading"), step)


def final_json(rows: DataFrame, order: list[str]) -> Column:
    """Aggregate: a job's rows and their number as one JSON text.  One job's rows bound its size."""
    every = F.sort_array(F.collect_list(F.struct(*order, *(c for c in rows.columns if c not in order))))
    return F.to_json(F.struct(every.alias("rows"), F.size(every).alias("count")))

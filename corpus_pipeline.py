"""The corpus pipeline: five stages, each on all that its predecessor kept.

run(spark, sf_dir) applies STAGES to ``documents``.  Every stage's result is written as
Parquet and reread as the next one's input.  All stages but the last return the columns of
documents; the last adds what the mix takes of each document.

SQL can't say the toxicity model, so ORACLE_SQL is None and the tests hold the stages
against brute-force versions.

Near-duplicates are documents with a similarity of 0.80 or more (5-word shingles); the 0.85 of op10 is that
query's own.

Null and empty texts pass the filters (they hold no words).  Near-duplicates are decided by row: repeated or null
doc_ids change nothing but which row of a group stays.

Stages hand whole texts and shingle sets to Python workers.  Spark's own batches of 10,000 rows take some 50 MB each
there and several times that outside the JVM's heap; stages ask for smaller ones (``small_batches``).
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagframe.llm import decontaminate, mixing, near_dup, secrets, toxicity
from tagframe.llm._common import cut, scratch, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: the smallest doc_id's (nulls last).  Rows are numbered and written
    first, so that rows with one doc_id, or none, are decided each for itself."""
    rows = cut(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = near_dup.near_duplicates(rows, "_row", percent=80).select(F.col("doc_id").alias("_row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    kept = groups.join(rows.select("_row", "doc_id"), "_row").groupBy("component_id").agg(first.alias("first")).select("first._row")
    return rows.join(kept, "_row", "left_semi").select(docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_hits(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in place; the documents stay."""
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return clean.select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, keep=docs.columns)


BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def small_batches(stage):
    """``stage`` with BATCHES in its session, but for what the session sets itself.  They stay set, as a
    stage's result is computed after it returns; they change no result."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, most in BATCHES.items():
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, most)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", small_batches(without_toxic)),
    ("near_duplicates", small_batches(one_of_each_group)),
    ("decontamination", small_batches(without_benchmarks)),
    ("secrets", small_batches(without_secrets)),
    ("mixing", small_batches(mixed)),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark) as keep:  # a stage's own tables go once its result is written
            docs = keep(cut(stage(spark, docs, sf_dir), name))
    return docs

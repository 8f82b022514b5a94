"""The registered queries opN_<name> of this subpackage, and their SQL where SQL can say it.

Each takes (spark, sf_dir) and applies its operator to the whole intended table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, gif, language_id, lattice_lm, mixing, near_dup, preference, secrets, token_counts, toxicity
from ._common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op3_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.digest(gif.media_column(table(spark, sf_dir, "documents")))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = preference.conversations(table(spark, sf_dir, "conversations"))
    return preference.format_pairs(preference.contrasted(found), ["conv_id"])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_lattice_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages and all documents; doc_id is null for pages, page_id for documents."""
    docs = table(spark, sf_dir, "documents")
    rows = language_id.page_rows(table(spark, sf_dir, "pages")).withColumn("doc_id", F.lit(None).cast("long"))
    return language_id.identify(rows.unionByName(language_id.document_rows(docs).withColumn("page_id", F.lit(None).cast("long"))), language_id.fit(docs))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_secret_scan, op3_gif_media, op4_source_mixing, op5_preference_formatting, op6_toxicity, op7_lattice_lm_scoring, op8_benchmark_decontamination, op9_language_id, op10_minhash_near_dedup)}
ORACLE_SQL = {
    "op4_source_mixing": mixing.ORACLE,
    "op8_benchmark_decontamination": decontaminate.ORACLE,
}

"""Catalogue: distinct entries, blocking, scores, votes, barcodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import catalog, elections, ordering
from ..sources.tables import table
from ._registry import query


@query("SELECT lower(trim(p_name)) AS sort_name, p_brand, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2")
def catalog_distinct(spark, sf_dir):
    return catalog.distinct_entries(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), "p_name", ["p_brand"], "p_partkey").select("sort_name", "p_brand", "p_partkey")


TOKENS = "list_distinct(list_filter(regexp_split_to_array(trim(regexp_replace(lower({0}), '[^0-9a-z]+', ' ', 'g')), ' '), lambda t: length(t) >= {1}))"


def token_rows(df, id_col, text_col, least):
    norm = F.trim(F.regexp_replace(F.lower(text_col), "[^0-9a-z]+", " "))
    return df.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(F.filter(F.split(norm, " "), lambda t: F.length(t) >= least))).alias("k"))


@query(f"""WITH q AS (SELECT item_id, unnest({TOKENS.format('text', 8)}) k FROM benchmark), d AS (SELECT doc_id, unnest({TOKENS.format('text', 8)}) k FROM documents)
SELECT item_id, doc_id, count(*) AS common FROM q JOIN d USING (k) GROUP BY 1, 2""")
def token_blocking(spark, sf_dir):
    q = token_rows(table(spark, sf_dir, "benchmark"), "item_id", "text", 8).withColumnRenamed("id", "item_id")
    d = token_rows(table(spark, sf_dir, "documents"), "doc_id", "text", 8).withColumnRenamed("id", "doc_id")
    return d.join(q, "k").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("common"))


def names(spark, sf_dir):
    """Distinct part names, with the smallest key."""
    return table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("id"))


NAME_SQL = """n AS (SELECT p_name, min(p_partkey) id FROM part GROUP BY p_name), k AS (SELECT id, regexp_replace(lower(p_name), '[^0-9a-z]+', '', 'g') c FROM n),
t AS (SELECT id, unnest(list_distinct([substr(c, CAST(i AS BIGINT), 3) for i in range(1, greatest(length(c) - 2, 1) + 1)])) k FROM k WHERE c <> '')"""


@query(f"WITH {NAME_SQL} SELECT a.id AS query_id, b.id AS entry_id, count(*) AS n_trigram FROM t a JOIN t b USING (k) GROUP BY 1, 2")
def trigram_blocking(spark, sf_dir):
    e = catalog.entries(names(spark, sf_dir), "id", "p_name")
    return catalog.blocked(e, e, ("trigram",)).select("query_id", "entry_id", "n_trigram")


@query(f"WITH {NAME_SQL}, c AS (SELECT a.id AS query_id, b.id AS entry_id, count(*) * 0.05 AS cheap FROM t a JOIN t b USING (k) GROUP BY 1, 2) SELECT query_id, entry_id, round(cheap, 6)::DOUBLE AS cheap, i AS pre_rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cheap DESC, entry_id) i FROM c) WHERE i <= 900")
def top900_preselect(spark, sf_dir):
    e = catalog.entries(names(spark, sf_dir), "id", "p_name")
    out = catalog.preselect(catalog.blocked(e, e, ("trigram",)), 900)
    return out.select("query_id", "entry_id", F.round("cheap", 6).alias("cheap"), F.col("pre_rank").cast("long").alias("pre_rank"))


@query()
def fuzzy_match(spark, sf_dir):
    """Each part name, its last letter lost, against all names."""
    n = names(spark, sf_dir)
    q = catalog.entries(n.withColumn("p_name", F.expr("substr(p_name, 1, length(p_name) - 1)")), "id", "p_name")
    return catalog.accepted(catalog.matched(q, catalog.entries(n, "id", "p_name")))


@query()
def fuzzy_barcode(spark, sf_dir):
    r = names(spark, sf_dir).select("id", text.normalized(F.col("p_name")).alias("norm"), F.lpad(F.col("id").cast("string"), 13, "4").alias("code"))
    return catalog.fuzzy_barcodes(r.select("id", F.concat("norm", F.lit(" new")).alias("norm")), r)


VOTE = f"""m AS (SELECT a.id % 20 AS track, a.id AS text_id, b.id AS name, count(*) / 20.0::DOUBLE AS score FROM t a JOIN t b USING (k) GROUP BY a.id, b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY text_id ORDER BY score DESC, name) rank FROM m), v AS (SELECT track, name, sum((score - 0.2) / sqrt(rank)) vote, count(*) support, max(score) best FROM r WHERE rank <= 3 AND score >= 0.2 GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY round(vote, 9) DESC, support DESC, best DESC, name) i FROM v)"""


@query(f"WITH {NAME_SQL}, {VOTE} SELECT track, name, round(vote, 6) AS vote, support FROM o WHERE i = 1")
def vote_decoder(spark, sf_dir):
    e = catalog.entries(names(spark, sf_dir), "id", "p_name")
    pairs = catalog.blocked(e, e, ("trigram",)).select((F.col("query_id") % 20).alias("track"), F.col("query_id").alias("text_id"), F.col("entry_id").alias("name"), (F.col("n_trigram") / 20.0).alias("score"))
    top = ordering.top_k(pairs, ["text_id"], [F.desc("score"), F.col("name")], 3)
    sums = elections.vote(top, ["track"], least=0.2)
    return sums.select("track", "name", F.round("vote", 6).alias("vote"), "support")

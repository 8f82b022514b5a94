"""Names of a track from all its texts: pools, the best match of a pool, and what is read beside names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import elect


def pool(before: Column, texts: Column, size: int = 12) -> Column:
    """The present text, then the first ``size`` of the track's texts that are not in it yet and not empty."""
    if size <= 0:
        return F.array(before)
    rest = F.filter(F.slice(F.coalesce(texts, F.array().cast("array<string>")), 1, size), lambda t: F.coalesce(t != "", F.lit(False)))
    return F.array_distinct(F.concat(F.array(before), rest))


def best_of_pool(matches: DataFrame, by: list[str]) -> DataFrame:
    """One match per group: accepted ones first, then score, margin, and the place in the pool.
    ``matches``: by, ordinal, accepted, score, margin, name."""
    return elect(matches, by, [F.col("accepted").cast("int"), "score", "margin", -F.col("ordinal")], ["name", "accepted", "score", "margin", "ordinal"])


def recovered(votes: DataFrame, matches: DataFrame, by: list[str]) -> DataFrame:
    """The vote's name where it is accepted, else the best match of the pool: by, name, accepted, decoder."""
    v = votes.where("accepted").select(*by, F.col("name").alias("voted"))
    out = best_of_pool(matches, by).join(v, by, "full_outer")
    voted = F.col("voted").isNotNull()
    name, ok = F.coalesce("voted", "name"), voted | F.coalesce("accepted", F.lit(False))
    return out.select(*by, name.alias("name"), ok.alias("accepted"), F.when(voted, "vote").otherwise("pool").alias("decoder"))


def tails(rows: DataFrame, by: list[str], enough: int = 12) -> DataFrame:
    """What a track's texts show beside the name.  ``rows``: by, ordinal, score, text, country, unit, glass.

    Texts are read by falling score (earlier first on ties) until country and unit are known and ``enough``
    distinct texts are read: the first country, the first unit, and the distinct texts so far.  Glass is
    looked for in all.  One row per group: country, unit, glass, texts.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "ordinal")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    shown = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    text = F.coalesce("text", F.lit(""))
    fresh = (text != "") & (F.row_number().over(Window.partitionBy(*by, "text").orderBy(F.desc("score"), "ordinal")) == 1)
    out = rows.withColumn("fresh", fresh).withColumn("at", F.row_number().over(order))
    known = lambda c: F.max(shown(c).isNotNull().cast("int")).over(upto)
    done = (known("country") + known("unit") == 2) & (F.sum(F.col("fresh").cast("int")).over(upto) >= enough)
    out = out.withColumn("done", done.cast("int"))
    out = out.withColumn("read", F.coalesce(F.lag("done").over(order), F.lit(0)) == 0)
    first = lambda c: F.coalesce(F.min_by(F.when(F.col("read"), shown(c)), F.when(F.col("read") & shown(c).isNotNull(), F.col("at"))), F.lit(""))
    texts = F.sort_array(F.collect_list(F.when(F.col("read") & F.col("fresh"), F.struct("at", "text"))))
    out = out.groupBy(*by).agg(first("country").alias("country"), first("unit").alias("unit"), F.max("glass").alias("glass"), texts.alias("texts"))
    return out.withColumn("texts", F.transform("texts", lambda t: t["text"]))


def entry_prices(promo: Column, regular: Column) -> Column:
    """Distinct prices of a catalogue entry that there are, the promotional one first."""
    return F.array_distinct(F.array_compact(F.array(promo, regular)))


def exact_codes(names: DataFrame, records: DataFrame) -> DataFrame:
    """The codes of all records with exactly the name: norm, codes (sorted, distinct).  An equi-join of sums."""
    codes = records.where("norm <> ''").groupBy("norm").agg(F.sort_array(F.collect_set("code")).alias("codes"))
    return names.join(codes, "norm")

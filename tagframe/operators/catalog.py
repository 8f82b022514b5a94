"""Matching names to a product catalogue: blocking, cheap ranking, full scores, barcodes."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from .ordering import margin, top_k

# What one shared key of a kind is worth in the cheap score.
KINDS = {"token": 4.0, "brand": 5.0, "unit": 3.0, "trigram": 0.05, "category": 1.0}
TAIL = ("росси", "россм", "росск", "росг", "россж", "герман", "итал", "испан")


def distinct_entries(rows: DataFrame, name: str, extra: list[str], ordinal: str) -> DataFrame:
    """Unlike (lower-case name, extra), the first of each; numbered in order of the lower-case name by ranges."""
    key = F.lower(F.trim(F.col(name)))
    keep = [c for c in rows.columns if c not in extra]
    picked = rows.where(F.trim(F.col(name)) != "").withColumn("_k", key).groupBy("_k", *extra).agg(F.min(F.struct(ordinal, *[c for c in keep if c != ordinal])).alias("_r"))
    return picked.select(*extra, "_r.*", F.col("_k").alias("sort_name"))


def entries(rows: DataFrame, id_col: str, name_col: str, unicode: bool = False) -> DataFrame:
    """id, name, norm and the key sets of each name."""
    name = text.nfkc(F.col(name_col)) if unicode else F.col(name_col)
    out = rows.select(F.col(id_col).alias("id"), F.col(name_col).alias("name"), name.alias("_n"))
    return out.select(
        "id", "name", text.normalized(F.col("_n")).alias("norm"), text.content_tokens(F.col("_n")).alias("tokens"), text.brand_tokens(F.col("_n")).alias("brands"),
        text.units(F.col("_n")).alias("units"), text.trigrams(F.col("_n")).alias("trigrams"), text.category(text.content_tokens(F.col("_n"))).alias("category"),
    )


def keyed(rows: DataFrame, kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """(id, kind, key): the inverted index."""
    sets = {"token": F.col("tokens"), "brand": F.col("brands"), "unit": F.col("units"), "trigram": F.col("trigrams"), "category": F.when(F.col("category") != "", F.array("category")).otherwise(F.array().cast("array<string>"))}

    def tagged(kind: str) -> Column:
        return F.transform(sets[kind], lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("key")))

    every = F.concat(*map(tagged, kinds))
    return rows.select("id", F.explode(every).alias("e")).select("id", "e.kind", "e.key")


def blocked(queries: DataFrame, catalog: DataFrame, kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """(query_id, entry_id, cheap): pairs that share a key, with their cheap score.

    The rows of the equi-join are the members of the set intersections, so counting them by kind is
    the score.  Counts are integers, weighted once at the end.
    """
    q = keyed(queries, kinds).withColumnRenamed("id", "query_id")
    e = keyed(catalog, kinds).withColumnRenamed("id", "entry_id")
    counts = q.join(e, ["kind", "key"]).groupBy("query_id", "entry_id").agg(*(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in kinds))
    return counts.withColumn("cheap", sum((F.col(f"n_{k}") * KINDS[k] for k in kinds[1:]), F.col(f"n_{kinds[0]}") * KINDS[kinds[0]]))


def preselect(pairs: DataFrame, k: int = 900) -> DataFrame:
    return top_k(pairs, ["query_id"], [F.desc("cheap"), F.col("entry_id")], k, "pre_rank")


def padded(pairs: DataFrame, queries: DataFrame, catalog: DataFrame, k: int = 900) -> DataFrame:
    """Where fewer than k entries are blocked, unblocked ones fill up in order of their ids.

    The first k entries by id always suffice, so only those (k rows) meet the queries that lack some.
    """
    have = queries.select(F.col("id").alias("query_id")).join(pairs.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")), "query_id", "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < k)
    first = catalog.orderBy("id").limit(k).select(F.col("id").alias("entry_id"))
    more = have.crossJoin(F.broadcast(first)).join(pairs.select("query_id", "entry_id"), ["query_id", "entry_id"], "left_anti")
    more = top_k(more, ["query_id"], [F.col("entry_id")], k, "_i").where(F.col("_i") <= k - F.col("n"))
    return pairs.select("query_id", "entry_id", "cheap").unionByName(more.select("query_id", "entry_id", F.lit(0.0).alias("cheap")))


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


@F.pandas_udf(T.DoubleType())
def text_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a, b)])


@F.pandas_udf(T.DoubleType())
def token_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Mean over the query's tokens of the best ratio to the entry's tokens."""
    known: dict[tuple[str, str], float] = {}

    def best(x: str, ys) -> float:
        found = 0.0
        for y in ys:
            if (x, y) not in known:
                known[x, y] = ratio(x, y)
            found = max(found, known[x, y])
        return found

    return pd.Series([sum(best(x, ys) for x in xs) / len(xs) if len(xs) and len(ys) else 0.0 for xs, ys in zip(a, b)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def unexplained(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    """Query tokens of five characters or more, not a tail or with digits, like no entry token."""

    def one(xs, ys, t):
        long = [x for x in sorted(xs) if len(x) >= 5 and not any(c.isdigit() for c in x) and not x.startswith(TAIL)]
        return [x for x in long if max((ratio(x, y) for y in ys), default=0.0) < t]

    return pd.Series([one(*r) for r in zip(a, b, least)])


def full_score(q: str = "q", e: str = "e") -> Column:
    """Of struct columns q and e with the sets of entries(), and columns fuzzy and chars."""
    c = lambda side, f: F.col(f"{side}.{f}")
    n = lambda x: F.size(x).cast("double")
    common = n(F.array_intersect(c(q, "tokens"), c(e, "tokens")))
    one = F.lit(1.0)
    recall, precision = common / F.greatest(one, n(c(q, "tokens"))), common / F.greatest(one, n(c(e, "tokens")))
    smaller = common / F.greatest(one, F.least(n(c(q, "tokens")), n(c(e, "tokens"))))
    tri = n(F.array_intersect(c(q, "trigrams"), c(e, "trigrams"))) / F.greatest(one, n(F.array_union(c(q, "trigrams"), c(e, "trigrams"))))
    both = lambda f: (F.size(c(q, f)) > 0) & (F.size(c(e, f)) > 0)
    brand = F.when(F.arrays_overlap(c(q, "brands"), c(e, "brands")), 0.10).when(both("brands"), -0.04).otherwise(0.0)
    unit = F.when(F.arrays_overlap(c(q, "units"), c(e, "units")), 0.10).when(both("units"), -0.13).otherwise(0.0)
    kind = F.when((c(q, "category") == "") | (c(e, "category") == ""), 0.0).when(c(q, "category") == c(e, "category"), 0.07).otherwise(-0.08)
    score = 0.24 * recall + 0.13 * precision + 0.10 * smaller + 0.18 * F.col("fuzzy") + 0.18 * F.col("chars") + 0.07 * tri + brand + unit + kind
    return F.when((c(q, "norm") == "") | (c(e, "norm") == ""), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def matched(queries: DataFrame, catalog: DataFrame, *, preselected: int = 900, keep: int = 5, kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """The best entries of each query: query_id, entry_id, name, score, rank.  Give distinct queries.

    Each query meets ``preselected`` entries, or all of a smaller catalogue: blocked ones first, then others by id.
    """
    pairs = preselect(blocked(queries, catalog, kinds), preselected)
    pairs = preselect(padded(pairs, queries, catalog, preselected), preselected)
    side = lambda df, x: df.select(F.col("id").alias(f"{'query' if x == 'q' else 'entry'}_id"), F.struct("name", "norm", "tokens", "brands", "units", "trigrams", "category").alias(x))
    both = pairs.join(side(queries, "q"), "query_id").join(side(catalog, "e"), "entry_id")
    both = both.withColumn("fuzzy", token_ratio(F.col("q.tokens"), F.col("e.tokens"))).withColumn("chars", text_ratio(F.col("q.norm"), F.col("e.norm")))
    both = both.withColumn("score", F.bround(full_score(), 6))
    best = top_k(both, ["query_id"], [F.desc("score"), F.col("pre_rank")], keep)
    return best.select("query_id", "entry_id", F.col("e.name").alias("name"), "score", "rank", F.col("q.tokens").alias("query_tokens"), F.col("e.tokens").alias("entry_tokens"))


def accepted(best: DataFrame, *, accept: float = 0.65, least_margin: float = 0.035, strong: float = 1.01, explain: float = 0.65) -> DataFrame:
    """One row per query: the best match, the margin to the next, and the reason of the decision."""
    out = margin(best, ["query_id"], "score", [F.col("rank")])
    left = unexplained(F.col("query_tokens"), F.col("entry_tokens"), F.lit(explain))
    out = out.withColumn("left", left)
    reason = F.when(F.col("score") >= strong, "accepted").when(F.col("score") < accept, "below_threshold").when(F.col("margin") < least_margin, "low_margin")
    reason = reason.when(F.size("left") > 0, F.concat(F.lit("unexplained_ocr_token:"), F.array_join("left", ","))).otherwise("accepted")
    return out.withColumn("reason", reason).withColumn("accepted", F.col("reason") == "accepted").drop("left", "query_tokens", "entry_tokens", "rank")


def fuzzy_barcodes(queries: DataFrame, records: DataFrame, least: float = 0.72, close: float = 0.02) -> DataFrame:
    """Records whose name is like the query's: query_id, code, score.  Both: id, norm (and code).

    Only pairs that share enough tokens are scored: an equi-join on tokens, then the count.
    """
    toks = lambda df: df.withColumn("tokens", F.array_distinct(F.filter(F.split("norm", " "), lambda t: F.length(t) >= 2)))
    q, r = toks(queries), toks(records)
    pairs = q.select(F.col("id").alias("query_id"), F.explode("tokens").alias("t")).join(r.select(F.col("id").alias("entry_id"), F.explode("tokens").alias("t")), "t").groupBy("query_id", "entry_id").agg(F.count(F.lit(1)).alias("n"))
    both = pairs.join(q.select(F.col("id").alias("query_id"), F.col("norm").alias("qn"), F.size("tokens").alias("qs")), "query_id").join(r.select(F.col("id").alias("entry_id"), F.col("norm").alias("rn"), F.size("tokens").alias("rs"), "code"), "entry_id")
    both = both.where(F.col("n") >= F.greatest(F.lit(2), F.floor(F.least("qs", "rs") / 2)))
    both = both.withColumn("score", 0.50 * text_ratio(F.col("qn"), F.col("rn")) + 0.30 * F.col("n") / F.col("qs") + 0.20 * F.col("n") / F.col("rs")).where(F.col("score") >= least)
    top = both.groupBy("query_id").agg(F.max("score").alias("top"))
    return both.join(top, "query_id").where(F.col("score") >= F.col("top") - close).select("query_id", "entry_id", "code", "score")

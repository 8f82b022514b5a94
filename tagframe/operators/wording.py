"""Word order of catalogue names as the texts of a tag show it.

A name's words are placed in a text by likeness (the only step in Python, as Spark lacks this ratio);
filling, ordering and the choice of the text are expressions.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from .ordering import elect

# Fixed values of the ordering rule.
LIKE, LEAST_WORDS, LEAST_MATCHED, LEAST_SHARE, GAIN = 0.64, 4, 3, 0.45, 0.25


def parts(c: Column) -> Column:
    """Runs of letters and digits of the normal form, in order."""
    return F.filter(F.split(text.normalized(c, unicode=True), " "), lambda t: t != "")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def places(words: pd.Series, tokens: pd.Series) -> pd.Series:
    """Of each word (a list of its parts) the place of the token most like one of its parts; the first
    such pair on ties, null below the least likeness."""

    def place(own, tokens) -> float | None:
        at, top = None, 0.0
        for part in own:
            for i, t in enumerate(tokens) if len(part) > 1 else ():
                like = SequenceMatcher(None, part, t).ratio()
                if like > top:
                    at, top = float(i), like
        return at if top >= LIKE else None

    return pd.Series([None if ws is None or ts is None else [place(w, ts) for w in ws] for ws, ts in zip(words, tokens)])


def filled(p: Column) -> Column:
    """array<double> without nulls: between known places by a line, beyond them 0.01 a step, and the
    index where none is known."""
    at = F.filter(F.transform(p, lambda x, i: F.when(x.isNotNull(), i)), lambda i: i.isNotNull())

    def one(x: Column, i: Column) -> Column:
        before, after = F.array_max(F.filter(at, lambda k: k < i)), F.array_min(F.filter(at, lambda k: k > i))
        a, b = F.get(p, before), F.get(p, after)
        line = a + (b - a) * ((i - before) / (after - before))
        return F.coalesce(x, line, a + 0.01 * (i - before), b - 0.01 * (after - i), i.cast("double"))

    return F.transform(p, one)


def _matched(p: Column) -> Column:
    return F.size(F.filter(p, lambda x: x.isNotNull()))


def _usable(p: Column) -> Column:
    n, m = F.size(p), _matched(p)
    return (n >= LEAST_WORDS) & (m >= LEAST_MATCHED) & (m / n >= LEAST_SHARE)


def reordered(base: Column, words: Column, p: Column) -> Column:
    """The words in the order of their places, or ``base`` as it is where too few are placed."""
    order = F.array_sort(F.zip_with(filled(p), F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda at, w: F.struct(at.alias("at"), w["i"].alias("i"), w["w"].alias("w"))))
    return F.when(_usable(p), F.array_join(F.transform(order, lambda x: x["w"]), " ")).otherwise(base)


def quality(p: Column, tokens: Column) -> Column:
    """How well a text shows the order: words placed, their share, distinct places, less unused tokens."""
    m = _matched(p)
    distinct = F.size(F.array_distinct(F.filter(p, lambda x: x.isNotNull())))
    score = m + m / F.size(p) + distinct * 0.05 - F.greatest(F.lit(0), F.size(tokens) - m) * 0.015
    return F.when(_usable(p) & (F.size(tokens) > 0), score).otherwise(0.0)


def ordered(names: DataFrame, sources: DataFrame, by: list[str]) -> DataFrame:
    """Names with their words in the order of the best text: by, name, source, quality.

    ``names``: by, base (one row per key); ``sources``: by, ordinal, text; ordinal 0 is the text that was
    matched.  Another text is taken only if its quality exceeds that one's by the gain; the longer, then
    the earlier one wins ties.  Names without texts stay as they are.
    """
    words = F.filter(F.split(F.trim(F.coalesce("base", F.lit(""))), r"(?U)\s+"), lambda w: w != "")
    n = names.select(*by, "base", words.alias("words"))
    s = sources.select(*by, "ordinal", text.collapse(F.col("text")).alias("source")).where("source <> ''")
    both = n.join(s, by).withColumn("tokens", parts(F.col("source")))
    both = both.withColumn("own", F.transform("words", lambda w: F.filter(F.split(text.normalized(w), " "), lambda t: t != "")))
    both = both.withColumn("p", places(F.col("own"), F.col("tokens"))).withColumn("quality", quality(F.col("p"), F.col("tokens")))
    keep = ["base", "words", "p", "source", "quality"]
    best = elect(both, by, ["quality", F.length("source"), -F.col("ordinal")], keep)
    first = both.where("ordinal = 0").select(*by, *(F.col(c).alias(f"f_{c}") for c in keep))
    out = n.select(*by, "base").join(best.drop("base"), by, "left").join(first, by, "left")
    take = F.coalesce(F.col("quality") >= F.coalesce("f_quality", F.lit(0.0)) + GAIN, F.lit(False))
    pick = lambda c: F.when(take, F.col(c)).otherwise(F.col(f"f_{c}"))
    name = F.coalesce(reordered(F.col("base"), pick("words"), pick("p")), F.col("base"))
    return out.select(*by, name.alias("name"), pick("source").alias("source"), F.coalesce(pick("quality"), F.lit(0.0)).alias("quality"))

"""From field candidates in long form to one value per field, by scored consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import extract, pricing
from ..functions.binding import let
from ..functions.numparse import candidate_price, valid_price
from ..sources.tables import written
from .ordering import elect, top_k

PRICES = ("price_default", "price_card", "price_discount")
CANDIDATE = ["video_id", "track_id", "field", "value", "score", "confidence", "valid", "engine", "zone", "image_kind", "timestamp_ms", "source_text", "ordinal"]


def _support(atoms: DataFrame, by: list[str], bonus: Column) -> DataFrame:
    """Best atom of the best value.  Atoms: value, atom_score, close, marker, ordinal, atom, score.

    First each value's support and best atom, then the best value: both are grouped maxima, which are
    summed up before the shuffle.
    """
    pick = F.max(F.struct("atom_score", (-F.col("ordinal")).alias("o"), (-F.col("atom")).alias("a"), "score")).alias("pick")
    count = lambda c: F.sum(F.col(c).cast("int"))
    values = atoms.groupBy(*by, "value").agg(
        pick, F.max("atom_score").alias("top"), F.count(F.lit(1)).alias("n"), F.size(F.collect_set("timestamp_ms")).alias("times"),
        count("close").alias("near_n"), count("marker").alias("marks"), F.min(F.struct("ordinal", "atom")).alias("seen"),
    )
    values = values.withColumn("value_score", bonus).withColumns({"score": F.col("pick.score"), "atom_score": F.col("pick.atom_score"), "ordinal": -F.col("pick.o")})
    keep = [c for c in ("value", "value_score", "n", "score", "atom_score", "ordinal") if c not in by]
    return elect(values, by, ["value_score", -F.col("seen.ordinal"), -F.col("seen.atom")], keep).withColumnRenamed("n", "support")


def consensus_price(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows``: valid candidates of one price field with columns of CANDIDATE and selected_ms,
    discount_percent, card_value.  One row per group: value, atom_score, value_score, support."""
    card = F.col("field").isin("price_card", "price_discount")
    near = extract.time_bonus(F.col("timestamp_ms").cast("string"), F.col("selected_ms").cast("string"))
    mark = extract.marked(F.col("source_text"))
    rows = rows.withColumn("near", near).withColumn("marker", mark)
    common = F.col("score") + F.col("near.bonus") + F.when(F.col("image_kind") == "tight_enhanced", 0.02).otherwise(0.0) + F.when(F.col("engine") == "rapidocr", 0.02).otherwise(0.0) + F.when(mark, 0.08).otherwise(0.0)
    own = candidate_price(F.col("value"))
    seen = F.transform(extract.price_atoms(F.col("source_text")), lambda a: F.struct(a["value"].alias("raw"), a["kind"].alias("kind"), F.lit(False).alias("dotted")))
    every = F.concat(seen, F.array(F.struct(own["value"].alias("raw"), F.lit("parser_value").alias("kind"), own["dotted"].alias("dotted"))))
    kept = [c for c in rows.columns if c != "value"]
    atoms = rows.withColumn("common", common).select(*kept, "common", F.posexplode_outer(every).alias("atom", "a"))
    value = F.bround(pricing.shelf(F.col("a.raw")), 2)
    atoms = atoms.where("a.raw is not null").withColumn("value", value)
    late = (F.col("field") == "price_default") & F.coalesce(F.col("value") <= F.col("card_value") * 1.02, F.lit(False))
    atoms = atoms.where(~extract.rejected_atom(F.col("value"), F.col("source_text"), F.col("a.dotted"), card) & ~late)
    fragment = F.when(card, F.coalesce(extract.fragment_penalty(F.col("value"), F.col("source_text"), F.col("a.kind"), F.col("discount_percent")), F.lit(0.0))).otherwise(0.0)
    parser = (
        F.lit(0.0)
        - F.when(F.col("a.dotted") & card & (F.abs(F.col("a.raw") - F.col("value")) > 0.02), 0.28).otherwise(0.0)
        - F.when((extract.longest_digits(F.col("source_text")) >= 5) & ~F.col("source_text").rlike(r"[°º]|\s99(?!\d)"), 0.45).otherwise(0.0)
        - F.when(F.col("value") > 5000, 1.0).when(F.col("value") > 3000, 0.35).otherwise(0.0)
    )
    kind = F.when(F.col("a.kind") == "source_marker", F.lit(0.44)).when(F.col("a.kind") == "source_99", F.lit(0.34)).otherwise(parser)
    atoms = atoms.withColumn("atom_score", F.col("common") + kind - fragment).withColumn("close", F.col("near.diff") <= 500)
    bonus = F.col("top") + F.least("n", F.lit(8)) * 0.07 + F.least("times", F.lit(4)) * 0.05 + F.least("near_n", F.lit(4)) * 0.10 + F.least("marks", F.lit(4)) * 0.04
    return _support(atoms.drop("near", "a", "common"), by, bonus)


def consensus_discount(rows: DataFrame, by: list[str]) -> DataFrame:
    parts = let(extract.discount_parts(F.col("source_text")), lambda a: F.when(a["percent"].isNotNull(), a).otherwise(extract.discount_parts(F.col("value"))))
    rows = rows.withColumn("d", parts).where("d.percent is not null")
    near = let(extract.time_bonus(F.col("timestamp_ms").cast("string"), F.col("selected_ms").cast("string")), lambda x: x)
    rows = rows.withColumn("near", near)
    near = F.col("near")
    score = F.col("score") + near["bonus"] - F.col("d.penalty") - extract.implausible_discount(F.col("d.percent")) + F.when(F.col("image_kind") == "tight_enhanced", 0.05).otherwise(0.0)
    atoms = rows.withColumn("atom_score", score).withColumn("close", near["diff"] <= 500).withColumn("marker", F.lit(False)).withColumn("atom", F.lit(0)).withColumn("value", -F.col("d.percent")).drop("d", "near")
    return _support(atoms, by, F.col("top") + F.least("n", F.lit(6)) * 0.09 + F.least("near_n", F.lit(4)) * 0.10)


def best_candidates(candidates: DataFrame, template: DataFrame) -> DataFrame:
    """video_id, track_id, field, value (string), score for each field with a choice.

    ``template``: video_id, track_id, selected_ms.  The discount is elected first, then the card
    price with it, then the others with both.
    """
    by = ["video_id", "track_id"]
    rows = candidates.join(template.select(*by, "selected_ms"), by)
    # One row per track; each is used several times below.
    discount = written(consensus_discount(rows.where("field = 'discount_amount' and valid"), by).select(*by, F.col("value").alias("discount_percent"), F.col("score").alias("discount_score")), "discounts")
    prices = rows.where(F.col("field").isin(*PRICES) & F.col("valid") & valid_price(F.col("value"))).join(discount.select(*by, F.abs("discount_percent").alias("discount_percent")), by, "left")
    card = written(consensus_price(prices.where("field = 'price_card'").withColumn("card_value", F.lit(None).cast("double")), [*by, "field"]), "cards")
    others = prices.where("field <> 'price_card'").join(card.select(*by, F.col("value").alias("card_value")), by, "left")
    priced = card.select(*by, "field", "value", "score").union(consensus_price(others, [*by, "field"]).select(*by, "field", "value", "score"))
    # A price field without any valid price falls back to the best of all its candidates.
    plain = rows.where(F.col("field").isin(*PRICES)).join(prices.select(*by, "field").distinct(), [*by, "field"], "left_anti")
    codes = rows.where((F.col("field") == "barcode") & F.col("valid") & (F.length(F.regexp_replace("value", r"\D", "")) == 13))
    rest = rows.where(~F.col("field").isin(*PRICES, "barcode", "discount_amount"))
    simple = elect(plain.unionByName(codes).unionByName(rest), [*by, "field"], ["score", -F.col("ordinal")], ["value", "score"])
    shown = discount.select(*by, F.lit("discount_amount").alias("field"), F.concat(F.col("discount_percent").cast("string"), F.lit("%")).alias("value"), F.col("discount_score").alias("score"))
    return simple.unionByName(priced.withColumn("value", F.format_string("%.2f", "value"))).unionByName(shown)


def submission(candidates: DataFrame, template: DataFrame, fields: list[str]) -> DataFrame:
    """The template's rows with a column per field; a missing default price is inferred from card
    price and discount, a missing discount from the prices."""
    by = ["video_id", "track_id"]
    wide = best_candidates(candidates, template).groupBy(*by).pivot("field", fields).agg(F.first("value"))
    out = template.join(wide, by, "left")
    for f in ("price_card", "price_discount"):
        if f in fields:
            out = out.withColumn(f, F.when(F.col(f).rlike(r"^\d{3,4}$"), F.concat(F.col(f), F.lit(".99"))).otherwise(F.col(f)))
    if {"price_default", "price_card", "discount_amount"} <= set(fields):
        card, percent = F.col("price_card").try_cast("double"), pricing.percent(F.col("discount_amount"))
        out = out.withColumn("price_default", F.coalesce("price_default", F.format_string("%.2f", pricing.inferred_default(card, percent))))
        guess = pricing.inferred_discount(card, F.col("price_default").try_cast("double"))
        out = out.withColumn("discount_amount", F.coalesce("discount_amount", F.concat(guess.cast("string"), F.lit("%"))))
    return out


def name_election(rows: DataFrame, by: list[str]) -> DataFrame:
    """By equal value: the best score plus .045 for each of at most five supporters."""
    sums = rows.groupBy(*by, "value").agg(F.max("score").alias("top"), F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("seen"))
    return elect(sums.withColumn("value_score", F.col("top") + F.least("n", F.lit(5)) * 0.045), by, ["value_score", -F.col("seen")], ["value", "value_score", "n"])


def first_tier(rows: DataFrame, by: list[str], tiers: list[Column]) -> DataFrame:
    """Rows of the first tier that any row of the group is in."""
    n = F.lit(len(tiers))
    for i, t in reversed(list(enumerate(tiers))):
        n = F.when(t, F.lit(i)).otherwise(n)
    rows = rows.withColumn("tier", n)
    return rows.withColumn("_least", F.min("tier").over(Window.partitionBy(*by))).where("tier = _least").drop("_least")


def quality_choice(rows: DataFrame, quality: DataFrame, by: list[str], policy: str = "weighted", weight: float = 0.05) -> DataFrame:
    """Names by score and crop quality.  Quality is looked up by (group, rank, variant), else (group, rank), else 0."""
    fine = quality.groupBy(*by, "rank", "variant").agg(F.max("quality").alias("fine"))
    coarse = quality.groupBy(*by, "rank").agg(F.max("quality").alias("coarse"))
    rows = rows.join(fine, [*by, "rank", "variant"], "left").join(coarse, [*by, "rank"], "left").withColumn("quality", F.coalesce("fine", "coarse", F.lit(0.0)))
    keys = {
        "ocr_best": [F.col("score")],
        "rank_only": [F.coalesce("coarse", F.lit(0.0)), F.col("score")],
        "variant_only": [F.coalesce("fine", F.lit(0.0)), F.col("score")],
        "weighted": [F.col("score") + weight * F.col("quality")],
        "weighted_guarded": [F.when(F.col("quality") > 0, F.col("score") + weight * F.col("quality")).otherwise(F.col("score"))],
    }
    return elect(rows, by, [*keys[policy], -F.col("ordinal")], ["value", "score", "quality", "rank", "variant"])


def vote(matches: DataFrame, by: list[str], least: float = 0.50, support: int = 2, accept: float = 0.20, margin: float = 0.05) -> DataFrame:
    """Votes of pooled texts' top matches: (score - least) / sqrt(rank) summed by name.

    ``matches``: by, text ordinal, name, score, rank.  One row per group: name, vote, support, best,
    second_vote, accepted.
    """
    sums = matches.where(F.col("score") >= least).groupBy(*by, "name").agg(F.round(F.sum((F.col("score") - least) / F.sqrt("rank")), 9).alias("vote"), F.count(F.lit(1)).alias("support"), F.max("score").alias("best"))
    ranked = top_k(sums, by, [F.desc("vote"), F.desc("support"), F.desc("best"), F.col("name")], 2)
    first = ranked.where("rank = 1").drop("rank")
    second = ranked.where("rank = 2").select(*by, F.col("vote").alias("second_vote"))
    out = first.join(second, by, "left").withColumn("second_vote", F.coalesce("second_vote", F.lit(0.0)))
    return out.withColumn("accepted", (F.col("support") >= support) & (F.col("vote") >= accept) & (F.col("vote") - F.col("second_vote") >= margin))

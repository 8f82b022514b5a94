"""Declarative repair with an audit trail.

A rule sets a field to a value under a guard.  Rules run in order; a change that takes effect
appends struct(field, old, new, source) to the audit.  Values are strings, as in the final table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import missing, numparse, pricing

TOGETHER = 1  # rules in one stage of generated code
AUDIT = "array<struct<field:string,old:string,new:string,source:string>>"


@dataclass(frozen=True)
class Rule:
    field: str
    value: Column
    source: str
    guard: Column | None = None
    overwrite: bool = True
    clears: bool = False


def applied(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Each rule sees what the ones before it left; a field that df lacks is passed over.

    The number of changes so far is observed after every few rules (metric ``rules``): this also ends a
    stage of generated code, which would otherwise hold all rules and be too large to compile.
    """
    out = df if "audit" in df.columns else df.withColumn("audit", F.array().cast(AUDIT))
    rules = [r for r in rules if r.field in df.columns]
    for k, r in enumerate(rules):
        if k % TOGETHER == 0:
            out = out.observe(f"rules {uuid.uuid4().hex}", F.sum(F.size("audit")).alias("changes"))
        out = out.withColumn("_old", F.coalesce(F.col(r.field).cast("string"), F.lit(""))).withColumn("_new", F.lit("") if r.clears else r.value)
        old, new = F.col("_old"), F.col("_new")
        go = F.coalesce(r.guard, F.lit(True)) if r.guard is not None else F.lit(True)
        go = go & ~missing.core(old) if r.clears else go & ~missing.core(new) & (old != new)
        if not r.overwrite:
            go = go & missing.core(old)
        go = F.coalesce(go, F.lit(False))
        note = F.array(F.struct(F.lit(r.field).alias("field"), old.alias("old"), new.alias("new"), F.lit(r.source).alias("source")))
        out = out.withColumn("_go", go).withColumn("audit", F.when(F.col("_go"), F.concat("audit", note)).otherwise(F.col("audit"))).withColumn(r.field, F.when(F.col("_go"), new).otherwise(F.col(r.field))).drop("_go", "_old", "_new")
    return out


def changes(df: DataFrame, keys: list[str]) -> DataFrame:
    # The outer form: the plain one's inferred filter on the audit would repeat all rules below them.
    return df.select(*keys, F.posexplode_outer("audit").alias("step", "a")).where("a is not null").select(*keys, "step", "a.*")


def _price(field: str) -> Column:
    return numparse.rule_price(F.col(field))


def _money(v: Column) -> Column:
    return F.format_string("%.2f", v)


def _dotted(field: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(field).cast("string"), F.lit("")), ",", ".").rlike(r"\d+\.\d+")


def _clear(field: str, source: str, guard: Column) -> list[Rule]:
    """A price and what was derived from it."""
    twins = {"price_default": ["price1_qr", "price2_qr"], "price_card": ["price4_qr"]}[field]
    return [Rule(f, F.lit(""), source if f == field else f"{source}_qr", guard, clears=True) for f in [*reversed(twins), field]]


NO_VALUE = ("price_discount", "wholesale_level_1_count", "wholesale_level_1_price", "wholesale_level_2_count", "wholesale_level_2_price", "action_price_qr", "action_code_qr")


def defaults(colour: str = "red") -> list[Rule]:
    return [*(Rule(f, F.lit(missing.ABSENT), "required_absent_value", overwrite=False) for f in NO_VALUE), Rule("color", F.lit(colour), "tag_color_default", overwrite=False)]


def cents_repair() -> list[Rule]:
    """From catalogue prices with the same whole number (columns catalog_regular, catalog_promo,
    catalog_score, catalog_accepted), and between shelf and decoded prices."""
    whole = lambda a, b: (F.floor(a) == F.floor(b)) & F.abs(a - b).between(0.005, 0.99)
    out = [Rule("price_default", _money(numparse.rule_price(F.col("catalog_regular"))), "catalog_regular_price_integer_guard", F.col("catalog_accepted") & (F.floor(_price("price_default")) == F.floor(numparse.rule_price(F.col("catalog_regular")))))]
    for field, other, name in (("price_default", "catalog_regular", "regular"), ("price_card", "catalog_promo", "promo")):
        v = numparse.rule_price(F.col(other))
        guard = (numparse.rule_float(F.col("catalog_score")) >= 0.45) & whole(_price(field), v) & pricing.needs_cents(F.col(field), _price(field))
        out.append(Rule(field, _money(v), f"catalog_{name}_price_cent_repair_same_integer", guard))
    for a, b in (("price_default", "price1_qr"), ("price_card", "price4_qr")):
        na, nb = (pricing.needs_cents(F.col(f), _price(f)) for f in (a, b))
        source = f"{a}_{b}_cent_consistency"
        out += [Rule(a, _money(_price(b)), source, whole(_price(a), _price(b)) & na & ~nb), Rule(b, _money(_price(a)), source, whole(_price(a), _price(b)) & nb & ~na)]
    return out


def sanity() -> list[Rule]:
    """Default and card price against the discount, then against each other, then against their ranges.

    Each step's guards name what the step before it left, so they are columns of the row as it was
    when the step began: see ``with_sanity``.
    """
    f, d, c = F.col("_factor"), F.col("_default"), F.col("_card")
    both = f.isNotNull() & d.isNotNull() & c.isNotNull()
    off = (d <= c * 1.02) | (c > d * 1.25) | (F.greatest(d, c) / F.greatest(F.lit(1.0), F.least(d, c)) >= 4) | (F.abs(c - d * f) / F.greatest(F.lit(1.0), d * f) > 0.35) | (d > 20000)
    sane = c.between(5, 9999)
    better = F.col("_better")
    return [
        Rule("price_card", _money(c), "price_card_shelf_cents", both & sane), *_clear("price_card", "price_card_out_of_range_removed", both & ~sane),
        Rule("price_default", _money(better), "discount_relation_default_repair", both & sane & off & better.between(5, 20000)),
        *_clear("price_default", "price_default_gross_outlier_removed", both & sane & off & ~better.between(5, 20000)),
        Rule("price_default", _money(d), "price_default_shelf_cents", both & sane & ~off),
    ]


def without_discount() -> list[Rule]:
    d, c = F.col("_default"), F.col("_card")
    tenth = F.col("_tenth")
    both = F.col("_factor").isNull() & d.isNotNull() & c.isNotNull()
    big = (d > c * 4) & ~(c > d * 1.5)
    fits = tenth.between(c, c * 2.5)
    return [*_clear("price_default", "price_default_gross_outlier_removed", both & ((c > d * 1.5) | (big & ~fits))), Rule("price_default", _money(tenth), "price_default_decimal_shift_repair", both & big & fits)]


def ranges() -> list[Rule]:
    d, c = F.col("_default"), F.col("_card")
    return [
        Rule("price_default", _money(d), "price_default_shelf_cents", d.between(5, 20000)), *_clear("price_default", "price_default_out_of_range_removed", ~d.between(5, 20000)),
        Rule("price_card", _money(c), "price_card_99_cents", c.between(5, 9999)), *_clear("price_card", "price_card_out_of_range_removed", ~c.between(5, 9999)),
    ]


def with_sanity(df: DataFrame) -> DataFrame:
    out = df
    for step in (sanity, without_discount, ranges):
        out = out.withColumn("_factor", pricing.factor(pricing.percent(F.col("discount_amount"))))
        out = out.withColumn("_read", _price("price_default")).withColumn("_card", pricing.shelf(_price("price_card")))
        out = out.withColumn("_default", pricing.regular(F.col("_read"), _dotted("price_default"))).withColumn("_better", pricing.closest(F.col("_card") / F.col("_factor")))
        out = out.withColumn("_tenth", pricing.regular(F.col("_default") / 10, F.lit(True)))
        out = applied(out, step()).drop("_factor", "_read", "_default", "_card", "_better", "_tenth")
    return out


def derived_qr(overwrite: bool = True) -> list[Rule]:
    d, c = _price("price_default"), _price("price_card")
    whole = F.trim(F.col("price_default")).rlike(r"^\d+$")
    return [Rule("price1_qr", _money(d), "qr_from_price_default", d.isNotNull(), overwrite), Rule("price2_qr", _money(pricing.second_qr(d, whole)), "qr_price2_from_95pct_default", d.isNotNull(), overwrite), Rule("price4_qr", _money(c), "qr_from_price_card", c.isNotNull(), overwrite)]


def barcodes(overwrite: bool = True) -> list[Rule]:
    """From column catalog_barcode; then each of the two columns fills the other."""
    code = F.col("catalog_barcode")
    return [
        Rule("barcode", code, "accepted_catalog_code_as_barcode", code.rlike(r"^\d+$"), overwrite), Rule("qr_code_barcode", code, "accepted_catalog_code_as_qr_barcode", code.rlike(r"^\d+$"), overwrite),
        Rule("qr_code_barcode", F.col("barcode"), "qr_barcode_from_barcode", overwrite=False), Rule("barcode", F.col("qr_code_barcode"), "barcode_from_qr_barcode", overwrite=False),
    ]


def sku(overwrite: bool = False, mapped: bool = True) -> list[Rule]:
    prefix = pricing.sku_prefix(F.lower(F.translate("catalog_name", "ё", "е"))) if mapped else F.lit("370204")
    return [Rule("id_sku", F.concat(prefix, F.col("catalog_id")), "accepted_catalog_id_prefix_map" if mapped else "accepted_catalog_id", F.col("catalog_accepted") & F.col("catalog_id").rlike(r"^\d+$"), overwrite)]


def qr_priority(fields: tuple[str, ...], prefix: str = "qr_") -> list[Rule]:
    """Decoded values (columns ``prefix`` + field) over all others; also barcode and both prices."""
    more = (("barcode", "qr_code_barcode"), ("price_default", "price1_qr"), ("price_card", "price4_qr"))
    return [Rule(f, F.col(prefix + v), "qr_priority") for f, v in (*((x, x) for x in fields), *more)]

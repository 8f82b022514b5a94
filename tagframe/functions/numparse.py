"""Nine number parsers, deliberately different; each belongs to its stage.  All give null on failure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import missing


def _first(text: Column, pattern: str) -> Column:
    found = F.regexp_extract(text, pattern, 0)
    return F.when(found != "", found.try_cast("double"))


def _dotted(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), ",", ".")


def dedup_price(card: Column, qr: Column) -> Column:
    """Card price, else the decoded one; the whole text must parse; half-even to two places."""
    raw = F.when(missing.dedup_value(card) != "", missing.dedup_value(card)).otherwise(missing.dedup_value(qr))
    value = F.regexp_replace(raw, ",", ".").try_cast("decimal(20,8)")
    return F.bround(value, 2).cast("decimal(12,2)")


def dedup_float(c: Column) -> Column:
    return F.trim(_dotted(c)).try_cast("double")


def rule_price(c: Column) -> Column:
    """Spaces dropped; the first number with two decimals at most."""
    text = F.regexp_replace(_dotted(c), "[\\u00a0 ]", "")
    return F.when(~missing.core(c) & (F.lower(F.trim(c.cast("string"))) != missing.ABSENT), _first(text, r"-?\d+(?:\.\d{1,2})?"))


def rule_float(c: Column) -> Column:
    return F.when(~missing.core(c), _first(F.regexp_replace(_dotted(c), "[\\u00a0 ]", ""), r"-?\d+(?:\.\d+)?"))


def catalog_price(c: Column) -> Column:
    """Spaces kept, so the digits before one are the number; 1 to 100000."""
    value = _first(F.trim(_dotted(c)), r"\d+(?:\.\d{1,2})?")
    return F.when(~missing.core(c) & value.between(1, 100000), value)


def candidate_price(c: Column) -> Column:
    """struct(value, dotted): the first number and whether it had a point."""
    token = F.regexp_extract(F.trim(_dotted(c)), r"\d+(?:\.\d+)?", 0)
    return F.struct(F.when(token != "", token.try_cast("double")).alias("value"), token.contains(".").alias("dotted"))


def valid_price(c: Column) -> Column:
    """Up to five digits, two decimals or none, and at least 100."""
    return F.coalesce(c.rlike(r"^\d{1,5}(\.\d{2})?$") & (c.try_cast("double") >= 100), F.lit(False))


def qr_price(c: Column) -> Column:
    value = _first(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), ",", "."), r"\d+(?:\.\d+)?")
    return F.when(value > 0, F.bround(value, 2))


def service_number(c: Column) -> Column:
    """All but digits, points and minus signs dropped."""
    return F.regexp_replace(_dotted(c), r"[^0-9.\-]", "").try_cast("double")


def service_float(c: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.trim(_dotted(c)).try_cast("double"), F.lit(default))

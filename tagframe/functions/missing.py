"""Five predicates of "missing", deliberately different; each belongs to its stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSENT = "нет"


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def core(c: Column) -> Column:
    """Catalogue and rule engine: ABSENT is a value."""
    return F.lower(_text(c)).isin("", "nan", "none", "null")


def dedup(c: Column) -> Column:
    return F.lower(_text(c)).isin("", "nan", "none", "null", ABSENT)


def dedup_value(c: Column) -> Column:
    """The stripped text without a trailing ``.0`` of digits; missing is empty."""
    t = _text(c)
    whole = F.regexp_extract(t, r"^(\d+)\.0$", 1)
    return F.when(dedup(c), "").when(whole != "", whole).otherwise(t)


def metric(c: Column) -> Column:
    """Job metrics."""
    return F.lower(_text(c)).isin("", ABSENT, "no", "none", "null", "nan")


def sql(c: Column) -> Column:
    """Fill rates of the result table."""
    return c.isNull() | (c.cast("string") == "") | (F.lower(c.cast("string")) == ABSENT)


def persist(c: Column) -> Column:
    """What the result table stores as null: empty, ABSENT or no number."""
    t = _text(c)
    return (t == "") | (F.lower(t) == ABSENT) | F.regexp_replace(t, ",", ".").try_cast("double").isNull()

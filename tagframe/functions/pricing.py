"""Shelf-price arithmetic, discounts and barcodes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COMMON_CENTS = (9, 19, 26, 29, 39, 42, 49, 59, 69, 73, 79, 89, 90, 94, 95, 99)
HALF_POINT = 0.5  # shown percentages are floored; this is the middle of what is cut off


def shelf(v: Column) -> Column:
    return F.greatest(F.lit(0.0), F.floor(v) + 0.99)


def closest(v: Column) -> Column:
    """The nearest price whose cents end in 9, in the next lower, same or next higher integer; the lower on ties."""
    k = F.floor((v + 0.01) * 10)  # prices end in k/10 - 0.01
    below, above = _ninth(F.greatest(k, F.lit(1))), _ninth(F.greatest(k + 1, F.lit(1)))
    return F.when(F.abs(below - v) <= F.abs(above - v), below).otherwise(above)


def _ninth(k: Column) -> Column:
    n = k * 10 - 1
    return (n - n % 100) / 100 + (n % 100) / 100.0


def cents(v: Column) -> Column:
    return F.bround((v - F.floor(v)) * 100, 0).cast("int")


def regular(v: Column, dotted: Column) -> Column:
    """Without written cents, or with 00, the shelf price; cents that end in 9 stay; else the closest."""
    c = cents(v)
    return F.when(~dotted | (c == 0), shelf(v)).when(c % 10 == 9, v).otherwise(closest(v))


def percent(c: Column) -> Column:
    """A discount as a negative percentage between -90 and -1."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "\\u00a0", ""), ",", ".")
    v = F.regexp_extract(t, r"-?\d+(?:\.\d+)?", 0).try_cast("double")
    v = -F.abs(v)
    return F.when(v.between(-90, -1), v)


def factor(p: Column) -> Column:
    """What is left of a price after a discount of |p| percent, at most 70."""
    f = 1 - (F.abs(p) + HALF_POINT) / 100
    return F.when((F.abs(p) <= 70) & f.between(0.10, 0.99), f)


def inferred_default(card: Column, p: Column) -> Column:
    f = 1 - (F.abs(p) + HALF_POINT) / 100
    v = card / f
    ok = F.abs(p).between(5, 70) & (f >= 0.10) & (f < 1) & (v > card * 1.02) & (v <= 20000)
    return F.when(ok, closest(v))


def inferred_discount(card: Column, default: Column) -> Column:
    p = F.floor((1 - card / default) * 100 + 1e-9).cast("int")
    return F.when((default > card * 1.02) & (default <= card * 4) & p.between(5, 70), -p)


def second_qr(default: Column, whole: Column) -> Column:
    return F.greatest(F.lit(0.0), F.bround((default + F.when(whole, 0.69).otherwise(0.0)) * 0.95, 0) - 0.01)


def needs_cents(c: Column, v: Column) -> Column:
    """Whether a written price has no cents, 00, or cents that shelves don't use."""
    shown = F.regexp_extract(F.regexp_replace(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[\\u00a0 ]", ""), ",", "."), r"\d+(?:\.(\d+))?", 1)
    return F.coalesce((shown == "") | (cents(v) == 0) | ~cents(v).isin(*COMMON_CENTS), F.lit(False))


def ean_ok(code: Column) -> Column:
    """Checksum of EAN-8 and EAN-13."""
    n = F.length(code)
    digit = lambda i: F.substr(code, i, F.lit(1)).cast("int")
    weight = lambda i: F.when((n - i) % 2 == 1, 3).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), F.lit(0), lambda a, i: a + digit(i) * weight(i))
    return F.coalesce(code.rlike(r"^(\d{8}|\d{13})$") & ((10 - total % 10) % 10 == F.right(code, F.lit(1)).cast("int")), F.lit(False))


def barcode_tier(code: Column, special: Column) -> Column:
    """Order of choice: EAN-8 of the special brand, local EAN-13, EAN-13, EAN-8, not internal, any."""
    n, ok = F.length(code), ean_ok(code)
    return (
        F.when(special & (n == 8) & ok, 0).when((n == 13) & code.startswith("46") & ok, 1).when((n == 13) & ok, 2).when((n == 8) & ok, 3)
        .when(~((n == 14) & code.startswith("14")), 4).otherwise(5)
    )


def barcode(kind: str, first: Column, second: Column | None = None) -> Column:
    """Three normalisers: ``dedup`` (6 digits or more, of the first filled), ``rule`` (any), ``qr`` (8 to 14)."""
    raw = F.coalesce(first.cast("string"), F.lit(""))
    if second is not None:
        raw = F.when(F.trim(raw) != "", raw).otherwise(F.coalesce(second.cast("string"), F.lit("")))
    digits = F.regexp_replace(raw, r"\D", "")
    n = F.length(digits)
    ok = {"dedup": n >= 6, "rule": n >= 0, "qr": n.between(8, 14)}[kind]
    return F.when(ok, digits).otherwise("")


def sku_prefix(name: Column) -> Column:
    has = lambda *w: sum((name.contains(x).cast("int") for x in w[1:]), name.contains(w[0]).cast("int")) > 0
    return F.when(has("конфитюр", "варенье", "джем", "десерт фрукт"), "370202").when(has("готовая основа"), "370203").otherwise("370204")


def observed_bonus(observed: Column, prices: Column, exact: float, near: float, bonus: float, penalty: float) -> Column:
    """Score change of a catalogue entry whose prices lie by an observed one."""
    diff = F.array_min(F.transform(prices, lambda p: F.abs(p - observed)))
    part = bonus * 0.5 * (1 - (diff - exact) / max(near - exact, 1e-6))
    return F.when(observed.isNull() | diff.isNull(), 0.0).when(diff <= exact, bonus).when(diff <= near, part).otherwise(-penalty)


def sigmoid(x: Column, centre: float, scale: float) -> Column:
    return 1 / (1 + F.exp(-(x - centre) / scale))


def triangle(x: Column, low: float, best: float, high: float) -> Column:
    return F.when((x <= low) | (x >= high), 0.0).when(x <= best, (x - low) / (best - low)).otherwise((high - x) / (high - best))

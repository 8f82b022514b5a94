"""Typed field values from recognised text: struct(value, valid, confidence), value "" if none.

Tokens are array<struct<text string, confidence double, box array<array<double>>>>.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .numparse import valid_price
from .text import collapse, digit_noise


def _out(value: Column, valid: Column, confidence: Column) -> Column:
    found = value != ""
    return F.struct(
        F.coalesce(value, F.lit("")).alias("value"), F.coalesce(found & valid, F.lit(False)).alias("valid"),
        F.coalesce(F.when(found, confidence), F.lit(0.0)).cast("double").alias("confidence"),
    )


def _clean(text: Column, clean: bool) -> Column:
    """``clean``: the text has no digit noise any more."""
    return text if clean else digit_noise(text)


def token_text(tokens: Column) -> Column:
    """Texts from top to bottom and left to right."""
    keyed = F.transform(tokens, lambda t, i: F.struct(_side(t, 1, F.array_min).alias("y"), _side(t, 0, F.array_min).alias("x"), i.alias("i"), t["text"].alias("t")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda t: t["t"]), " ")


def token_confidence(tokens: Column) -> Column:
    n = F.size(tokens)
    return F.when(n > 0, F.aggregate(tokens, F.lit(0.0), lambda a, t: a + t["confidence"]) / n).otherwise(0.0)


def _side(t: Column, axis: int, f) -> Column:
    return F.coalesce(f(F.transform(t["box"], lambda p: p[axis])), F.lit(0.0))


def numbers(tokens: Column) -> Column:
    """Tokens with digits and no percent sign, with geometry relative to the text's extent."""
    w = F.greatest(F.lit(1.0), F.array_max(F.transform(tokens, lambda t: _side(t, 0, F.array_max))))
    h = F.greatest(F.lit(1.0), F.array_max(F.transform(tokens, lambda t: _side(t, 1, F.array_max))))

    def one(t: Column, i: Column) -> Column:
        raw = digit_noise(t["text"])
        x1, y1, x2, y2 = _side(t, 0, F.array_min), _side(t, 1, F.array_min), _side(t, 0, F.array_max), _side(t, 1, F.array_max)
        width, height = F.greatest(F.lit(1.0), x2 - x1), F.greatest(F.lit(1.0), y2 - y1)
        return F.struct(
            i.alias("i"), F.regexp_replace(raw, r"\D", "").alias("digits"), raw.alias("raw"), t["confidence"].cast("double").alias("confidence"),
            ((x1 + x2) / 2 / w).alias("cx"), ((y1 + y2) / 2 / h).alias("cy"), (height / h).alias("height"), (width * height / (w * h)).alias("area"),
        )

    return F.filter(F.transform(tokens, one), lambda n: (n["digits"] != "") & ~n["raw"].contains("%"))


def _best(items: Column, score) -> Column:
    """The item of the highest score, the first on ties; null of an empty array."""
    keyed = F.transform(items, lambda n: F.struct(score(n).alias("s"), (-n["i"]).alias("o"), n.alias("n")))
    return F.array_max(F.transform(keyed, lambda k: F.struct(k["s"].alias("s"), k["o"].alias("o"), k["n"].alias("n"))))["n"]


def _or(*choices: Column) -> Column:
    """The first array that isn't empty, else the last."""
    out = choices[-1]
    for c in reversed(choices[:-1]):
        out = F.when(F.size(c) > 0, c).otherwise(out)
    return out


def price_digits(d: Column) -> Column:
    """Five digits or more end in cents."""
    n = F.length(d)
    whole = F.substr(d, F.lit(1), F.greatest(n - 2, F.lit(0))).cast("long").cast("string")
    return F.when(n == 0, "").when(n >= 5, F.concat(whole, F.lit("."), F.right(d, F.lit(2)))).otherwise(d.cast("long").cast("string"))


def price_format(main: Column, cents: Column) -> Column:
    """A four-digit main part whose last digit repeats the cents' first one loses it."""
    cut = F.when((F.length(main) == 4) & (F.right(main, F.lit(1)) == F.left(cents, F.lit(1))), F.left(main, F.lit(3))).otherwise(main)
    return F.when(F.length(cents) == 2, F.concat(cut.cast("long").cast("string"), F.lit("."), cents)).otherwise(price_digits(main))


def _priced(main: Column, items: Column) -> Column:
    """struct(value, confidence) of a main number and the cents to its right."""
    return let(main, lambda m: _with_cents(m, items))


def _with_cents(main: Column, items: Column) -> Column:
    right = F.filter(items, lambda n: (n["i"] != main["i"]) & (F.length(n["digits"]) == 2) & (n["cx"] > main["cx"]) & (F.abs(n["cy"] - main["cy"]) <= 0.22) & (n["height"] <= main["height"] * 1.05))
    return let(_best(right, lambda n: n["confidence"] + n["height"]), lambda cents: _cents(main, cents))


def _cents(main: Column, cents: Column) -> Column:
    value = F.when(cents.isNotNull(), price_format(main["digits"], cents["digits"])).otherwise(price_digits(main["digits"]))
    sure = F.when(cents.isNotNull(), (main["confidence"] + cents["confidence"]) / 2).otherwise(main["confidence"])
    return F.struct(F.coalesce(value, F.lit("")).alias("value"), sure.alias("confidence"))


def large_price(items: Column) -> Column:
    three = F.filter(items, lambda n: F.length(n["digits"]) >= 3)
    best = let(three, lambda t: _or(F.filter(t, lambda n: n["cy"] > 0.25), t))
    score = lambda n: n["height"] * 2 + n["area"] * 3 + n["confidence"] + F.least(F.length(n["digits"]), F.lit(4)) * 0.05 + n["cy"] * 0.15
    return _priced(_best(best, score), items)


def weight_like(raw: Column) -> Column:
    return raw.rlike(r"(?i)\d+\s*(г|гр|g|r)(?![0-9A-Za-zА-Яа-яЁё_])")


def default_price(items: Column) -> Column:
    two = F.filter(items, lambda n: F.length(n["digits"]) >= 2)
    band = F.filter(two, lambda n: (n["cy"] > 0.30) & (n["cy"] < 0.85))
    first = _or(band, two, items)
    light = lambda a: F.filter(a, lambda n: ~weight_like(n["raw"]))

    def score(n: Column) -> Column:
        bonus = F.greatest(F.lit(0.0), n["cx"] - 0.35) * 0.35 + F.greatest(F.lit(0.0), n["cy"] - 0.30) * 0.25
        return n["confidence"] + bonus + F.least(F.length(n["digits"]), F.lit(4)) * 0.04 - F.when(weight_like(n["raw"]), 0.75).otherwise(0.0)

    return _priced(_best(_or(light(first), light(two), first), score), items)


def text_price(text: Column, clean: bool = False) -> Column:
    """struct(value, confidence) of ``199 99``-like text, else of three digits or more."""
    return let(_clean(text, clean), _text_price)


def _text_price(t: Column) -> Column:
    found = F.struct(*(F.regexp_extract(t, r"(\d{1,4})[\s,.]+(\d{2})(?!\d)", i).alias(n) for i, n in ((1, "whole"), (2, "cents"))), F.left(F.regexp_replace(t, r"\D+", ""), F.lit(5)).alias("digits"))
    return let(found, lambda x: _text_value(x["whole"], x["cents"], x["digits"]))


def _text_value(whole: Column, cents: Column, digits: Column) -> Column:
    """``digits``: the text's first five."""
    short = price_digits(digits)
    pair = F.concat(whole.cast("int").cast("string"), F.lit("."), cents)
    value = F.when(whole != "", pair).when(F.length(digits) >= 3, short).otherwise("")
    return F.struct(value.alias("value"), F.when(whole != "", 0.55).otherwise(0.45).alias("confidence"))


def price(tokens: Column, text: Column, large: bool, clean: bool = False) -> Column:
    of = large_price if large else default_price
    none = F.struct(F.lit("").alias("value"), F.lit(0.0).alias("confidence"))
    seen = let(numbers(tokens), lambda items: F.when(F.size(items) > 0, of(items)).otherwise(none))
    chosen = let(seen, lambda x: F.when(x["value"] != "", x).otherwise(text_price(text, clean)))
    return let(chosen, lambda x: _out(x["value"], valid_price(x["value"]), x["confidence"]))


def discount_parts(text: Column, clean: bool = False) -> Column:
    """struct(percent, penalty): ``30%``, or the noisy ``309%``."""
    return let(_clean(text, clean), lambda t: let(_percents(t), lambda x: _percent(x["clean"], x["noisy"])))


def _percents(t: Column) -> Column:
    clean = F.regexp_extract(t, r"(?<!\d)-?\s*(\d{1,2})\s*%(?!\d)", 1).try_cast("int")
    noisy = F.regexp_extract(t, r"(?<!\d)([1-6]\d)9\s*%(?!\d)", 1).try_cast("int")
    return F.struct(clean.alias("clean"), noisy.alias("noisy"))


def _percent(clean: Column, noisy: Column) -> Column:
    ok, loud = clean.between(1, 90), noisy.between(10, 69)
    return F.struct(F.when(ok, clean).when(loud, noisy).alias("percent"), F.when(ok, 0.0).when(loud, 0.35).otherwise(0.0).alias("penalty"))


def implausible_discount(p: Column) -> Column:
    p = F.abs(p)
    return F.when(p.isNull() | (p <= 70), 0.0).when(p <= 80, 0.45 + (p - 70) * 0.03).otherwise(1.20 + (p - 80) * 0.12)


def discount(text: Column, clean: bool = False) -> Column:
    return let(discount_parts(text, clean), _discount)


def _discount(d: Column) -> Column:
    value = F.when(d["percent"].isNull(), "").otherwise(F.concat(F.lit("-"), d["percent"].cast("string"), F.lit("%")))
    return _out(value, F.lit(True), F.greatest(F.lit(0.25), 0.9 - d["penalty"] - implausible_discount(d["percent"]) * 0.2))


def _longest(items: Column, prefer: int | None = None) -> Column:
    key = lambda s, i: F.struct((F.length(s) == prefer if prefer else F.lit(False)).alias("p"), F.length(s).alias("n"), (-i).alias("o"), s.alias("s"))
    return F.array_max(F.transform(items, key))["s"]


def barcode(text: Column, clean: bool = False) -> Column:
    return let(_clean(text, clean), lambda t: let(_barcode_runs(t), lambda runs: let(F.coalesce(_longest(runs, 13), F.lit("")), _barcode)))


def _barcode_runs(t: Column) -> Column:
    runs = F.regexp_extract_all(F.regexp_replace(t, r"\s+", ""), F.lit(r"(\d{8,14})"), F.lit(1))
    return let(runs, lambda r: F.when(F.size(r) > 0, r).otherwise(let(F.regexp_replace(t, r"\D+", ""), _barcode_digits)))


def _barcode_digits(digits: Column) -> Column:
    n = F.length(digits)
    return F.when(n.between(8, 14), F.array(digits)).when(n > 14, F.regexp_extract_all(digits, F.lit(r"(\d{13})"), F.lit(1))).otherwise(F.array().cast("array<string>"))


def _barcode(value: Column) -> Column:
    whole = F.length(value) == 13
    return _out(value, whole, F.when(whole, 0.95).otherwise(0.75))


def date_like(s: Column) -> Column:
    return F.length(s).isin(6, 8)


def sku(text: Column, clean: bool = False) -> Column:
    return let(_clean(text, clean), lambda t: let(F.regexp_extract(t, r"(?iU)(?:sku|id[_\s-]*sku|арт\w*)\D{0,8}(\d{5,15})", 1), lambda named: _sku(t, named)))


def _sku(t: Column, named: Column) -> Column:
    other = F.filter(F.regexp_extract_all(t, F.lit(r"(\d{6,15})"), F.lit(1)), lambda s: ~date_like(s))
    value = F.when(named != "", named).otherwise(F.coalesce(_longest(other), F.lit("")))
    return let(value, lambda v: _out(v, F.lit(True), F.when(named != "", 0.88).otherwise(0.65)))


def printed_at(text: Column, clean: bool = False) -> Column:
    return let(_clean(text, clean), _printed_at)


def _printed_at(t: Column) -> Column:
    day, time = (F.regexp_extract(t, r"(\d{1,2}[./-]\d{1,2}[./-]\d{2,4})(?:\s+(\d{1,2}:\d{2}(?::\d{2})?))?", i) for i in (1, 2))
    return let(F.trim(F.concat_ws(" ", F.translate(day, "-/", ".."), time)), lambda v: _out(v, F.lit(True), F.lit(0.88)))


def code(text: Column, clean: bool = False) -> Column:
    return let(_clean(text, clean), _code)


def _code(t: Column) -> Column:
    shaped = F.regexp_extract(t, r"\b(\d{1,3}\s*[_-]\s*\d{4,}(?:\s*[-/]\s*\d{2,})?)\b", 1)
    named = F.regexp_extract(t, r"(?i)(?:код|code)\D{0,8}([0-9_\-/\s]{5,})", 1)
    value = F.regexp_replace(let(shaped, lambda x: F.when(x != "", x).otherwise(named)), r"\s+", "")
    return let(value, lambda v: _out(v, v.rlike(r"\d"), F.lit(0.82)))


def free_text(text: Column) -> Column:
    return let(collapse(F.regexp_replace(collapse(text), r"[|_]{2,}", " ")), _free_text)


def _free_text(t: Column) -> Column:
    # Two word characters or more, at any distance.
    return let(F.when(t.rlike(r"(?Us)\w.*?\w"), t).otherwise(""), lambda v: _out(v, F.lit(True), F.lit(0.70)))


def marked(text: Column) -> Column:
    """Whether a text has a price marker: a degree sign, a lone 99, or the currency."""
    return F.coalesce(text, F.lit("")).rlike(r"(?i)[°º]|(^|\s)99(\s|$)|rub")


def longest_digits(text: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\d+)"), F.lit(1)), F.length)), F.lit(0))


def price_atoms(text: Column) -> Column:
    """array<struct<value, kind>> of ``199°`` / ``199° 90`` and ``199 99`` in a text."""
    t = F.coalesce(text, F.lit(""))
    p = r"(?<!\d)(\d{2,4})\s*[°º]\s*(\d{2})?(?!\d)"
    whole, cents = (F.regexp_extract_all(t, F.lit(p), F.lit(i)) for i in (1, 2))
    near = F.regexp_extract_all(t, F.lit(r"(?<!\d)(\d{2,4})\s+99(?!\d)"), F.lit(1))
    a = F.zip_with(whole, cents, lambda w, c: F.struct((w.cast("int") + F.coalesce(c.try_cast("int"), F.lit(99)) / 100).alias("value"), F.lit("source_marker").alias("kind")))
    b = F.transform(near, lambda w: F.struct((w.cast("int") + 0.99).alias("value"), F.lit("source_99").alias("kind")))
    return F.filter(F.concat(a, b), lambda x: F.floor(x["value"]).between(10, 9999))


def fragment_penalty(value: Column, text: Column, kind: Column, percent: Column) -> Column:
    """Of a card price that may be a piece of a discount's digits."""
    whole, digits = F.floor(value).cast("string"), F.abs(percent).cast("string")
    inside = (F.length(digits) >= 2) & whole.startswith(digits) & (F.length(whole) > F.length(digits))
    first = F.when(inside, 0.95 + F.when(kind.isin("source_99", "parser_value"), 0.25).otherwise(0.0)).otherwise(0.0)
    t = F.coalesce(text, F.lit(""))
    p = F.lit(r"(?<!\d)(\d{2})\s*[#%]\s*(\d)(?!\d)")
    heads = F.zip_with(F.regexp_extract_all(t, p, F.lit(1)), F.regexp_extract_all(t, p, F.lit(2)), lambda a, b: F.concat(a, b))
    return first + 1.35 * F.size(F.filter(heads, lambda s: whole.startswith(s)))


def rejected_atom(value: Column, text: Column, dotted: Column, card: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    degree = F.regexp_like(t, F.concat(F.lit(r"(?<!\d)"), F.floor(value).cast("string"), F.lit(r"\d\s*[\u00b0\u00ba]")))
    return (
        ~value.between(10, 9999) | (card & (value > 5000) & ~marked(text)) | (dotted & (longest_digits(text) >= 5) & ~t.rlike("[,.]"))
        | (card & dotted & (value < 200) & degree)
    )


def time_bonus(ms: Column, selected: Column) -> Column:
    """struct(bonus, diff): steps of the distance to the selected time; a missing time reads as 0."""
    whole = lambda c: F.coalesce(F.floor(c.try_cast("double")), F.lit(0))
    diff = F.abs(whole(ms) - whole(selected))
    bonus = F.when(diff <= 250, 0.36).when(diff <= 500, 0.25).when(diff <= 1000, 0.05).when(diff <= 2000, -0.22).when(diff <= 4000, -0.48).when(diff.isNotNull(), -0.85)
    return F.struct(F.coalesce(bonus, F.lit(0.0)).alias("bonus"), F.coalesce(diff, F.lit(10**9)).alias("diff"))


# Priors of zones and engines.
ZONE_PRIOR = {
    "product_name": {"product_name": 0.25},
    "price_default": {"price_default_compact": 0.32, "price_default_digits": 0.28, "price_default": 0.18, "price_default_wide": 0.10},
    "price_card": {"price_card_number": 0.28, "price_card_big_digits": 0.25, "price_card": 0.18, "price_discount": 0.08},
    "price_discount": {"price_discount": 0.22, "price_card": 0.08},
    "barcode": {"barcode": 0.35, "barcode_digits": 0.25},
    "discount_amount": {"discount_amount": 0.30},
    "id_sku": {"bottom_info": 0.25, "id_sku": 0.18},
    "print_datetime": {"bottom_info": 0.24, "print_datetime": 0.18},
    "code": {"bottom_info": 0.22, "code": 0.18},
    "additional_info": {"additional_info": 0.18},
    "special_symbols": {"special_symbols": 0.18},
}
ENGINE_PRIOR = {"zxing": 0.30, "opencv_qr": 0.26, "paddleocr": 0.0, "rapidocr": 0.0, "easyocr": 0.0}


def candidate_score(field: Column, zone: Column, engine: Column, rank: Column, value: Column, valid: Column, confidence: Column) -> Column:
    pairs = {f"{f}|{z}": p for f, zones in ZONE_PRIOR.items() for z, p in zones.items()}
    table = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv))
    prior = F.coalesce(F.try_element_at(table(pairs), F.concat_ws("|", field, zone)), F.lit(0.0))
    prior += F.coalesce(F.try_element_at(table(ENGINE_PRIOR), engine), F.lit(0.0))
    shape = F.when((field == "barcode") & (F.length(F.regexp_replace(value, r"\D", "")) == 13), 0.15).otherwise(0.0)
    shape += F.when(field.isin("price_card", "price_default", "price_discount") & value.contains("."), 0.08).otherwise(0.0)
    shape += F.when(field.isin("product_name", "additional_info", "special_symbols") & value.rlike("[А-Яа-яЁё]"), 0.18).otherwise(0.0)
    return confidence + prior + F.greatest(F.lit(0.0), 0.12 - (rank - 1) * 0.04) + F.when(valid, 0.35).otherwise(0.0) + shape


def satisfied(field: Column, value: Column, valid: Column, confidence: Column, score: Column) -> Column:
    """Whether a candidate settles its field, so that later recognisers may be skipped."""
    dotted = valid_price(value) & value.contains(".")
    long = F.length(F.regexp_replace(value, r"\D", "")) == 13
    return valid & (
        F.when(field == "price_default", dotted & (confidence >= 0.60)).when(field.isin("price_card", "price_discount"), dotted & (confidence >= 0.92))
        .when(field == "discount_amount", confidence >= 0.80).when(field.isin("barcode", "qr_code_barcode"), long)
        .when(field.isin("product_name", "additional_info", "special_symbols", "id_sku", "print_datetime", "code"), (confidence >= 0.70) & (score >= 1.05))
        .otherwise(value != "")
    )


def uncertain(field: Column, value: Column, confidence: Column, score: Column, valid: Column) -> Column:
    c, s = F.coalesce(confidence, F.lit(1.0)), F.coalesce(score, F.lit(1.0))
    return F.when(field == "product_name", (c < 0.45) | (s < 0.45)).when(field.isin("price_default", "price_card", "discount_amount", "barcode"), (c < 0.55) | (s < 0.95) | ~valid).otherwise(c < 0.45)

"""Text normalisers and token functions, named after their use.

All are Column expressions but for Unicode normalisation and case folding, which Spark
lacks: those are Arrow UDFs, to be applied after blocking and to distinct texts.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import missing

# Fixed values of the catalogue stage.
STOP_WORDS = "a c co и в во с со из для на по к от без или the new арт россия италия германия испания франция китай".split()
CATEGORIES = "мед конфитюр варенье десерт вино набор шашлык вода кетчуп салфетки сосиски сыр молоко йогурт масло чай кофе".split()
LOOK_ALIKES = ("acekmoprtxy", "асекморгтху")
DIGIT_NOISE = ("OoОоIl|ЗзБбSsg", "00001113366559")


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.StringType())
def folded(s: pd.Series) -> pd.Series:
    """NFKC, case folding, ё as е, everything but letters and digits a space, collapsed."""

    def one(x):
        t = unicodedata.normalize("NFKC", x or "").casefold().replace("ё", "е")
        return " ".join("".join(c if c.isalnum() else " " for c in t).split())

    return s.map(one)


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def normalized(c: Column, unicode: bool = False) -> Column:
    """Catalogue form: lower case, ё as е, runs of other than Latin, Cyrillic and digits a space."""
    t = nfkc(c) if unicode else c
    t = F.regexp_replace(F.translate(F.lower(t), "ё", "е"), "[^0-9a-zа-я]+", " ")
    return F.when(missing.core(c), "").otherwise(F.trim(t))


# Fixed values of the barcode stage: spellings made equal before signs become spaces.
SPELLINGS = {r"ст(?: / |/ ?)б": "ст б", r"a\. ?c\.": "а с"}


def barcode_text(c: Column) -> Column:
    """The barcode stage's form: NFKC, lower case, ё as е, letters and digits of any script, ``250r`` as ``250г``."""
    t = F.translate(F.lower(nfkc(c)), "ё", "е")
    for pattern, plain in SPELLINGS.items():
        t = F.regexp_replace(t, pattern, plain)
    t = F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))
    return F.when(missing.core(c), "").otherwise(F.regexp_replace(t, r"(?<![^ ])(\d+)r(?![^ ])", "$1г"))


def category_text(c: Column) -> Column:
    return normalized(c)


def tokens(c: Column) -> Column:
    """Runs of two characters or more of the normal form."""
    return F.filter(F.split(normalized(c), " "), lambda t: F.length(t) >= 2)


def content_tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(tokens(c), lambda t: (F.length(t) >= 3) & ~t.isin(*STOP_WORDS)))


def distinctive_tokens(norm: Column, stop: tuple[str, ...] = ()) -> Column:
    long = F.filter(F.split(norm, " "), lambda t: F.length(t) >= 4)
    return F.array_distinct(F.filter(long, lambda t: ~t.isin(*stop)) if stop else long)


def grams(c: Column, n: int = 3) -> Column:
    """Distinct character n-grams; a shorter text is its own gram, an empty one has none."""
    size = F.length(c)
    many = F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))  # one pass, whatever the length
    return F.when(size == 0, F.array().cast("array<string>")).when(size < n, F.array(c)).otherwise(F.array_distinct(many))


def trigrams(c: Column) -> Column:
    return grams(F.regexp_replace(normalized(c), " ", ""), 3)


def surface(c: Column) -> Column:
    """Printable form: brackets and quotes unified, ``250r`` as ``250г``, spaces around signs fixed."""
    t = collapse(c)
    t = F.translate(t, "|«»{[}]", ' ""(()' + ")")
    t = F.regexp_replace(t, r"\b(\d{2,4})\s*[rR]\b", "$1г")
    t = F.regexp_replace(t, r"\s+([),.%])", "$1")
    t = F.regexp_replace(t, r"\(\s+", "(")
    return collapse(F.regexp_replace(t, r"\s*/\s*", "/"))


def guard_key(c: Column) -> Column:
    t = F.translate(F.translate(F.lower(surface(c)), "ё", "е"), *LOOK_ALIKES)
    return F.regexp_replace(t, "[^0-9a-z\\u0400-\\u04ff]+", "")


def digit_noise(c: Column) -> Column:
    """Letters that recognisers give for digits, as digits."""
    return F.translate(F.coalesce(c, F.lit("")), *DIGIT_NOISE)


def digit_groups(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(c, F.lit("")), "OoОоSs", "000055"), F.lit(r"(\d{2,})"), F.lit(1)))


def repeated_noise(c: Column) -> Column:
    t = F.regexp_extract_all(F.lower(surface(c)), F.lit("([A-Za-z\\u0400-\\u04ff]{3,})"), F.lit(1))
    return (F.size(t) >= 5) & (F.size(t) - F.size(F.array_distinct(t)) >= 2)


def brand_tokens(c: Column) -> Column:
    """Latin words, or Cyrillic ones in capitals, of three characters or more, normalised."""
    raw = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("([A-Za-zА-ЯЁ0-9]{3,})"), F.lit(1))
    brand = F.filter(raw, lambda t: t.rlike("[A-Za-z]") | (t.rlike("[А-ЯЁ]") & (F.upper(t) == t)))
    return F.array_distinct(F.filter(F.transform(brand, lambda t: normalized(t)), lambda t: (t != "") & ~t.isin(*STOP_WORDS)))


def category(token_set: Column) -> Column:
    return F.coalesce(F.try_element_at(F.array_intersect(F.array(*map(F.lit, CATEGORIES)), token_set), F.lit(1)), F.lit(""))


UNIT = r"(\d+(?:\.\d+)?|\d+\s+\d{2,3})\s*(кг|kg|гр|г|g|мл|ml|л|l)(?![0-9A-Za-zА-Яа-яЁё_])"


def unit_list(c: Column) -> Column:
    """Weights and volumes in grams and millilitres, as ``250g`` and ``500ml``, in the text's order."""
    t = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), ",", ".")
    number, unit = (F.regexp_extract_all(t, F.lit(UNIT), F.lit(i)) for i in (1, 2))

    def one(n: Column, u: Column) -> Column:
        v = F.regexp_replace(n, r"\s", "").try_cast("double")
        big = F.when(u.isin("кг", "kg", "л", "l"), v * 1000).otherwise(v)
        return F.concat(F.bround(big, 0).cast("long").cast("string"), F.when(u.isin("кг", "kg", "гр", "г", "g"), "g").otherwise("ml"))

    return F.filter(F.zip_with(number, unit, one), lambda x: x.isNotNull())


def units(c: Column) -> Column:
    return F.array_distinct(unit_list(c))


def weight_display(c: Column) -> Column:
    t = F.trim(F.coalesce(c, F.lit("")))
    pattern = r"(?i)(\d+(?:[,.]\d+)?|\d+\s*[xх]\s*\d+(?:[,.]\d+)?)\s*(кг|kg|гр|г|g|мл|ml|л|l)(?![0-9A-Za-zА-Яа-яЁё_])"
    number = F.regexp_replace(F.regexp_replace(F.regexp_extract(t, pattern, 1), r"\s+", ""), r"\.", ",")
    unit = F.lower(F.regexp_extract(t, pattern, 2))
    unit = F.when(unit.isin("kg", "кг"), "кг").when(unit.isin("гр", "g", "г"), "г").when(unit.isin("ml", "мл"), "мл").when(unit.isin("l", "л"), "л")
    return F.when((number == "") | t.rlike(r"(?iU)\bарт\b|art\.?"), "").otherwise(F.concat(number, unit))


def with_weight(name: Column, weight: Column) -> Column:
    """The name, and the weight unless the name has the same unit."""
    shown = weight_display(weight)
    return F.when((shown == "") | F.arrays_overlap(units(name), units(shown)), name).otherwise(F.concat_ws(" ", name, shown))


def name_quality(text: Column, confidence: Column, source: Column, rank: Column, lines: Column) -> Column:
    """Score of a recognised product name."""
    t = surface(text)
    count = lambda p: F.regexp_count(t, F.lit(p))
    letters, cyrillic, latin = count(r"(?U)[\p{L}]"), count("[\\u0400-\\u04ff]"), count("[A-Za-z]")
    share = F.greatest(letters, F.lit(1))
    score = confidence + F.least(F.length(t), F.lit(80)) / 155.0
    score += F.when(letters > 0, cyrillic / share * 0.30).otherwise(0.0)
    score += F.when(t.rlike(r"(?iU)\b\d{2,4}\s*(г|гр|мл|л|кг|g|gr|ml|l|kg)\b"), 0.20).otherwise(0.0)
    score += F.when(lines >= 2, 0.08).otherwise(0.0) + F.when(source.startswith("line"), 0.04).otherwise(0.0)
    score += F.when(source.contains("binary"), 0.02).otherwise(0.0) + F.greatest(F.lit(0.0), 0.10 - (rank - 1) * 0.035)
    score -= count(r"(?U)[^\w\s()/.%,'\"\-]") * 0.09
    score -= count("[A-Za-z\\u0400-\\u04ff]\\d|\\d[A-Za-z\\u0400-\\u04ff]") * 0.15
    score -= count("(?U)\\b[A-Za-z\\u0400-\\u04ff]{1,2}\\b") * 0.025
    score -= F.when((latin > 0) & (cyrillic > 0) & (latin / share > 0.55), 0.25).otherwise(0.0)
    score -= F.when(F.length(t) < 5, 0.80).otherwise(0.0) + F.when(repeated_noise(text), 0.35).otherwise(0.0)
    return score


def plausible_name(value: Column, confidence: Column, score: Column, source: Column, lines: Column) -> Column:
    t = surface(value)
    letters, cyrillic = F.regexp_count(t, F.lit(r"(?U)\p{L}")), F.regexp_count(t, F.lit("[\\u0400-\\u04ff]"))
    weird = F.regexp_count(t, F.lit(r"(?U)[^\w\s()/.%,'\"\-]"))
    split = source.startswith("lines_")
    base = (F.length(guard_key(value)) >= 5) & (letters >= 4) & (cyrillic / letters >= 0.25) & (weird < 6) & ~repeated_noise(value)
    lines_ok = (lines >= 2) & (confidence >= 0.55) & (score >= 1.18) & (weird < 4)
    return F.coalesce(base & (~split | lines_ok) & ((confidence >= 0.25) | (score >= 0.85)), F.lit(False))


def replacement_reason(before: Column, after: Column) -> Column:
    """Why a new name may replace the old one; accepted: new_from_ocr, normalized_only, ok."""
    a, b = surface(before), surface(after)
    da, db, ga, gb = digit_groups(a), digit_groups(b), grams(guard_key(a)), grams(guard_key(b))
    common = F.size(F.array_intersect(ga, gb))
    q = lambda t, s: name_quality(t, F.lit(0.7), F.lit(s), F.lit(1), F.lit(1))
    return (
        F.when(b == "", "empty").when(a == "", "new_from_ocr").when(a == b, "normalized_only").when(repeated_noise(b), "repeated_noise")
        .when((F.length(a) >= 8) & (F.length(b) > F.greatest(F.lit(22), F.floor(F.length(a) * 1.45))), "too_much_longer")
        .when((F.size(db) > 0) & (F.size(da) == 0), "new_digits").when((F.size(da) > 0) & (F.size(F.array_except(db, da)) > 0), "changed_digits")
        .when((F.size(ga) > 0) & (F.size(gb) > 0) & ((common / F.size(gb) < 0.48) | (common / F.size(ga) < 0.30)), "low_overlap")
        .when(q(b, "candidate") < q(a, "base"), "no_quality_gain").otherwise("ok")
    )


def source_variant(source: Column) -> Column:
    found = F.regexp_extract(source, r"^(?:full|lines)_([A-Za-z0-9]+)_", 1)
    return F.when(found != "", found)


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9А-Яа-яЁё._-]+", "_")

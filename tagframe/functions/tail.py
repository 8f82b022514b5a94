"""What stands after a product's name: country, weight or volume, glass packaging.

Countries are found by likeness, in Python batches, as Spark lacks this ratio: apply ``country`` and
``split`` to distinct texts.
"""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text

# Fixed values of the tail rules.
COUNTRIES = ("Россия", "Италия", "Германия", "Испания", "Франция", "Китай", "Беларусь", "Турция", "Армения", "Грузия", "Чили")
STEMS = {"росси": "Россия", "россм": "Россия", "росск": "Россия", "росг": "Россия", "россж": "Россия", "герман": "Германия", "итал": "Италия", "испан": "Испания"}
NO_STEM = "россо"
LIKE_BRACKETED, LIKE_TOKEN = 0.72, 0.78
BRACKETED = re.compile(r"\(([^)]{3,32})\)")
LEFT_OVER = re.compile(r"(?:\s|^)[,.;:|/\\-]*[0oо]\.?\s*$", re.IGNORECASE)
EDGES = " ,;:-"
MOST_GRAMS, MOST_MILLILITRES, LEAST_BARE = 1500, 3000, 10
TRAILING_UNIT = r"(?i)\s*(\d+(?:[,.]\d+)?|\d+\s*[xх]\s*\d+(?:[,.]\d+)?)\s*(кг|kg|гр|г|g|мл|ml|л|l)\s*$"
GLASS = r"(?:^|\s)ст\s*(?:б|b|6)(?:\s|$)"

FORMS = {c.lower().replace("ё", "е"): c for c in COUNTRIES}


def plain(s: str) -> str:
    return re.sub("[^0-9a-zа-я]+", " ", unicodedata.normalize("NFKC", s).lower().replace("ё", "е")).strip()


def likest(word: str) -> tuple[float, str]:
    """The likeness of the first country that is most like the word, and that country."""
    return max(((SequenceMatcher(None, word, form).ratio(), name) for form, name in FORMS.items()), key=lambda x: x[0])


def country_of(s: str | None) -> str:
    """A bracketed country first, then a word with a known stem, then a word like a country; else empty."""
    s = unicodedata.normalize("NFKC", s or "")
    inner = [likest(p) for p in map(plain, BRACKETED.findall(s)) if p]
    best = max(inner, key=lambda x: x[0], default=(0.0, ""))
    if best[0] >= LIKE_BRACKETED:
        return best[1]
    words = [w for w in plain(s).split() if len(w) >= 2]
    stems = (name for w in words if not w.startswith(NO_STEM) for stem, name in STEMS.items() if w.startswith(stem))
    alike = (name for w in words for form, name in FORMS.items() if SequenceMatcher(None, w, form).ratio() >= LIKE_TOKEN)
    return next(stems, None) or next(alike, "")


def without_countries(s: str | None) -> tuple[str, str]:
    """The text without its bracketed countries, tidied if there were any, and the last of them."""
    s, found = s or "", ""

    def drop(m: re.Match) -> str:
        nonlocal found
        name = country_of(m.group(0))
        found = name or found
        return "" if name else m.group(0)

    rest = BRACKETED.sub(drop, s)
    if not found:
        return s, ""
    rest = re.sub(r"\s+([,.;:])", r"\1", " ".join(rest.split()))
    return LEFT_OVER.sub("", rest).strip().strip(EDGES), found


@F.pandas_udf(T.StringType())
def country(s: pd.Series) -> pd.Series:
    return s.map(country_of)


@F.pandas_udf(T.StructType([T.StructField("base", T.StringType()), T.StructField("country", T.StringType())]))
def _apart(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([without_countries(x) for x in s], columns=["base", "country"])


def unit(c: Column) -> Column:
    """The last weight or volume in its bounds, else a number at the end as grams, else empty."""
    t = F.coalesce(text.nfkc(c), F.lit(""))
    amount = lambda u: F.regexp_extract(u, r"^(\d+)", 1).try_cast("long")
    fits = lambda u: F.when(u.endswith("ml"), amount(u).between(1, MOST_MILLILITRES)).otherwise(amount(u).between(1, MOST_GRAMS))
    last = F.try_element_at(F.filter(text.unit_list(t), fits), F.lit(-1))
    shown = F.concat(F.regexp_extract(last, r"^(\d+)", 1), F.when(last.endswith("ml"), "мл").otherwise("г"))
    bare = F.regexp_extract(t, r"(?:\)|\s)(\d{2,4})\s*$", 1).try_cast("int")
    return F.coalesce(shown, F.when(bare.between(LEAST_BARE, MOST_GRAMS), F.concat(bare.cast("string"), F.lit("г"))), F.lit(""))


def glass(c: Column) -> Column:
    return text.normalized(c).rlike(GLASS)


def split(c: Column) -> Column:
    """struct(base, country, unit): the unit at the end and bracketed countries taken off the printable form."""
    t = text.surface(c)
    own = text.weight_display(F.regexp_extract(t, TRAILING_UNIT, 0))
    rest = _apart(F.when(own != "", F.trim(F.regexp_replace(t, TRAILING_UNIT, ""))).otherwise(t))
    return F.struct(rest["base"].alias("base"), rest["country"].alias("country"), own.alias("unit"))


def restored(base: Column, country: Column, unit: Column, packed: Column) -> Column:
    """base, glass packaging where it is not named yet, country and unit where they are known.  Give the
    name's own country and unit, or else those of the tag."""
    shown = lambda c: F.coalesce(c, F.lit("")) != ""
    named = F.when(F.coalesce(packed, F.lit(False)) & ~glass(base), F.concat(base, F.lit(" ст/б"))).otherwise(base)
    return F.concat(named, F.when(shown(country), F.concat(F.lit(" ("), country, F.lit(")"))).otherwise(""), F.when(shown(unit), F.concat(F.lit(" "), unit)).otherwise(""))

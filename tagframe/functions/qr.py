"""Decoded QR payloads: parsing to a map, validity, normal forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .pricing import barcode

# Keys of payloads and the columns they fill.
ALIASES = {
    "barcode": "qr_code_barcode", "b": "qr_code_barcode", "price1": "price1_qr", "p1": "price1_qr", "price2": "price2_qr", "p2": "price2_qr",
    "price3": "price3_qr", "p3": "price3_qr", "price4": "price4_qr", "p4": "price4_qr",
    "wholesaleLevel1Count": "wholesale_level_1_count", "wL1C": "wholesale_level_1_count", "wholesaleLevel1Price": "wholesale_level_1_price", "wL1P": "wholesale_level_1_price",
    "wholesaleLevel2Count": "wholesale_level_2_count", "wL2C": "wholesale_level_2_count", "wholesaleLevel2Price": "wholesale_level_2_price", "wL2P": "wholesale_level_2_price",
    "actionPrice": "action_price_qr", "aP": "action_price_qr", "actionCode": "action_code_qr", "aC": "action_code_qr",
}
FIELDS = tuple(dict.fromkeys(ALIASES.values()))
COUNTS = ("wholesale_level_1_count", "wholesale_level_2_count", "action_code_qr")


def pairs(payload: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """Entries (column, value) in order of precedence: the last ``key=value`` or ``key:value``
    of the text for each column, then the first one of the URL's query."""
    text = F.trim(F.coalesce(payload, F.lit("")))
    query = F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1)
    query = F.when(text.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://") | (query != ""), query).otherwise(text)
    query = F.when(query == "", text).otherwise(query)
    name = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv))
    parts = F.filter(F.split(F.translate(query, ";|\n", "&&&"), "&"), lambda p: p.contains("="))
    plain = lambda s: F.coalesce(F.try_url_decode(s), s)
    first = F.transform(parts, lambda p: F.struct(F.try_element_at(name, plain(F.substring_index(p, "=", 1))).alias("k"), plain(F.substr(p, F.instr(p, "=") + 1)).alias("v")))
    form = F.lit(r"([A-Za-z0-9_]+)\s*[:=]\s*([^,&;|\s]+)")
    last = F.zip_with(F.regexp_extract_all(text, form, F.lit(1)), F.regexp_extract_all(text, form, F.lit(2)), lambda k, v: F.struct(F.try_element_at(name, k).alias("k"), v.alias("v")))
    return F.filter(F.concat(F.reverse(last), first), lambda e: e["k"].isNotNull())


def parsed(payload: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """map<column, value>: the first entry of each column, raw."""
    return let(pairs(payload, aliases), _first_of_each)


def _first_of_each(entries: Column) -> Column:
    names = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("k"), F.element_at(F.filter(entries, lambda e: e["k"] == n), 1)["v"].alias("v"))))


def value(found: Column, field: str) -> Column:
    """A column's normal form: prices with two decimals, digits of codes and counts; "" if none."""
    raw = F.coalesce(F.try_element_at(found, F.lit(field)), F.lit(""))
    if field == "qr_code_barcode":
        return barcode("qr", raw)
    if field in COUNTS:
        return F.regexp_replace(raw, r"\D", "")
    number = F.regexp_replace(F.regexp_extract(raw, r"\d+(?:[.,]\d+)?", 0), ",", ".").try_cast("double")
    return F.coalesce(F.when(number > 0, F.format_string("%.2f", number)), F.lit(""))


def valid(payload: Column, found: Column) -> Column:
    long = payload.contains("barcode=") & payload.contains("price1=")
    short = payload.rlike(r"(^|[?&;|])b=") & payload.rlike(r"(^|[?&;|])p1=")
    known = payload.rlike(r"(?i)(^|[?&;|])(barcode|b|price1|p1|price2|p2|price4|p4|aP|actionPrice)=")
    return F.coalesce((value(found, "qr_code_barcode") != "") & (value(found, "price1_qr") != "") & known & (long | short), F.lit(False))

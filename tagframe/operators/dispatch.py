"""From read zones to field candidates: each target field of a row goes through its own extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import extract
from ..functions.binding import let
from ..functions.text import digit_noise

LARGE = ("price_card", "price_discount")
TEXTS = ("product_name", "additional_info", "special_symbols")
# Fields of which only valid values are kept.
STRICT = ("price_default", *LARGE, "barcode")


def candidates(rows: DataFrame) -> DataFrame:
    """One row per target field with a value; prices and barcodes that are not valid are dropped.

    ``rows``: zone, target_fields (split by ``|``), engine, rank, tokens, text, confidence, and any others.
    ``confidence`` of the reading becomes that of the extraction.  Adds field_no (place among the targets),
    field, value, valid, score.  Unknown fields, null texts and null targets give no rows.
    """
    text = F.coalesce("text", F.lit(""))

    def one(field, clean):
        found = F.when(field.isin(*LARGE), extract.price(F.col("tokens"), clean, True, True)).when(field == "price_default", extract.price(F.col("tokens"), clean, False, True))
        for name, of in (("discount_amount", extract.discount), ("barcode", extract.barcode), ("id_sku", extract.sku), ("print_datetime", extract.printed_at), ("code", extract.code)):
            found = found.when(field == name, of(clean, True))
        return F.struct(field.alias("field"), found.when(field.isin(*TEXTS), extract.free_text(text)).alias("found"))

    # Extraction is done within the array, once a field: as a column, each use of its parts would do it again.
    # Outer, as Spark infers a filter on the array from the other kind, which does it again too.
    targets = F.filter(F.split("target_fields", r"\|"), lambda x: x != "")
    out = rows.select("*", F.posexplode_outer(let(digit_noise(text), lambda clean: F.transform(targets, lambda field: one(field, clean)))).alias("field_no", "_x"))
    out = out.select("*", F.col("_x.field").alias("field"), F.col("_x.found").alias("_f")).drop("_x")
    field = F.col("field")
    out = out.where((F.col("_f.value") != "") & (F.col("_f.valid") | ~field.isin(*STRICT)))
    out = out.withColumns({"value": F.col("_f.value"), "valid": F.col("_f.valid"), "confidence": F.col("_f.confidence")}).drop("_f")
    return out.withColumn("score", extract.candidate_score(field, F.col("zone"), F.col("engine"), F.col("rank"), F.col("value"), F.col("valid"), F.col("confidence")))


def quantised(rows: DataFrame, places: dict[str, int] | None = None) -> DataFrame:
    """Columns rounded half-even as a stored row has them: scores to 4 places unless ``places`` says else."""
    places = places or {"score": 4, "confidence": 4}
    return rows.withColumns({c: F.bround(F.col(c).cast("double"), n) for c, n in places.items() if c in rows.columns})

"""Price arithmetic, the rule engine and barcodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pricing
from ..operators import ordering, rules
from ..sources.tables import spread, table
from ._registry import query
from .fields import KEY, KEYS

def card():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))
@query(f"SELECT {KEYS}, round(floor(l_extendedprice) + 0.99, 2) AS shelf, round(greatest(0, round_even(l_extendedprice * 0.95, 0) - 0.01), 2) AS second FROM lineitem")
def shelf_price(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*KEY, F.round(pricing.shelf(F.col("l_extendedprice")), 2).alias("shelf"), F.round(pricing.second_qr(F.col("l_extendedprice"), F.lit(False)), 2).alias("second"))


@query(f"""WITH e AS (SELECT (unnest(range(0, 10)) * 10 + 9) / 100.0::DOUBLE e), o AS (SELECT unnest([-1, 0, 1]) o), v AS (SELECT DISTINCT l_extendedprice v FROM lineitem),
c AS (SELECT v, abs(floor(v) + o + e - v) d, floor(v) + o + e p FROM v, o, e WHERE floor(v) + o >= 0), b AS (SELECT v, arg_min(p, row(d, p)) p FROM c GROUP BY v)
SELECT {KEYS}, round(p, 2) AS closest FROM lineitem JOIN b ON l_extendedprice = v""")
def closest_cents(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*KEY, F.round(pricing.closest(F.col("l_extendedprice")), 2).alias("closest"))


@query(f"""WITH x AS (SELECT *, l_extendedprice * (1 - l_discount) / 10 c, l_discount * 100 * 5 p FROM lineitem), y AS (SELECT *, c / (1 - (p + 0.5) / 100) v FROM x)
SELECT {KEYS}, p BETWEEN 5 AND 70 AND v > c * 1.02 AND v <= 20000 AS inferred, CASE WHEN p BETWEEN 5 AND 70 AND v > c * 1.02 AND v <= 20000 THEN floor(v) END AS about FROM y""")
def infer_default(spark, sf_dir):
    c, p = card() / 10, F.col("l_discount") * 100 * 5
    v = c / (1 - (p + 0.5) / 100)
    got = pricing.inferred_default(c, p)
    return table(spark, sf_dir, "lineitem").select(*KEY, got.isNotNull().alias("inferred"), F.when(got.isNotNull() & (F.abs(got - v) <= 0.11), F.floor(v).cast("double")).alias("about"))


@query(f"""WITH x AS (SELECT *, l_extendedprice * (1 - l_discount * 5) c, l_extendedprice d FROM lineitem), y AS (SELECT *, CAST(floor((1 - c / d) * 100 + 1e-9) AS INT) p FROM x)
SELECT {KEYS}, CASE WHEN d > c * 1.02 AND d <= c * 4 AND p BETWEEN 5 AND 70 THEN -p END AS percent FROM y""")
def infer_discount(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*KEY, pricing.inferred_discount(F.col("l_extendedprice") * (1 - F.col("l_discount") * 5), F.col("l_extendedprice")).alias("percent"))


def price_rows(spark, sf_dir):
    """Result rows with faulty prices: every 7th default is ten times too high, every 11th lost."""
    li = spread(table(spark, sf_dir, "lineitem").select(*KEY, "l_extendedprice", "l_discount"))
    d = F.floor(F.col("l_extendedprice") / 10)
    default = F.when(F.col("l_orderkey") % 11 == 0, "").when(F.col("l_orderkey") % 7 == 0, (d * 10).cast("long").cast("string")).otherwise(d.cast("long").cast("string"))
    card = F.floor(d * (1 - F.col("l_discount") * 5)).cast("long").cast("string")
    percent = F.when(F.col("l_orderkey") % 3 == 0, F.concat(F.lit("-"), F.round(F.col("l_discount") * 500).cast("int").cast("string"), F.lit("%"))).otherwise("")
    return li.select(*KEY, default.alias("price_default"), card.alias("price_card"), percent.alias("discount_amount"), F.lit("").alias("price1_qr"), F.lit("").alias("price2_qr"), F.lit("").alias("price4_qr"))


SANE = f"""WITH r AS (SELECT {KEYS}, floor(l_extendedprice / 10) d0, CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 7 = 0 THEN floor(l_extendedprice / 10) * 10 ELSE floor(l_extendedprice / 10) END + 0.99::DOUBLE d,
  floor(floor(l_extendedprice / 10) * (1 - l_discount * 5)) + 0.99::DOUBLE c, CASE WHEN l_orderkey % 3 = 0 AND round(l_discount * 500) BETWEEN 1 AND 70 THEN 1 - (round(l_discount * 500) + 0.5) / 100 END f0 FROM lineitem),
a AS (SELECT *, CASE WHEN f0 BETWEEN 0.10 AND 0.99 THEN f0 END f FROM r),
b AS (SELECT *, f IS NOT NULL AND d IS NOT NULL both_f, f IS NULL AND d IS NOT NULL both_n, c BETWEEN 5 AND 9999 sane, d <= c * 1.02 OR c > d * 1.25 OR greatest(d, c) / greatest(1, least(d, c)) >= 4 OR abs(c - d * f) / greatest(1, d * f) > 0.35 OR d > 20000 off FROM a)
SELECT {KEYS}, CASE WHEN d IS NULL THEN 'none' WHEN both_f AND sane AND off THEN 'repaired' WHEN both_n AND c > d * 1.5 THEN 'removed' WHEN both_n AND d > c * 4 THEN 'shifted' ELSE 'kept' END AS decision FROM b"""


@query(SANE)
def price_sanity(spark, sf_dir):
    """What became of each row's default price."""
    has = lambda *s: F.exists("audit", lambda a: a["source"].isin(*s) & (a["field"] == "price_default"))
    before = rules.numparse.rule_price(F.col("original"))
    rows = rules.with_sanity(price_rows(spark, sf_dir).withColumn("original", F.col("price_default")))
    shifted = has("price_default_decimal_shift_repair")
    outlier = has("price_default_gross_outlier_removed")
    over = numbers_over(F.col("original"), F.col("price_card"))
    decision = F.when(before.isNull(), "none").when(has("discount_relation_default_repair"), "repaired").when(shifted | (outlier & ~over), "shifted").when(outlier, "removed").otherwise("kept")
    return rows.select(*KEY, decision.alias("decision"))


def numbers_over(default, card):
    """Whether the card price is over one and a half times the default price."""
    d, c = (pricing.shelf(rules.numparse.rule_price(x)) for x in (default, card))
    return F.coalesce(c > d * 1.5, F.lit(False))


@query(f"""WITH r AS (SELECT {KEYS}, l_orderkey % 11 = 0 lost FROM lineitem), s AS (SELECT unnest(['qr_from_price_default', 'qr_price2_from_95pct_default', 'qr_from_price_card']) source)
SELECT {KEYS}, source FROM r, s WHERE NOT (lost AND source <> 'qr_from_price_card')""")
def repair_audit(spark, sf_dir):
    out = rules.applied(price_rows(spark, sf_dir), rules.derived_qr())
    return rules.changes(out, KEY).select(*KEY, "source")


@query("""SELECT o_orderkey, lpad(CAST(o_orderkey * 7919 AS VARCHAR), 13, '4') AS code,
 (10 - (list_sum([CAST(substr(lpad(CAST(o_orderkey * 7919 AS VARCHAR), 13, '4'), CAST(i AS BIGINT), 1) AS INT) * CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END for i in range(1, 13)])) % 10) % 10 = CAST(right(lpad(CAST(o_orderkey * 7919 AS VARCHAR), 13, '4'), 1) AS INT) AS ok FROM orders""")
def ean_check(spark, sf_dir):
    code = F.lpad((F.col("o_orderkey") * 7919).cast("string"), 13, "4")
    return table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code"), pricing.ean_ok(code).alias("ok"))


@query("""WITH c AS (SELECT p_brand, p_partkey, CASE WHEN p_partkey % 3 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 8, '1') ELSE '14' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') END code FROM part),
t AS (SELECT *, CASE WHEN length(code) = 8 AND (10 - list_sum([CAST(substr(code, CAST(i AS BIGINT), 1) AS INT) * CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END for i in range(1, 8)]) % 10) % 10 = CAST(right(code, 1) AS INT) THEN 3 WHEN length(code) = 14 AND code LIKE '14%' THEN 5 ELSE 4 END tier FROM c)
SELECT p_brand, arg_min(code, row(tier, p_partkey)) AS code FROM t GROUP BY p_brand""")
def choose_barcode(spark, sf_dir):
    p = F.col("p_partkey")
    code = F.when(p % 3 == 0, F.lpad(p.cast("string"), 8, "1")).otherwise(F.concat(F.lit("14"), F.lpad(p.cast("string"), 12, "0")))
    rows = table(spark, sf_dir, "part").select("p_brand", "p_partkey", code.alias("code")).withColumn("tier", pricing.barcode_tier(F.col("code"), F.lit(False)))
    return ordering.first_by(rows, ["p_brand"], ["tier", "p_partkey"], ["code"])

"""Field extraction and text normalisation over generated and given texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import extract, qr, text
from ..operators import elections
from ..sources.tables import spread, table
from ._registry import query

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
KEYS = ", ".join(KEY)
PRICE_TEXT = "concat('Цена ', cast(cast(floor(l_extendedprice / 10) as {i}) as {s}), ' ', lpad(cast(cast(floor(l_discount * 1000) as {i}) as {s}), 2, '0'), ' руб')"
DISCOUNT_TEXT = "concat('скидка -', cast(cast(round(l_discount * 900) as {i}) as {s}), '% сегодня')"
CODE_TEXT = "concat('код ', cast(l_linenumber as {s}), ' _ ', lpad(cast(l_orderkey as {s}), 6, '0'), ' от ', cast(l_linenumber + 10 as {s}), '.0', cast(l_linenumber as {s}), '.2024 10:30')"
BARCODE_TEXT = "concat('EAN ', lpad(cast(l_orderkey * 1000 + l_partkey as {s}), 13, '4'), ' шт')"


def texts(spark, sf_dir, form):
    return spread(table(spark, sf_dir, "lineitem")).select(*KEY, F.expr(form.format(i="bigint", s="string")).alias("t"))


def duck(form):
    return f"(SELECT {KEYS}, {form.format(i='bigint', s='varchar')} AS t FROM lineitem)"


@query(f"""WITH p AS (SELECT *, regexp_extract(t, '(\\d{{1,4}})[\\s,.]+(\\d{{2}})(?:\\D|$)', 1) w, regexp_extract(t, '(\\d{{1,4}})[\\s,.]+(\\d{{2}})(?:\\D|$)', 2) c FROM {duck(PRICE_TEXT)}),
v AS (SELECT {KEYS}, CASE WHEN w <> '' THEN CAST(CAST(w AS INT) AS VARCHAR) || '.' || c ELSE '' END AS value FROM p)
SELECT *, value <> '' AND CAST(nullif(value, '') AS DOUBLE) >= 100 AS valid FROM v""")
def extract_price(spark, sf_dir):
    empty = F.array().cast("array<struct<text:string,confidence:double,box:array<array<double>>>>")
    out = texts(spark, sf_dir, PRICE_TEXT).withColumn("x", extract.price(empty, F.col("t"), True))
    return out.select(*KEY, "x.value", "x.valid")


@query(f"""WITH p AS (SELECT *, try_cast(regexp_extract(t, '-(\\d{{1,2}})%', 1) AS INT) v FROM {duck(DISCOUNT_TEXT)})
SELECT {KEYS}, CASE WHEN v BETWEEN 1 AND 90 THEN '-' || v || '%' ELSE '' END AS value, coalesce(v BETWEEN 1 AND 90, false) AS valid,
 round(CASE WHEN v IS NULL OR v NOT BETWEEN 1 AND 90 THEN 0 ELSE greatest(0.25, 0.9 - 0.2 * CASE WHEN v <= 70 THEN 0 WHEN v <= 80 THEN 0.45 + (v - 70) * 0.03 ELSE 1.20 + (v - 80) * 0.12 END) END, 6)::DOUBLE AS confidence FROM p""")
def extract_discount(spark, sf_dir):
    out = texts(spark, sf_dir, DISCOUNT_TEXT).withColumn("x", extract.discount(F.col("t")))
    return out.select(*KEY, "x.value", "x.valid", F.round("x.confidence", 6).alias("confidence"))


@query(f"""SELECT {KEYS}, regexp_extract(t, '\\d{{8,14}}', 0) AS value, length(regexp_extract(t, '\\d{{8,14}}', 0)) = 13 AS valid FROM {duck(BARCODE_TEXT)}""")
def extract_barcode(spark, sf_dir):
    out = texts(spark, sf_dir, BARCODE_TEXT).withColumn("x", extract.barcode(F.col("t")))
    return out.select(*KEY, "x.value", "x.valid")


@query(f"""SELECT {KEYS}, regexp_extract(t, '(\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{2,4}})\\s+\\d{{1,2}}:\\d{{2}}', 1) || ' ' || regexp_extract(t, '\\d{{2,4}}\\s+(\\d{{1,2}}:\\d{{2}})', 1) AS value FROM {duck(CODE_TEXT)}""")
def extract_datetime(spark, sf_dir):
    out = texts(spark, sf_dir, CODE_TEXT).withColumn("x", extract.printed_at(F.col("t")))
    return out.select(*KEY, "x.value")


@query(f"""SELECT {KEYS}, regexp_replace(regexp_extract(t, '\\d{{1,3}}\\s*[_-]\\s*\\d{{4,}}', 0), '\\s+', '', 'g') AS value FROM {duck(CODE_TEXT)}""")
def extract_code(spark, sf_dir):
    out = texts(spark, sf_dir, CODE_TEXT).withColumn("x", extract.code(F.col("t")))
    return out.select(*KEY, "x.value")


@query("""SELECT doc_id, CASE WHEN lower(trim(text)) IN ('', 'nan', 'none', 'null') THEN '' ELSE trim(regexp_replace(replace(lower(text), 'ё', 'е'), '[^0-9a-zа-я]+', ' ', 'g')) END AS norm FROM documents""")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.normalized(F.col("text")).alias("norm"))


@query("""WITH n AS (SELECT doc_id, regexp_replace(lower(text), '[^0-9a-z]+', '', 'g') k FROM documents), g AS (SELECT doc_id, list_distinct([substr(k, CAST(i AS BIGINT), 3) for i in range(1, greatest(length(k) - 2, 1) + 1)]) a FROM n WHERE k <> '')
SELECT doc_id, len(a) AS n_grams FROM g""")
def ngram_sets(spark, sf_dir):
    k = F.regexp_replace(F.lower("text"), "[^0-9a-z]+", "")
    return table(spark, sf_dir, "documents").select("doc_id", k.alias("k")).where("k <> ''").select("doc_id", F.size(text.grams(F.col("k"))).cast("long").alias("n_grams"))


@query("""WITH p AS (SELECT DISTINCT p_name a FROM part), q AS (SELECT a, list_distinct([substr(k, CAST(i AS BIGINT), 3) for i in range(1, greatest(length(k) - 2, 1) + 1)]) g FROM (SELECT a, regexp_replace(lower(a), '[^0-9a-z]+', '', 'g') k FROM p))
SELECT x.a AS name_a, y.a AS name_b, len(list_intersect(x.g, y.g)) AS common, round(len(list_intersect(x.g, y.g)) / len(y.g), 6) AS candidate_overlap FROM q x JOIN q y ON x.a < y.a AND len(list_intersect(x.g, y.g)) > 0""")
def ngram_overlap(spark, sf_dir):
    """Pairs of part names that share a gram: an equi-join on grams, counted."""
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("a")).distinct()
    p = p.withColumn("g", text.grams(F.regexp_replace(F.lower("a"), "[^0-9a-z]+", "")))
    e = p.select("a", F.explode("g").alias("k"))
    pairs = e.select(F.col("a").alias("name_a"), "k").join(e.select(F.col("a").alias("name_b"), "k"), "k").where("name_a < name_b").groupBy("name_a", "name_b").agg(F.count(F.lit(1)).alias("common"))
    size = p.select(F.col("a").alias("name_b"), F.size("g").alias("n"))
    return pairs.join(size, "name_b").select("name_a", "name_b", "common", F.round(F.col("common") / F.col("n"), 6).alias("candidate_overlap"))


PAGE_KEYS = {"page": "page", "ref": "ref", "id": "id", "q": "query"}


@query("""SELECT page_id, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page, regexp_extract(url, '[?&]ref=([^&#]*)', 1) AS ref FROM pages""")
def qr_parse(spark, sf_dir):
    m = qr.parsed(F.col("url"), {"page": "page", "ref": "ref"})
    get = lambda k: F.coalesce(F.regexp_extract(F.try_element_at(m, F.lit(k)), "^[^#]*", 0), F.lit("")).alias(k)
    return table(spark, sf_dir, "pages").select("page_id", get("page"), get("ref"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, 4600000000000 + l_orderkey * 1000 + l_partkey b, floor(l_extendedprice) p FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE WHEN length(CAST(b AS VARCHAR)) BETWEEN 8 AND 14 THEN CAST(b AS VARCHAR) ELSE '' END AS qr_code_barcode, CAST(CAST(p AS BIGINT) AS VARCHAR) || '.00' AS price1_qr, p > 0 AND length(CAST(b AS VARCHAR)) BETWEEN 8 AND 14 AS valid FROM r""")
def qr_payload(spark, sf_dir):
    payload = F.expr("concat('https://q.example/t?b=', cast(4600000000000 + l_orderkey * 1000 + l_partkey as string), '&p1=', cast(cast(floor(l_extendedprice) as bigint) as string))")
    df = spread(table(spark, sf_dir, "lineitem")).select(*KEY, payload.alias("u")).withColumn("m", qr.parsed(F.col("u")))
    return df.select(*KEY, qr.value(F.col("m"), "qr_code_barcode").alias("qr_code_barcode"), qr.value(F.col("m"), "price1_qr").alias("price1_qr"), qr.valid(F.col("u"), F.col("m")).alias("valid"))


def candidates(spark, sf_dir):
    """Field candidates in long form, from lineitem: a track is an order, evidence a line."""
    li = spread(table(spark, sf_dir, "lineitem"))
    whole = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) / 10).cast("long")
    base = li.select(F.lit("v").alias("video_id"), F.col("l_orderkey").alias("track_id"), (F.col("l_linenumber") * 200).cast("long").alias("timestamp_ms"), F.lit("rapidocr").alias("engine"), F.lit("price_card").alias("zone"),
        F.when(F.col("l_linenumber") % 2 == 0, "tight_enhanced").otherwise("raw").alias("image_kind"), F.col("l_quantity").alias("q"), whole.alias("w"), F.floor(F.col("l_extendedprice") / 10).cast("long").alias("d"), F.round(F.col("l_discount") * 400).cast("int").alias("p"),
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("ordinal"))
    def one(field, value, source):
        return base.select("video_id", "track_id", F.lit(field).alias("field"), value.alias("value"), (1 + F.col("q") / 100).alias("score"), (F.col("q") / 50).alias("confidence"), F.lit(True).alias("valid"), "engine", "zone", "image_kind", "timestamp_ms", source.alias("source_text"), "ordinal")
    w, d, p = (F.col(c).cast("string") for c in "wdp")
    return one("price_card", w, F.concat(w, F.lit("° 99"))).unionByName(one("price_default", d, d)).unionByName(one("discount_amount", F.concat(F.lit("-"), p, F.lit("%")), F.concat(F.lit("-"), p, F.lit("%")))).unionByName(one("product_name", F.concat(F.lit("Товар "), (F.col("d") % 7).cast("string")), F.lit("")))


@query()
def election_submission(spark, sf_dir):
    """Candidates in long form to one row per track: discount, card, default, name."""
    c = candidates(spark, sf_dir)
    template = c.select("video_id", "track_id").distinct().withColumn("selected_ms", F.lit(400).cast("long"))
    return elections.submission(c, template, ["price_card", "price_default", "discount_amount", "product_name"])


@query("""WITH c AS (SELECT l_orderkey AS track_id, CAST(round(l_discount * 400) AS INT) p, 1 + l_quantity / 100 + CASE WHEN abs(l_linenumber * 200 - 400) <= 250 THEN 0.36 WHEN abs(l_linenumber * 200 - 400) <= 500 THEN 0.25 WHEN abs(l_linenumber * 200 - 400) <= 1000 THEN 0.05 ELSE -0.22 END
  + CASE WHEN l_linenumber % 2 = 0 THEN 0.05 ELSE 0 END s, abs(l_linenumber * 200 - 400) <= 500 near FROM lineitem),
g AS (SELECT track_id, p, max(s) + 0.09 * least(count(*), 6) + 0.10 * least(sum(CASE WHEN near THEN 1 ELSE 0 END), 4) v FROM c WHERE p BETWEEN 1 AND 90 GROUP BY 1, 2)
SELECT track_id, round(max(v), 6) AS value_score FROM g GROUP BY track_id""")
def consensus_discount(spark, sf_dir):
    rows = candidates(spark, sf_dir).where("field = 'discount_amount'").withColumn("selected_ms", F.lit(400).cast("long"))
    return elections.consensus_discount(rows, ["video_id", "track_id"]).select("track_id", F.round("value_score", 6).alias("value_score"))

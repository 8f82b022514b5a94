"""Metrics, look-ups, set operations and queue summaries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import missing, numparse
from ..operators import lookups, metrics, ordering
from ..sources.tables import table
from ._registry import query

def card():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


@query("""SELECT count(*) AS rows_count, round(100.0 * sum(CASE WHEN l_extendedprice IS NOT NULL THEN 1 ELSE 0 END) / count(*), 2) AS default_rate,
  coalesce(sum(CASE WHEN l_discount > 0 THEN 1 ELSE 0 END), 0) AS discounted, round(avg(l_extendedprice), 4) AS avg_default,
  round(avg(l_extendedprice * (1 - l_discount)), 4) AS avg_card, sum(CASE WHEN l_extendedprice * (1 - l_discount) > l_extendedprice THEN 1 ELSE 0 END) AS card_over_default FROM lineitem""")
def quality_metrics(spark, sf_dir):
    n = lambda c: F.coalesce(F.sum(c.cast("int")), F.lit(0))
    return table(spark, sf_dir, "lineitem").agg(
        F.count(F.lit(1)).alias("rows_count"), metrics.share(F.col("l_extendedprice").isNotNull()).alias("default_rate"), n(F.col("l_discount") > 0).alias("discounted"),
        F.round(F.avg("l_extendedprice"), 4).alias("avg_default"), F.round(F.avg(card()), 4).alias("avg_card"), n(card() > F.col("l_extendedprice")).alias("card_over_default"),
    )


@query("""SELECT count(*) AS jobs, coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 0) AS done, coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END), 0) AS queued,
  coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END), 0) AS running, round(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 4) AS avg_done FROM orders""")
def job_rollup(spark, sf_dir):
    n = lambda s: F.coalesce(F.sum((F.col("o_orderstatus") == s).cast("int")), F.lit(0))
    return table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("jobs"), n("F").alias("done"), n("O").alias("queued"), n("P").alias("running"), F.round(F.avg(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), 4).alias("avg_done"))


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 20")
def top_videos(spark, sf_dir):
    return metrics.by_key(table(spark, sf_dir, "lineitem"), "l_suppkey").orderBy(F.desc("n"), "l_suppkey").limit(20)


@query("""SELECT sum(CASE WHEN l_discount * 1000 >= 80 THEN 1 ELSE 0 END) AS big_discount, sum(CASE WHEN l_extendedprice > 50000 OR l_extendedprice * (1 - l_discount) > 50000 THEN 1 ELSE 0 END) AS huge_price,
  sum(CASE WHEN l_extendedprice * (1 - l_discount) > l_extendedprice THEN 1 ELSE 0 END) AS card_over_default,
  sum(CASE WHEN l_discount * 1000 >= 80 OR l_extendedprice > 50000 OR l_extendedprice * (1 - l_discount) > 50000 THEN 1 ELSE 0 END) AS suspicious FROM lineitem""")
def row_quality_flags(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    flags = metrics.suspicious(F.col("l_extendedprice") / 5, card() / 5, F.col("l_discount") * 1000)
    any_ = flags["big_discount"] | flags["huge_price"] | flags["card_over_default"]
    n = lambda c: F.sum(c.cast("int"))
    return df.agg(n(flags["big_discount"]).alias("big_discount"), n(flags["huge_price"]).alias("huge_price"), n(flags["card_over_default"]).alias("card_over_default"), n(any_).alias("suspicious"))


@query("""SELECT 'events' AS tab, round(100.0 * sum(CASE WHEN trim(coalesce(props, '')) IN ('', 'nan') THEN 0 ELSE 1 END) / count(*), 2) AS core_rate,
  round(100.0 * sum(CASE WHEN lower(trim(event_type)) IN ('', 'нет', 'no', 'none', 'null', 'nan') THEN 0 ELSE 1 END) / count(*), 2) AS metric_rate FROM events
 UNION ALL SELECT 'documents', round(100.0 * sum(CASE WHEN lower(trim(coalesce(source, ''))) IN ('', 'nan', 'none', 'null') THEN 0 ELSE 1 END) / count(*), 2),
  round(100.0 * sum(CASE WHEN lower(trim(lang)) IN ('', 'нет', 'no', 'none', 'null', 'nan') THEN 0 ELSE 1 END) / count(*), 2) FROM documents""")
def fill_rates(spark, sf_dir):
    def one(name, a, b):
        return table(spark, sf_dir, name).agg(metrics.share(~missing.core(F.col(a))).alias("core_rate"), metrics.share(~missing.metric(F.col(b))).alias("metric_rate")).select(F.lit(name).alias("tab"), "core_rate", "metric_rate")

    return one("events", "props", "event_type").unionAll(one("documents", "source", "lang"))


RAW = "concat(cast(cast(floor(l_extendedprice) as {int}) as {str}), ',', cast(cast(floor(l_discount * 100) as {int}) as {str}), ' x')"


@query(f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {RAW.format(int='bigint', str='varchar')} AS raw FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, try_cast(regexp_extract(replace(replace(raw, ' ', ''), ',', '.'), '-?\\d+(?:\\.\\d{{1,2}})?', 0) AS DOUBLE) AS rule_price,
  try_cast(trim(replace(raw, ',', '.')) AS DOUBLE) AS dedup_float, CASE WHEN try_cast(regexp_extract(replace(raw, ',', '.'), '\\d+(?:\\.\\d{{1,2}})?', 0) AS DOUBLE) BETWEEN 1 AND 100000 THEN try_cast(regexp_extract(replace(raw, ',', '.'), '\\d+(?:\\.\\d{{1,2}})?', 0) AS DOUBLE) END AS catalog_price,
  try_cast(regexp_replace(replace(raw, ',', '.'), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS service_number FROM r""")
def num_parse(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("raw", F.expr(RAW.format(int="bigint", str="string")))
    raw = F.col("raw")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", numparse.rule_price(raw).alias("rule_price"), numparse.dedup_float(raw).alias("dedup_float"), numparse.catalog_price(raw).alias("catalog_price"), numparse.service_number(raw).alias("service_number"))


@query("""WITH b AS (SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS last_order FROM orders GROUP BY o_custkey)
SELECT c_custkey, coalesce(last_order, -1) AS last_order FROM customer LEFT JOIN b ON c_custkey = o_custkey""")
def row_key_lookup(spark, sf_dir):
    last = ordering.last_by(table(spark, sf_dir, "orders").withColumn("last_order", F.col("o_orderkey")), ["o_custkey"], ["o_orderkey"], ["last_order"])
    c = table(spark, sf_dir, "customer")
    return c.join(last, c.c_custkey == last.o_custkey, "left").select("c_custkey", F.coalesce("last_order", F.lit(-1)).alias("last_order"))


@query("""WITH c AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) i FROM customer),
s AS (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) i FROM supplier)
SELECT c_custkey, s_suppkey FROM c LEFT JOIN s ON c_nationkey = s_nationkey AND c.i = s.i""")
def positional_fallback(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("g"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("g"))
    return lookups.positional(c, s, ["c_custkey"], ["s_suppkey"], ["g"]).select("c_custkey", "s_suppkey")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def semi_filter(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_filter(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey", "c_name")


ZONES = [("product_name", ["product_name"]), ("price_card", ["price_card", "price_discount"]), ("qr", ["qr_code_barcode", "price1_qr"])]


@query("""WITH z AS (SELECT * FROM (VALUES ('product_name', ['product_name']), ('price_card', ['price_card', 'price_discount']), ('qr', ['qr_code_barcode', 'price1_qr'])) t(zone, fields))
SELECT n_nationkey, zone, array_to_string(fields, '|') AS target_fields, list_contains(fields, 'price_card') AS has_card FROM nation CROSS JOIN z""")
def zone_cross(spark, sf_dir):
    zones = spark.createDataFrame(ZONES, "zone string, fields array<string>")  # a fixed list of zones
    return table(spark, sf_dir, "nation").crossJoin(F.broadcast(zones)).select("n_nationkey", "zone", F.array_join("fields", "|").alias("target_fields"), F.array_contains("fields", "price_card").alias("has_card"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment, '' AS phone FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, '', '' FROM supplier""")
def schema_union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return lookups.combined([c, s], ["id", "name", "segment", "phone"])


@query("""SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderpriority, o_orderdate, o_orderkey LIMIT 1""")
def queue_claim(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").orderBy("o_orderpriority", "o_orderdate", "o_orderkey").limit(1).select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))


@query("SELECT o_orderstatus AS status, count(*) AS n, sum(o_custkey % 3) AS attempts FROM orders GROUP BY o_orderstatus")
def queue_summary(spark, sf_dir):
    return metrics.queue_summary(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 3).alias("attempts")))


@query("""SELECT o_custkey, arg_max(o_orderkey, row(o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey""")
def latest_task(spark, sf_dir):
    out = ordering.elect(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate"])
    return out.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("""WITH p AS (SELECT o_custkey, least(1.0, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) / sum(o_totalprice)) AS p, count(*) * 60.0 AS e FROM orders GROUP BY o_custkey)
SELECT o_custkey, round(p, 6) AS progress, CASE WHEN p > 0 THEN round(e * (1 - p) / p, 4) END AS eta_s, CASE WHEN p > 0 THEN round(e * (1 - p) / p * (1 - CASE WHEN p < 0.25 THEN 0.35 ELSE 0.25 END), 4) END AS low_s FROM p""")
def eta_progress(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)).alias("d"), F.sum("o_totalprice").alias("t"), (F.count(F.lit(1)) * 60.0).alias("e"))
    out = g.withColumn("x", metrics.progress(F.col("d"), F.col("t"), F.col("e")))
    return out.select("o_custkey", F.round("x.progress", 6).alias("progress"), F.round("x.eta_s", 4).alias("eta_s"), F.round("x.low_s", 4).alias("low_s"))


@query("""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (ORDER BY value DESC, event_id) i FROM events WHERE value > 0) WHERE i <= 240""")
def uncertain(spark, sf_dir):
    return table(spark, sf_dir, "events").where("value > 0").orderBy(F.desc("value"), "event_id").limit(240).select("user_id", "event_id", "value")


@query("""WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) AS i FROM documents) SELECT doc_id, lang, CASE WHEN i <= 20 THEN 'valid' ELSE 'train' END AS split FROM r""")
def split_dataset(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    held = ordering.top_k(df, ["lang"], [F.col("n_chars"), F.col("doc_id")], 20).select("doc_id")
    return df.join(held.withColumn("h", F.lit(True)), "doc_id", "left").select("doc_id", "lang", F.when(F.col("h"), "valid").otherwise("train").alias("split"))


@query("""SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text, count(*) AS lines FROM conversations GROUP BY conv_id""")
def lines_rejoin(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return rows.select("conv_id", F.array_join(F.transform("t", lambda x: x["text"]), " ").alias("text"), F.size("t").cast("long").alias("lines"))


@query("""SELECT d AS day, status, n FROM (SELECT CAST(o_orderdate AS DATE) AS d, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1, 2)""")
def jobs_by_day(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_custkey AS worker, max(o_orderdate) AS last_seen, count(*) AS beats FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""")
def latest_heartbeats(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("worker")).agg(F.max("o_orderdate").alias("last_seen"), F.count(F.lit(1)).alias("beats"))
    return g.orderBy(F.desc("last_seen"), "worker").limit(25).withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))


@query("""SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) i FROM orders) WHERE i > 25""")
def retention_list(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    keep = orders.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(25).select("o_orderkey")  # 25 rows
    return orders.join(F.broadcast(keep), "o_orderkey", "left_anti").select("o_orderkey")


@query("""SELECT l_shipmode AS step, n FROM (SELECT l_returnflag || l_linestatus AS l_shipmode, count(*) n FROM lineitem GROUP BY 1)""")
def step_totals(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("step")).agg(F.count(F.lit(1)).alias("n"))

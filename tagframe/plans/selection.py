"""Row selection, diagnostics, name recovery, jobs, and library functions one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import extract, geometry, numparse, pricing, tail, text
from ..operators import dispatch, jobs, lookups, metrics, ordering, quality, recovery, rules, selection, wording
from ..sources.tables import table
from ._registry import query

ROWS = "SELECT 'v' || l_returnflag AS video_id, CAST(l_orderkey AS VARCHAR) AS track_id, CAST(l_linenumber AS VARCHAR) AS rank, l_linestatus AS zone, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount FROM lineitem"


def rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    c = F.col
    return li.select(F.concat(F.lit("v"), "l_returnflag").alias("video_id"), c("l_orderkey").cast("string").alias("track_id"), c("l_linenumber").cast("string").alias("rank"), c("l_linestatus").alias("zone"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")


@query(f"SELECT * FROM ({ROWS}) WHERE CAST(rank AS INT) <= 2")
def ranked_rows(spark, sf_dir):
    return selection.ranked(rows(spark, sf_dir), 2)


@query(f"WITH r AS ({ROWS}), k AS (SELECT DISTINCT video_id, CAST(track_id AS BIGINT) t FROM r ORDER BY 1, 2 LIMIT 50) SELECT r.* FROM r JOIN k ON r.video_id = k.video_id AND CAST(r.track_id AS BIGINT) = k.t")
def first_tracks(spark, sf_dir):
    return selection.first_tracks(rows(spark, sf_dir), 50)


@query(f"SELECT * FROM ({ROWS}) WHERE zone IN ('O')")
def zone_rows(spark, sf_dir):
    return selection.in_zones(rows(spark, sf_dir), ["O", " "])


@query(f"""SELECT video_id, track_id, arg_min(l_partkey, row(l_extendedprice, l_partkey, l_suppkey)) AS l_partkey, CAST(NULL AS VARCHAR) AS price_card, CAST(NULL AS VARCHAR) AS barcode
FROM ({ROWS}) WHERE rank = '1' GROUP BY video_id, track_id""")
def track_template(spark, sf_dir):
    df = rows(spark, sf_dir).select("video_id", "track_id", "rank", "l_partkey", F.struct("l_extendedprice", "l_partkey", "l_suppkey").alias("seen"))
    return selection.template(df, ["price_card", "barcode"], "seen").drop("rank")


SHIPPED = "SELECT l_orderkey AS track_id, l_linenumber AS timestamp_ms, l_partkey AS frame_index, max(l_extendedprice) AS p FROM lineitem GROUP BY 1, 2, 3"


@query(f"""WITH c AS ({SHIPPED}), n AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY p DESC, timestamp_ms, frame_index) AS candidate_rank, count(*) OVER (PARTITION BY track_id) AS track_candidates FROM c)
SELECT *, CAST(coalesce(max(CASE WHEN candidate_rank <= 2 AND p >= 20000 THEN 1 ELSE 0 END) OVER (PARTITION BY track_id), 0) AS INT) AS track_exported, CASE WHEN candidate_rank <= 2 AND p >= 20000 THEN 1 ELSE 0 END AS selected FROM n""")
def candidate_diagnostics(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("track_id"), F.col("l_linenumber").alias("timestamp_ms"), F.col("l_partkey").alias("frame_index")).agg(F.max("l_extendedprice").alias("p"))
    every = ordering.top_k(c, ["track_id"], [F.desc("p"), F.col("timestamp_ms"), F.col("frame_index")], 1 << 30, "candidate_rank")
    return selection.diagnostics(every, every.where("candidate_rank <= 2 and p >= 20000"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, printf('%.4f', l_discount) AS score, printf('%.2f', l_quantity) AS x_min FROM lineitem")
def serialised_rows(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_discount").alias("score"), F.col("l_quantity").alias("x_min"))
    return selection.serialised(df)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber = 1 AS accepted, l_linenumber = 1 OR l_returnflag = 'R' AS strong FROM lineitem")
def strong_identity(spark, sf_dir):
    ok, strong = selection.identity(F.when(F.col("l_returnflag") == "R", "46"), F.col("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ok.alias("accepted"), strong.alias("strong"))


@query("""WITH t AS (SELECT conv_id, role AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) i FROM conversations), f AS (SELECT conv_id, text, min(i) i FROM t WHERE i <= 13 GROUP BY 1, 2)
SELECT conv_id, string_agg(text, '|' ORDER BY i) AS pool FROM f GROUP BY conv_id""")
def text_pool(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text", "role"))).alias("t"))
    texts = F.transform("t", lambda x: x["role"])
    return t.select("conv_id", F.array_join(recovery.pool(F.element_at(texts, 1), F.slice(texts, 2, 1000)), "|").alias("pool"))


POOL = "SELECT l_orderkey AS track_id, l_linenumber * 1000000 + l_partkey AS ordinal, l_discount > 0.07 AS accepted, round(l_quantity / 50, 1) AS score, l_tax AS margin, 'n' || l_partkey AS name FROM lineitem"


def pool_matches(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("track_id"), (c("l_linenumber") * 1000000 + c("l_partkey")).alias("ordinal"), (c("l_discount") > 0.07).alias("accepted"), F.round(c("l_quantity") / 50, 1).alias("score"), c("l_tax").alias("margin"), F.concat(F.lit("n"), "l_partkey").alias("name"))


BEST = f"SELECT track_id, arg_max(name, row(accepted, score, margin, -ordinal)) AS name, bool_or(accepted) AS accepted FROM ({POOL}) GROUP BY track_id"


@query(BEST)
def best_of_pool(spark, sf_dir):
    return recovery.best_of_pool(pool_matches(spark, sf_dir), ["track_id"]).select("track_id", "name", "accepted")


@query(f"""WITH b AS ({BEST}), v AS (SELECT o_orderkey AS track_id, 'v' || o_custkey AS voted FROM orders WHERE o_orderstatus = 'F')
SELECT track_id, coalesce(voted, name) AS name, voted IS NOT NULL OR coalesce(accepted, false) AS accepted, CASE WHEN voted IS NULL THEN 'pool' ELSE 'vote' END AS decoder FROM b FULL JOIN v USING (track_id)""")
def recovered_names(spark, sf_dir):
    votes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("track_id"), F.concat(F.lit("v"), "o_custkey").alias("name"), (F.col("o_orderstatus") == "F").alias("accepted"))
    return recovery.recovered(votes, pool_matches(spark, sf_dir), ["track_id"])


@query("""WITH r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) % 7 DESC, turn, text) a, role AS text, CASE WHEN length(text) % 3 = 0 THEN 'c' || turn ELSE '' END country, CASE WHEN length(text) % 2 = 0 THEN 'u' || turn ELSE '' END unit, length(text) % 5 = 0 glass FROM conversations),
f AS (SELECT *, text <> '' AND row_number() OVER (PARTITION BY conv_id, text ORDER BY a) = 1 fresh FROM r),
d AS (SELECT *, max(country <> '') OVER w AND max(unit <> '') OVER w AND sum(fresh::INT) OVER w >= 2 AS done FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY a ROWS UNBOUNDED PRECEDING)),
e AS (SELECT *, NOT coalesce(lag(done) OVER (PARTITION BY conv_id ORDER BY a), false) AS seen FROM d)
SELECT conv_id, coalesce(arg_min(country, a) FILTER (seen AND country <> ''), '') AS country, coalesce(arg_min(unit, a) FILTER (seen AND unit <> ''), '') AS unit, max(glass) AS glass, string_agg(text, '|' ORDER BY a) FILTER (seen AND fresh) AS texts FROM e GROUP BY conv_id""")
def tail_lookup(spark, sf_dir):
    n = F.length("text")
    r = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", "text").alias("ordinal"), (n % 7).alias("score"), F.col("role").alias("text"), F.when(n % 3 == 0, F.concat(F.lit("c"), "turn")).otherwise("").alias("country"), F.when(n % 2 == 0, F.concat(F.lit("u"), "turn")).otherwise("").alias("unit"), (n % 5 == 0).alias("glass"))
    return recovery.tails(r, ["conv_id"], 2).withColumn("texts", F.array_join("texts", "|"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 3 = 0 THEN '' WHEN l_linenumber % 3 = 1 OR l_quantity = l_linenumber THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ',' || l_linenumber END AS prices FROM lineitem")
def entry_prices(spark, sf_dir):
    q, n = F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long")
    prices = recovery.entry_prices(F.when(n % 3 != 0, q), F.when(n % 3 == 2, n))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(prices.cast("array<string>"), ",").alias("prices"))


@query("""WITH r AS (SELECT substr(p_name, 1, 6) AS norm, list_sort(list_distinct(list(p_brand))) AS codes FROM part GROUP BY 1), q AS (SELECT p_partkey, substr(p_name, 1, 6) AS norm FROM part WHERE p_partkey % 3 = 0)
SELECT norm, p_partkey, array_to_string(codes, ',') AS codes FROM q JOIN r USING (norm)""")
def exact_codes(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("norm", F.substring("p_name", 1, 6))
    out = recovery.exact_codes(p.where("p_partkey % 3 = 0").select("norm", "p_partkey"), p.select("norm", F.col("p_brand").alias("code")))
    return out.withColumn("codes", F.array_join("codes", ","))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 4 = 1 THEN o_custkey * 1.0::DOUBLE WHEN (CASE WHEN o_custkey % 4 = 2 THEN o_totalprice ELSE o_totalprice / 2 END) >= o_custkey * 100 THEN (CASE WHEN o_custkey % 4 = 2 THEN o_totalprice ELSE o_totalprice / 2 END) - o_custkey * 100 ELSE 0 END AS seconds FROM orders""")
def job_seconds(spark, sf_dir):
    k, p = F.col("o_custkey"), F.col("o_totalprice")
    s = jobs.seconds(F.when(k % 4 == 1, k * 1.0).when(k % 4 == 3, 0.0), k * 100.0, F.when(k % 4 == 2, p).when(k % 4 == 0, 0.0), p / 2)
    return table(spark, sf_dir, "orders").select("o_orderkey", s.cast("double").alias("seconds"))


STATUS = {"F": "done", "O": "uploading", "P": "failed"}


@query("""WITH j AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'uploading' ELSE 'failed' END s, CAST(o_orderdate AS DATE) d, floor(o_totalprice / 1000) v FROM orders), t AS (SELECT max(d) m FROM j)
SELECT CAST(sum((s = 'uploading')::INT) AS BIGINT) AS queued, CAST(0 AS BIGINT) AS running, CAST(sum((s = 'done')::INT) AS BIGINT) AS done, CAST(sum((s = 'failed')::INT) AS BIGINT) AS failed,
 CAST(sum((s = 'done' AND d = m)::INT) AS BIGINT) AS today_done, CAST(sum((s = 'failed' AND d = m)::INT) AS BIGINT) AS today_failed, round(avg(v) FILTER (s = 'done' AND v > 0), 1) AS avg_processing_sec FROM j, t""")
def jobs_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    status = F.create_map(*(F.lit(x) for kv in STATUS.items() for x in kv))
    j = o.select(status[F.col("o_orderstatus")].alias("status"), F.to_date("o_orderdate").alias("day"), F.floor(F.col("o_totalprice") / 1000).alias("seconds"))
    last = j.agg(F.max("day").alias("last"))
    return jobs.summary(j.crossJoin(F.broadcast(last)), F.col("last"))  # one row


@query("SELECT o_orderkey, o_orderstatus AS status FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 12")
def latest_jobs(spark, sf_dir):
    return jobs.latest(table(spark, sf_dir, "orders"), [F.desc("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", F.col("o_orderstatus").alias("status"))


@query("""WITH RECURSIVE e AS (SELECT l_orderkey k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) i, ['queued', 'running', 'done', 'failed', 'running', 'queued', 'other'][l_linenumber] s FROM lineitem),
f AS (SELECT k, 0::BIGINT i, 'uploading' s FROM (SELECT DISTINCT k FROM e) UNION ALL
 SELECT e.k, e.i, CASE WHEN (f.s = 'uploading' AND e.s = 'queued') OR (f.s = 'queued' AND e.s IN ('running', 'failed')) OR (f.s = 'running' AND e.s IN ('done', 'failed', 'queued')) THEN e.s ELSE f.s END FROM f JOIN e ON e.k = f.k AND e.i = f.i + 1)
SELECT k AS job, arg_max(s, i) AS state FROM f GROUP BY k""")
def job_states(spark, sf_dir):
    names = F.array(*map(F.lit, ("queued", "running", "done", "failed", "running", "queued", "other")))
    at = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    e = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("job")).agg(F.collect_list(F.struct(at.alias("at"), F.element_at(names, F.col("l_linenumber").cast("int")).alias("state"))).alias("e"))
    return e.select("job", jobs.final_state(F.col("e")).alias("state"))


# ---------------------------------------------------------------- library functions


@query("""WITH b AS (SELECT l_partkey, l_suppkey, CAST(arg_max(l_orderkey, row(l_orderkey, l_linenumber)) AS VARCHAR) last, CAST(arg_min(l_orderkey, row(l_orderkey, l_linenumber)) AS VARCHAR) AS first FROM lineitem GROUP BY 1, 2), r AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
SELECT l_partkey, l_suppkey, CASE WHEN l_partkey % 5 = 0 THEN 'own' ELSE last END AS last_track, first AS first_track FROM r JOIN b USING (l_partkey, l_suppkey)""")
def row_tracks(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", F.col("l_orderkey").cast("string").alias("last_track"), F.col("l_orderkey").cast("string").alias("first_track"), F.struct("l_orderkey", "l_linenumber").alias("o"))
    keys = lookups.raw_key(("l_partkey", "l_suppkey"))
    r = li.select("l_partkey", "l_suppkey").distinct().withColumn("last_track", F.when(F.col("l_partkey") % 5 == 0, "own"))
    return lookups.looked_up(lookups.looked_up(r, li, keys, "last_track", "o"), li, keys, "first_track", "o", "first")


@query("""WITH a AS (SELECT l_suppkey, l_partkey, l_discount v FROM lineitem), b AS (SELECT CAST(round(x, 2) AS DECIMAL(20,2)) x, max(v) v FROM (SELECT l_partkey * 0.25 x, l_discount v FROM lineitem WHERE l_linenumber = 1) GROUP BY 1)
SELECT p_partkey, CAST(v AS VARCHAR) AS v FROM part LEFT JOIN b ON CAST(round(p_partkey * 0.25, 2) AS DECIMAL(20,2)) = x""")
def rounded_key_lookup(spark, sf_dir):
    key = lookups.rounded_key(2, ("file", "at", "x"))
    b = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.lit("a/b\\f.png").alias("file"), F.lit("1").alias("at"), (F.col("l_partkey") * 0.25).cast("string").alias("x"), F.col("l_discount").alias("v"))
    r = table(spark, sf_dir, "part").select("p_partkey", F.lit("c/f.png").alias("file"), F.lit("1").alias("at"), F.regexp_replace((F.col("p_partkey") * 0.25).cast("string"), "[.]", ",").alias("x"), F.lit(None).cast("double").alias("v"))
    return lookups.looked_up(r, b, key, "v", "v").select("p_partkey", F.col("v").cast("string").alias("v"))


@query("""WITH o AS (SELECT c_custkey k, c_name a, c_acctbal b FROM customer WHERE c_custkey % 3 < 2), n AS (SELECT c_custkey k, CASE WHEN c_custkey % 2 = 0 THEN 'new' END a FROM customer WHERE c_custkey % 3 > 0)
SELECT k, coalesce(n.a, o.a) AS a, b FROM o FULL JOIN n USING (k)""")
def merged_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.where("c_custkey % 3 < 2").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("a"), F.col("c_acctbal").alias("b"))
    new = c.where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, "new").alias("a"))
    return lookups.merged(old, new, ["k"])


@query("""SELECT event_id, value < 0.45 OR value / 2 < 0.45 AS name_uncertain, value < 0.55 OR value / 2 < 0.95 OR user_id % 2 = 0 AS price_uncertain, value < 0.45 AS other_uncertain FROM events""")
def uncertain_fields(spark, sf_dir):
    v, ok = F.col("value"), F.col("user_id") % 2 != 0
    u = lambda f: extract.uncertain(F.lit(f), F.lit("x"), v, v / 2, ok)
    return table(spark, sf_dir, "events").select("event_id", u("product_name").alias("name_uncertain"), u("price_card").alias("price_uncertain"), u("code").alias("other_uncertain"))


@query("SELECT event_id, CASE WHEN value <= 1 OR value >= 9 THEN 0 WHEN value <= 4 THEN (value - 1) / 3 ELSE (9 - value) / 5 END AS triangle, round(1 / (1 + exp(-(value - 3) / 2.0)), 9) AS sigmoid FROM events")
def score_shapes(spark, sf_dir):
    v = F.col("value")
    return table(spark, sf_dir, "events").select("event_id", pricing.triangle(v, 1.0, 4.0, 9.0).alias("triangle"), F.round(pricing.sigmoid(v, 3.0, 2.0), 9).alias("sigmoid"))


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, least(abs(l_quantity - l_linenumber * 5), abs(l_quantity - 30)) d FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN d <= 2 THEN 0.1 WHEN d <= 10 THEN 0.05 * (1 - (d - 2) / 8) ELSE -0.2 END, 9) AS bonus FROM d""")
def price_bonus(spark, sf_dir):
    b = pricing.observed_bonus(F.col("l_quantity"), F.array(F.col("l_linenumber") * 5.0, F.lit(30.0)), 2.0, 10.0, 0.1, 0.2)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(b, 9).alias("bonus"))


@query("""SELECT vec_id, round(sqrt(power(label + 5 - 10, 2) + power(label * 2 + 5 - 15, 2)), 6) AS distance, round(sqrt(power(label + 5 - 10, 2) + power(label * 2 + 5 - 15, 2)) / sqrt(200), 6) AS scaled FROM embeddings""")
def box_distance(spark, sf_dir):
    x = F.col("label").cast("double")
    a, b = (x, x * 2, x + 10, x * 2 + 10), tuple(map(F.lit, (5.0, 5.0, 15.0, 25.0)))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(geometry.centre_distance(a, b), 6).alias("distance"), F.round(geometry.scaled_distance(a, b), 6).alias("scaled"))


@query("""SELECT vec_id, greatest(0, round_even(label - 4 - 1.0, 0)) AS x_min, least(100, round_even(label + 6 + 1.0, 0)) AS x_max FROM embeddings""")
def padded_box(spark, sf_dir):
    x = F.col("label").cast("double")
    box = geometry.padded((x - 4, x, x + 6, x + 10), 0.1, F.lit(100.0), F.lit(100.0))
    return table(spark, sf_dir, "embeddings").select("vec_id", box[0].alias("x_min"), box[2].alias("x_max"))


@query("""SELECT p_partkey, array_to_string(list_filter(string_split(trim(regexp_replace(lower(p_name), '[^0-9a-z]+', ' ', 'g')), ' '), lambda t: length(t) >= 2), ' ') AS tokens, array_to_string(list_filter(string_split(trim(regexp_replace(lower(p_name), '[^0-9a-z]+', ' ', 'g')), ' '), lambda t: length(t) >= 4), ' ') AS long FROM part""")
def name_tokens(spark, sf_dir):
    n = F.col("p_name")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.tokens(n), " ").alias("tokens"), F.array_join(F.filter(F.split(text.normalized(n, unicode=True), " "), lambda t: F.length(t) >= 4), " ").alias("long"))


@query("""SELECT doc_id, replace(replace(replace(replace(replace(replace(source, 'O', '0'), 'o', '0'), 'I', '1'), 'l', '1'), 'S', '5'), 's', '5') AS digits FROM documents""")
def digit_noise(spark, sf_dir):
    kept = F.regexp_replace(F.regexp_replace(F.col("source"), "[ОоЗзБбg]", ""), "b", "b")
    return table(spark, sf_dir, "documents").select("doc_id", text.digit_noise(kept).alias("digits"))


@query("SELECT event_id, greatest(0.35, value / 32.0) AS scale FROM events")
def duration_scale(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", metrics.duration_scale(F.col("value")).alias("scale"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, coalesce(CASE WHEN l_returnflag = 'R' THEN 'r.png' END, CASE WHEN l_linestatus = 'O' THEN 'o.png' END) AS path FROM lineitem""")
def preferred_path(spark, sf_dir):
    r, o = F.when(F.col("l_returnflag") == "R", "r.png").otherwise(" "), F.when(F.col("l_linestatus") == "O", "o.png")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", quality.preferred(r, o).alias("path"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, trunc(l_extendedprice * 100) / 100 AS price, CAST(CASE WHEN floor(l_extendedprice) BETWEEN 1 AND 100000 THEN floor(l_extendedprice) END AS DOUBLE) AS catalog FROM lineitem WHERE l_extendedprice < 1000000""")
def parsed_numbers(spark, sf_dir):
    p = F.col("l_extendedprice")
    shown = F.format_string("%d,%02d", F.floor(p), F.floor(p * 100) % 100)
    return table(spark, sf_dir, "lineitem").where(p < 1000000).select("l_orderkey", "l_linenumber", "l_partkey", (F.floor(numparse.rule_price(shown) * 100 + 1e-6) / 100).alias("price"), numparse.catalog_price(F.concat(F.floor(p).cast("string"), F.lit(" 00"))).alias("catalog"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, s AS source, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS new FROM lineitem, (SELECT unnest(['qr_priority']) s) WHERE l_quantity <> l_linenumber""")
def qr_priority(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_linenumber").cast("string").alias("code"), F.col("l_quantity").cast("long").cast("string").alias("qr_code"))
    made = [r for r in rules.qr_priority(("code",)) if r.field == "code"]
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return rules.changes(rules.applied(df, made), keys).select(*keys, "source", "new")


@query("""WITH l AS (SELECT l_orderkey k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) - 1 AS i, CASE WHEN l_linenumber % 3 = 2 THEN CAST(l_quantity AS DOUBLE) END p FROM lineitem),
n AS (SELECT *, max(CASE WHEN p IS NOT NULL THEN i END) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) a, min(CASE WHEN p IS NOT NULL THEN i END) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) b FROM l)
SELECT n.k AS l_orderkey, n.i AS place, round(coalesce(n.p, x.p + (y.p - x.p) * (n.i - a) / (b - a), x.p + 0.01 * (n.i - a), y.p - 0.01 * (b - n.i), n.i), 4) AS filled
FROM n LEFT JOIN l x ON x.k = n.k AND x.i = n.a LEFT JOIN l y ON y.k = n.k AND y.i = n.b""")
def gap_fill(spark, sf_dir):
    known = F.when(F.col("l_linenumber") % 3 == 2, F.col("l_quantity").cast("double"))
    own = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", known.alias("p")))).alias("a"))
    out = own.select("l_orderkey", F.posexplode(wording.filled(F.col("a.p"))).alias("place", "filled"))
    return out.withColumn("filled", F.round("filled", 4))


@query()
def word_order(spark, sf_dir):
    """A part's name with type and brand before it, ordered by the reversed text."""
    base = F.concat_ws(" ", "p_type", "p_brand", "p_name")
    part = table(spark, sf_dir, "part").select("p_partkey", base.alias("base"))
    shown = part.select("p_partkey", F.lit(0).alias("ordinal"), F.array_join(F.reverse(F.split("base", " ")), " ").alias("text"))
    return wording.ordered(part, shown, ["p_partkey"])


@query()
def zone_candidates(spark, sf_dir):
    """Each document is the text of a zone with all target fields."""
    d = table(spark, sf_dir, "documents")
    tokens = F.array().cast("array<struct<text:string,confidence:double,box:array<array<double>>>>")
    rows = d.select("doc_id", F.lit("price_card").alias("zone"), F.lit("price_card|price_default|discount_amount|barcode|id_sku|print_datetime|code|product_name").alias("target_fields"), F.lit("easyocr").alias("engine"), F.lit(1).alias("rank"), tokens.alias("tokens"), "text", F.lit(1.0).alias("confidence"))
    return dispatch.quantised(dispatch.candidates(rows)).select("doc_id", "field_no", "field", "value", "valid", "confidence", "score")


@query("SELECT l_orderkey, l_linenumber, round_even(CAST(l_extendedprice AS DOUBLE) / 7, 4) AS score FROM lineitem")
def stored_scores(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return dispatch.quantised(li.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice").cast("double") / 7).alias("score")))


@query("SELECT p_partkey, p_name AS base, 'Россия' AS country, p_size || 'г' AS unit, p_name || CASE WHEN p_partkey % 2 = 0 THEN ' ст/б' ELSE '' END || ' (Россия) ' || p_size || 'г' AS restored FROM part")
def name_tails(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = F.concat(F.col("p_name"), F.when(F.col("p_partkey") % 3 == 0, " (Росия) ").otherwise(" (россия), "), F.col("p_size").cast("string"), F.lit(" гр"))
    out = part.select("p_partkey", tail.split(name).alias("t")).select("p_partkey", "t.*")
    return out.withColumn("restored", tail.restored(F.col("base"), F.col("country"), F.col("unit"), F.col("p_partkey") % 2 == 0))

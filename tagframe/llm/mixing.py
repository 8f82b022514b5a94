"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source's target is its weight's share of all words, at most ``most_epochs`` times its
own size; what exceeds goes to the others by weight until none is above (water filling:
targets are min(cap, level * weight) with one level).  A source's target is filled by
complete epochs first; the rest is a fractional epoch: documents in the order of the key
-ln(u) / quality, u a hash of the doc_id (so that reruns agree), are taken whole while their
prefix sum of sizes stays within the rest; the document that crosses it is taken when at
least half of it fits.

Prefix sums do not gather a source in one task: keys are dealt into as many buckets as a
source's documents ask for (about ``bucket_rows`` each); bucket totals are summed with
partial aggregation, windows over totals (of 1,000 buckets, then of buckets) find the one
bucket per source that the budget cuts, and rows are ordered inside that bucket only.
Sources are numbered by a range sort and their level is found by aggregates, so that
millions of sources (hosts) do not meet in one task; joins on a source are dealt by part, so
that a source with a third of all rows does not either.

Null texts count as empty (size 0; nothing is taken).  A null source is a source of its own,
last in order.  Ties of the key fall to doc_id, then to the text's hash; a null doc_id takes
part like any other.  Rows that repeat a document are taken independently of each other.  An
empty table gives no rows.  A kept column that has the name of a result column (doc_id, size,
source_size, target, taken) gives way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import byte_words, cut, dealt, each_part, parts_of

RESULT = ("doc_id", "size", "source_size", "target", "taken")


def quality(text: Column) -> Column:
    """A weight between 0.25 and 1: the share of ASCII lower-case letters and non-ASCII characters."""
    letters = F.coalesce(F.length(F.regexp_replace(text, "[\\x00-\\x60\\x7B-\\x7F]", "")), F.lit(0))
    return F.lit(0.25) + F.lit(0.75) * letters / F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1))


def uniform(key: Column) -> Column:
    """52 bits of an md5 as a number within (0, 1)."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``place``, from 0, in ``order``: ranges are sorted apart, their sizes added up."""
    ranges = cut(rows.orderBy(*order).withColumn("id", F.monotonically_increasing_id()), "ranges")
    part, at = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r.part, r.n) for r in ranges.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, rows_before = 0, {}
    for k, n in sizes:
        rows_before[k] = before
        before += n
    # One entry per range of the sort.
    start = F.create_map(*(F.lit(x) for k in rows_before for x in (k, rows_before[k]))) if sizes else F.lit(None).cast("map<bigint,bigint>")
    return ranges.withColumn("place", (start[part] + at).cast("long")).drop("id")


def targets(sizes: DataFrame, most_epochs: int = 3) -> DataFrame:
    """``sizes`` (source, source_size, ...) with weight and target; one row per source."""
    w = numbered(sizes, F.col("source").asc_nulls_last()).withColumn("weight", (F.pmod("place", F.lit(3)) + 1).cast("double"))
    w = w.drop("place").withColumn("cap", (F.col("source_size") * most_epochs).cast("double"))
    every = w.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, weight, level = float(every.words or 0), every.weight or 1.0, 0.0
    # Sources below the level are capped; what they leave raises it, until no further one is.
    capped, out = 0.0, 0.0
    while weight > out and (new := (words - capped) / (weight - out)) > level:
        level = new
        low = w.where(F.col("cap") / F.col("weight") < level).agg(F.sum("cap").alias("cap"), F.sum("weight").alias("weight")).first()
        capped, out = low.cap or 0.0, low.weight or 0.0
    return w.withColumn("target", F.least("cap", F.lit(level) * F.col("weight"))).drop("cap")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    *,
    most_epochs: int = 3,
    bucket_rows: int = 2_000,
    keep: list[str] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the columns of ``keep``, for every row."""
    text = F.col(text_col).cast("string")
    keep = [c for c in keep if c.lower() not in RESULT]
    source = F.col(source_col).cast("string")
    rows = docs.select(
        *(F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), source), F.lit("null")).alias("sid"),
        byte_words(text).alias("size"),
        (-F.log(uniform(F.col(id_col))) / quality(text)).alias("key"),
        F.xxhash64(text).alias("tie"),
    )
    rows = cut(rows.withColumn("part", dealt(F.concat_ws("|", "key", "tie"))), "mix")
    sizes = rows.groupBy("sid").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"), parts_of("part").alias("parts"))
    totals = targets(sizes.withColumn("source", F.when(F.col("sid") != "null", F.substring("sid", 2, 1 << 30))), most_epochs).drop("source")
    totals = totals.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    totals = totals.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    totals = cut(totals.withColumn("n_buckets", F.ceil(F.col("n_docs") / bucket_rows)), "sources")

    def beside(rows: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
        """A source's row is repeated for its parts, of which a large source has all."""
        return rows.join(found.withColumn("part", each_part("parts")).drop("parts"), ["sid", "part"], how)

    # 1 - exp(-key) is near uniform for weights near 1, and monotone in any case.
    bucket = F.least(F.floor((1 - F.exp(-F.col("key") * 0.8)) * F.col("n_buckets")), F.col("n_buckets") - 1)
    sums = beside(rows.select("sid", "part", "key", "size"), totals.select("sid", "parts", "n_buckets"))
    sums = cut(sums.groupBy("sid", bucket.alias("bucket")).agg(F.sum("size").alias("bucket_size")), "buckets")

    def crossed(sums: DataFrame, by: str) -> DataFrame:
        """sid, ``by``, before: the one of a source's sums in which its rest ends."""
        order = Window.partitionBy("sid").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.col("above"), F.lit(0)) + F.coalesce(F.sum("bucket_size").over(order), F.lit(0))
        return sums.withColumn("before", before).where("before <= rest and rest < before + bucket_size").select("sid", by, "before")

    thousand = F.floor(F.col("bucket") / 1000).alias("thousand")
    tops = sums.groupBy("sid", thousand).agg(F.sum("bucket_size").alias("bucket_size")).join(totals.select("sid", "rest"), "sid")
    top = crossed(tops.withColumn("above", F.lit(0)), "thousand").withColumnRenamed("before", "above")
    inner = sums.withColumn("thousand", thousand).join(top, ["sid", "thousand"]).join(totals.select("sid", "rest"), "sid")
    edge = crossed(inner, "bucket").withColumnRenamed("bucket", "edge")
    rows = beside(rows, cut(totals.join(edge, "sid", "left"), "edges")).withColumn("bucket", bucket)
    running = Window.partitionBy("sid", "bucket").orderBy("key", F.col("doc_id").asc_nulls_first(), "tie").rowsBetween(Window.unboundedPreceding, 0)
    out = [*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)), "doc_id", "size", "source_size", "target"]
    at_edge = rows.where("bucket = edge").withColumn("upto", F.col("before") + F.sum("size").over(running))
    half = F.col("upto") - F.col("size") / 2 <= F.col("rest")
    cut_rows = at_edge.select(*out, (F.col("size") * (F.col("epochs") + F.when(half, 1).otherwise(0))).cast("long").alias("taken"))
    below = F.col("edge").isNull() & (F.col("rest") > 0) | (F.col("bucket") < F.col("edge"))
    others = rows.where("edge is null or bucket <> edge").select(*out, (F.col("size") * (F.col("epochs") + F.when(below, 1).otherwise(0))).cast("long").alias("taken"))
    return others.unionAll(cut_rows)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) size,
    -ln((('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::UBIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / (0.25 + 0.75 * length(regexp_replace(coalesce(text, ''), '[\x00-\x60\x7B-\x7F]', '', 'g')) / greatest(length(coalesce(text, '')), 1)) k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 w FROM d GROUP BY source),
r AS (SELECT *, 3.0::DOUBLE * source_size cap, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST) i FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER b, 0))::DOUBLE / ((SELECT sum(w) FROM s) - coalesce(sum(w) OVER b, 0)) lv
      FROM r WINDOW b AS (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(lv, i) FROM l WHERE lv <= cap / w) * w, cap)) target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END ep FROM t),
o AS (SELECT d.doc_id, size, source_size, target, ep, target - ep * source_size rest,
        sum(size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id ROWS UNBOUNDED PRECEDING) upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) size, source_size, target, CAST(size * (ep + CASE WHEN rest > 0 AND upto - size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) taken FROM o
"""

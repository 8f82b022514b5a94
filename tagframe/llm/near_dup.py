r"""MinHash near-duplicates with odd sketches.

Plan
----
1. One scan turns each text into its set of word shingles (64-bit hashes), a MinHash
   signature folded into band keys, an odd sketch and a 128-bit signature of the set.
2. Documents with equal sets form one class; its smallest doc_id stands for it.  Copies
   are never expanded into pairs.
3. A bucket (documents with one band key) gives pairs with a pivot only: m - 1 pairs for
   m members.  The pivot is the member that meets most documents over all its buckets: of a
   text and its edited copies that is the text, which is nearer to all copies than they are to
   one another.  The odd sketches' XOR population count and the set sizes discard pairs, the
   rest is confirmed on the full sets.
4. Connected components of the links.  Buckets whose other members are then in more than
   one component hold pairs that may still be linked.  They are found from the
   differences to P, the most met member of the bucket's most frequent component (members
   linked with P count as that component's): of a linked pair X, Y at most
   a(X, Y) = |X| - t / (1 + t) * (|X| + |Y|) members of X are outside Y (t: the similarity).
   If X \ P has more members than that, some of them are in Y, hence in Y \ P, and the
   first a + 1 members of both differences share one, in any order that both follow: an
   equi-join on it.  The order is by how many documents of the pivot's have the member, rare
   ones first; a member that only one component has can join nothing, but takes its place
   among the a + 1.  Pairs in which both differences are small meet by cells of their sizes.
   Members of P's own component are never paired among themselves.  So no pair that shares a
   bucket is left out, and a large group of copies is linked through its pivot alone.
   A pivot with many members is dealt over several tasks (its row is repeated for each).

An odd sketch has a bit for each hash value; the bit's parity tells how many MinHash
samples (position, value) fell on it.  XOR of two sketches holds only the samples in
which they differ, so its population count P over n bits with k samples estimates
J = 1 + n / (4 k) * ln(1 - 2 P / n), most precisely near 1.

With 30 bands of 5 rows a pair of similarity 0.85 is missed by all bands with
probability (1 - 0.85^5)^30 = 2e-8; the sketch cut at 0.6 lies over 7 standard
deviations below 0.85.

Rows without words have an empty set and are linked with nothing.  A null text counts as
empty.  Rows that repeat a doc_id are documents of their own with that id; a null doc_id
can stand for no group: such a row takes the id of its copies, else null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import LOWER, SPACE, U64, cut, dealt, each_part, mix, odd_numbers, parts_of, slices, utf8, word_bounds, word_hashes

PARTS, PART_ROWS = 16, 256  # how a pivot's members are dealt


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, SPACE)
    words = word_hashes(data, starts, ends)
    keys = odd_numbers(width, 7)
    out = []
    if len(words) >= width:
        whole = words[: len(words) - width + 1] * keys[0]
        for j in range(1, width):
            whole = whole + words[j : len(words) - width + 1 + j] * keys[j]
        whole = mix(whole)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            s = np.sort(whole[a : b - width + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif b > a:
            part = np.sum(words[a:b] * keys[: b - a], dtype=U64) + U64(b - a)
            out.append(mix(np.array([part], U64)))
        else:
            out.append(np.zeros(0, U64))
    return out


def min_hashes(sets: list[np.ndarray], flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """(documents, samples) of minima; every set must have a member."""
    sizes = np.array([len(s) for s in sets])
    out = np.empty((len(sets), len(flips)), U64)
    a = 0
    while a < len(sets):  # blocks that stay in the processor's cache
        b = a + max(1, int(np.searchsorted(np.cumsum(sizes[a:]), 1 << 15)))
        values = np.concatenate(sets[a:b])
        at = np.append(0, np.cumsum(sizes[a:b])[:-1])
        work = np.empty_like(values)
        for i in range(len(flips)):
            np.bitwise_xor(values, flips[i], out=work)
            np.multiply(work, factors[i], out=work)
            np.minimum.reduceat(work, at, out=out[a:b, i])
        a = b
    return out


def odd_sketch(samples: np.ndarray, salts: np.ndarray, bits: int) -> np.ndarray:
    """(documents, bits / 64) words: the parity of the samples that fall on each bit."""
    spot = (mix(samples ^ salts) % U64(bits)).astype(np.int64)
    parity = np.zeros((len(samples), bits), np.uint8)
    rows = np.arange(len(samples))
    for i in range(samples.shape[1]):
        parity[rows, spot[:, i]] ^= 1
    return np.packbits(parity, axis=1, bitorder="little").view(np.int64)


SIGNED = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>, odd array<long>"


def signer(width: int, bands: int, rows: int, bits: int):
    def sign(batches):
        k = bands * rows
        flips, factors, salts = odd_numbers(k, 11), odd_numbers(k, 13), odd_numbers(k, 17)
        fold = odd_numbers(rows, 19)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                sets = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                s1, s2 = np.zeros(len(n), U64), np.zeros(len(n), U64)
                lists = [np.zeros((len(n), w), np.int64) for w in (bands, bits // 64)]
                if len(full):
                    own = [sets[i] for i in full]
                    at = np.append(0, np.cumsum(n[full])[:-1])
                    every = np.concatenate(own)
                    s1[full] = np.add.reduceat(mix(every + U64(3)), at)
                    s2[full] = np.add.reduceat(mix(every + U64(5)), at)
                    samples = min_hashes(own, flips, factors)
                    keys = (samples.reshape(len(full), bands, rows) * fold).sum(axis=2, dtype=U64)
                    lists[0][full] = mix(keys + odd_numbers(bands, 23)).view(np.int64)
                    lists[1][full] = odd_sketch(samples, salts, bits)
                arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.int64())) for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b].cast(pa.int64()), pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), *arrays],
                    ["doc_id", "n_shingles", "s1", "s2", "bands", "odd"],
                )

    return sign


def marks(ids: DataFrame, least_bits: int = 1 << 20, most_bits: int = 1 << 29) -> bytes:
    """A one-hash Bloom filter of a column ``node``: fixed memory of ``most_bits`` / 8 bytes at most.
    If it fills up it only passes more rows; joins decide."""
    n = ids.count()
    bits = min(most_bits, max(least_bits, 1 << int(np.ceil(np.log2(16 * n + 1)))))
    at = F.pmod(F.xxhash64("node"), F.lit(bits)) + 1
    parts = ids.groupBy(F.bitmap_bucket_number(at).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("b")).collect()
    out = bytearray(bits // 8)
    for r in parts:
        out[(r.k - 1) * 4096 : r.k * 4096] = r.b
    return bytes(out)


def setter(width: int, shipped):
    """Shingle sets of the rows whose id passes the filter; column 2 is the id's xxhash64."""

    def sets_of(batches):
        bitmap = np.frombuffer(shipped.value, np.uint8)
        for batch in batches:
            at = np.mod(batch.column(2).to_numpy(zero_copy_only=False), len(bitmap) * 8)
            rows = np.flatnonzero(bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            batch = batch.take(pa.array(rows))
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                sets = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                ends = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b].cast(pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["node", "hashes"])

    return sets_of


def outside(percent: int, parts: int = 16):
    """For (p, node, main, component, left, right): the node's set (right) against the pivot's (left).
    Gives all members outside the pivot, how many of them to look at, the cells of sizes, and
    whether the two are linked; a node linked with the pivot is of its component."""
    t = percent / 100
    step = np.log(1 / t) / parts

    def run(batches):
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            tokens, room_for, cells, signs, linked = [], [], [], [], []
            for i in range(len(left)):
                x, y = (c[i].values.to_numpy(zero_copy_only=False).view(U64) for c in (right, left))
                out = np.setdiff1d(x, y, assume_unique=True)
                n = len(x)
                linked.append(100 * (n - len(out)) >= percent * (len(y) + len(out)))
                tokens.append(out.view(np.int64))
                signs.append(np.add.reduce(x).view(np.int64))  # rows that repeat an id differ by it
                room_for.append(int((1 - t) * n + 1e-9) + 1)
                own = int(np.floor(np.log(n) / step))
                near = np.arange(own - parts - 1, own + parts + 2)
                # The partner's size is at least its cell's lower end.
                room = n - t / (1 + t) * (n + np.exp(near * step)) + 1e-6
                cells.append(near[len(out) <= room] * 100_000 + own)
            linked, longs = pa.array(linked, pa.bool_()), pa.list_(pa.int64())
            main = pc.or_(batch.column("main"), linked)
            same = [batch.column("p"), batch.column("node"), main, linked, pc.if_else(main, batch.column("p_component"), batch.column("component"))]
            yield pa.RecordBatch.from_arrays([*same, pa.array(tokens, longs), pa.array(room_for, pa.int64()), pa.array(signs, pa.int64()), pa.array(cells, longs)], ["p", "node", "main", "linked", "component", "tokens", "room", "sign", "cells"])

    return run


def joint(batches):
    """Intersections of sorted arrays of distinct hashes."""
    for batch in batches:
        left, right = batch.column("left"), batch.column("right")
        out = np.empty(len(left), np.int64)
        for i in range(len(left)):
            x, y = (c[i].values.to_numpy(zero_copy_only=False) for c in (left, right))
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            out[i] = np.count_nonzero(both[1:] == both[:-1])
        names = ["u", "v", "u_n", "v_n"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out)], [*names, "common"])


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable.  ``nodes`` names every node of ``links``.
    Labels spread over links and then jump to their label's label, so that rounds grow with
    the logarithm of a path's length."""
    edges = cut(links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = cut(edges.select(F.col("u").alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    while True:
        near = edges.join(labels, edges.v == labels.node).groupBy("u").agg(F.min("component").alias("m"))
        step = labels.join(near, labels.node == near.u).select("node", F.col("component").alias("was"), F.least("component", "m").alias("component"))
        jump = step.join(labels.select(F.col("node").alias("x"), F.col("component").alias("y")), step.component == F.col("x"))
        new = cut(jump.select("node", "was", F.least("component", "y").alias("component")), "labels")
        changed = new.where("was <> component").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            break
    return nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    percent: int = 85,
    width: int = 5,
    bands: int = 30,
    rows: int = 5,
    bits: int = 1024,
    min_estimate: float = 0.6,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; see the module's text.

    Two documents are linked when 100 * |A & B| >= percent * |A | B|.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = cut(texts.mapInArrow(signer(width, bands, rows, bits), SIGNED), "signed")
    classes = cut(signed.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("node")), "classes")
    # One row stands for each class.  A class is found again by its signature, an id may repeat.
    lead = signed.where("n_shingles > 0").join(classes.select("s1", "s2", "node"), ["s1", "s2"]).where("doc_id = node")
    lead = cut(lead.dropDuplicates(["node", "s1", "s2"]).select("node", "n_shingles", "odd", "bands"), "lead")

    sketch = lead.select("node", "n_shingles", "odd")
    apart = sum((F.bit_count(F.col("a_odd")[i].bitwiseXOR(F.col("b_odd")[i])) for i in range(bits // 64)), F.lit(0))
    # The estimate is at least min_estimate while the population count is at most this.
    most = bits / 2 * (1 - np.exp(-4 * bands * rows / bits * (1 - min_estimate)))

    def beside(pairs: DataFrame, left: DataFrame) -> DataFrame:
        """``pairs`` with the columns of ``left`` (by u), whose rows are repeated for each part s of u's pairs."""
        return pairs.join(pairs.select("u", "s").distinct().join(left, "u"), ["u", "s"])

    def likely(pairs: DataFrame) -> DataFrame:
        a, b = (sketch.select(F.col("node").alias(x), F.col("n_shingles").alias(f"{x}_n"), F.col("odd").alias(f"{y}_odd")) for x, y in (("u", "a"), ("v", "b")))
        both = beside(pairs, a).join(b, "v")
        fits = 100 * F.least("u_n", "v_n") >= percent * F.greatest("u_n", "v_n")
        return both.where(fits & (apart <= float(most))).select("u", "v", "s", "u_n", "v_n").distinct()

    def sets_of(nodes: DataFrame) -> DataFrame:
        """(node, hashes) of the wanted documents (and few others); texts are read again, not shuffled."""
        shipped = docs.sparkSession.sparkContext.broadcast(marks(nodes))
        own = texts.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id"))
        return cut(own.mapInArrow(setter(width, shipped), "node long, hashes array<long>"), "sets")

    def ends(pairs: DataFrame, *names: str) -> DataFrame:
        out = pairs.select(F.col(names[0]).alias("node"))
        for name in names[1:]:
            out = out.union(pairs.select(F.col(name).alias("node")))
        return cut(out.distinct(), "nodes")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links among ``pairs``, on full sets."""
        sets = sets_of(ends(pairs, "u", "v"))
        left, right = (sets.select(F.col("node").alias(x), F.col("hashes").alias(y)) for x, y in (("u", "left"), ("v", "right")))
        sums = beside(pairs.join(right, "v"), left).mapInArrow(joint, "u long, v long, u_n long, v_n long, common long")
        return cut(sums.where(100 * F.col("common") >= percent * (F.col("u_n") + F.col("v_n") - F.col("common"))).select("u", "v").distinct(), "links")

    def open_pairs(member: DataFrame, grouped: DataFrame, weight: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links with a component's most met member, and pairs of different components in one pivot's
        buckets that may be linked."""
        left = member.where("node <> pivot").join(grouped, "node")
        kinds = left.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
        best = F.max(F.struct("c", (-F.col("component")).alias("k")))
        keys = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("n"), best.alias("best")).where("n > 1").select("key", (-F.col("best.k")).alias("p_component"))
        # The new pivot need not be in the bucket.
        met = F.max(F.struct("weight", (-F.col("node")).alias("k")))
        lead = weight.join(grouped, "node").groupBy("component").agg((-met["k"]).alias("p")).withColumnRenamed("component", "p_component")
        keys = keys.join(lead, "p_component")
        rows = left.join(keys, "key").where("node <> p").select("p", "p_component", "node", "component", (F.col("component") == F.col("p_component")).alias("main"))
        rows = cut(rows.distinct(), "open")
        sets = sets_of(ends(rows, "p", "node"))
        left, right = (sets.select(F.col("node").alias(x), F.col("hashes").alias(y)) for x, y in (("p", "left"), ("node", "right")))
        rows = rows.join(right, "node").withColumn("s", F.pmod(F.xxhash64("node"), F.lit(PARTS)))
        rows = rows.join(rows.select("p", "s").distinct().join(left, "p"), ["p", "s"]).drop("s")
        shape = "p long, node long, main boolean, linked boolean, component long, tokens array<long>, room long, sign long, cells array<long>"
        rows = cut(rows.mapInArrow(outside(percent), shape), "outside")
        each = rows.select("p", "node", "main", "component", "room", "sign", F.explode("tokens").alias("k"))
        held = each.groupBy("p", "k").agg(F.count(F.lit(1)).alias("c"), (F.min("component") < F.max("component")).alias("joins"))
        rank = F.row_number().over(Window.partitionBy("p", "node", "sign").orderBy("c", "k"))
        rare = cut(each.join(held, ["p", "k"]).withColumn("rank", rank).where("rank <= room and joins"), "rare")
        got = None
        for name in ("tokens", "cells"):
            each = rare if name == "tokens" else rows.select("p", "node", "main", "component", F.explode(name).alias("k"))
            # A cell key holds (partner, own); the partner's is turned round.
            turned = F.col("k") if name == "tokens" else F.pmod(F.col("k"), F.lit(100_000)) * 100_000 + F.floor(F.col("k") / 100_000)
            other = each.where("not main").select("p", turned.alias("k"), F.col("node").alias("node_b"), F.col("component").alias("component_b"))
            for part in (each.where("main"), each.where("not main")):
                pairs = part.join(other, ["p", "k"]).where("component <> component_b")
                pairs = pairs.select(F.least("node", "node_b").alias("u"), F.greatest("node", "node_b").alias("v"), F.lit(0).alias("s"))
                got = pairs if got is None else got.union(pairs)
        return cut(rows.where("linked").select(F.col("p").alias("u"), F.col("node").alias("v")).distinct(), "links"), cut(got.distinct(), "tried")

    member = lead.select(F.explode("bands").alias("key"), "node", dealt(F.col("node"), PARTS).alias("s"))
    size = member.groupBy("key").agg(F.count(F.lit(1)).alias("m"), parts_of("s").alias("parts")).where("m > 1")
    member = cut(member.join(size.select("key", "m", each_part("parts", PARTS).alias("s")), ["key", "s"]), "met")
    weight = cut(member.groupBy("node").agg(F.sum("m").alias("weight")), "weight")
    met = F.max(F.struct("weight", (-F.col("node")).alias("k")))
    pivot = member.join(weight, "node").groupBy("key").agg((-met["k"]).alias("pivot"), parts_of("s").alias("parts"))
    member = cut(member.join(pivot.select("key", "pivot", each_part("parts", PARTS).alias("s")), ["key", "s"]), "buckets")
    pairs = member.where("node <> pivot").groupBy(F.col("pivot").alias("u"), F.col("node").alias("v")).agg(F.max("m").alias("m"))
    pairs = pairs.select("u", "v", F.pmod(F.xxhash64("v"), F.ceil(F.col("m") / PART_ROWS)).cast("int").alias("s"))
    links = confirmed(cut(likely(pairs), "pairs"))
    nodes = lead.select("node").distinct()
    grouped = cut(components(nodes, links), "groups")
    near, tried = open_pairs(member, grouped, weight)
    more = near.union(confirmed(cut(likely(tried), "pairs")))
    if more.limit(1).count():
        grouped = cut(components(nodes, links.union(more)), "groups")
    ids = classes.join(grouped, "node", "left").select("s1", "s2", "n_shingles", "component")
    out = signed.select("doc_id", "n_shingles", "s1", "s2").join(ids, ["s1", "s2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

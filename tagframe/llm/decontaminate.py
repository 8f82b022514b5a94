"""Benchmark decontamination with one Aho-Corasick automaton.

Test questions and answers are normalised (ASCII upper case lowered; words are runs of
ASCII letters, digits and non-ASCII bytes; one space between words) and cut into windows
of ``width`` consecutive words; an item of fewer words is one window.  All windows go into
one automaton.  Each document is normalised the same way and scanned once; matches are
mapped to word numbers and, through the words' byte offsets, to the original text.

Bound of the broadcast: the windows are shipped to the executors only up to
``most_chars`` characters in all; a larger benchmark is cut by window hash into as many
shards, each with its own automaton and scan, one after the other over each batch of rows,
and the hits are merged per document (by word number, so that a word hit in two shards counts
once).  Documents stay where they are: there is no shuffle.  A Python worker builds an
automaton once and keeps it for its next tasks (two at most; about 45 bytes a character).

Null and empty texts have no words; items without words have no window; repeated items
and repeated documents are treated row by row; items with equal windows all count.  Items
whose id is null hit like others and are together one item without a name: a null in
``items``, counted by n_items, left out of items_sha256.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import utf8, word_bounds

# A byte's normal form: letters lowered, digits and non-ASCII kept, the rest a space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
GAP = np.frombuffer(NORMAL, np.uint8) == 32


def windows(text: str | None, width: int = 10) -> list[str]:
    words = (text or "").encode().translate(NORMAL).split()
    cut = [words[i : i + width] for i in range(max(1, len(words) - width + 1))] if words else []
    return [b" ".join(w).decode() for w in cut]


def automaton(patterns: list[tuple[str, list[str]]]):
    """Keys carry a space on either side, so that they match whole words only."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, (window, _) in enumerate(patterns):
        found.add_word(f" {window} ", (i, window.count(" ") + 1))
    if patterns:
        found.make_automaton()
    return found


MACHINES: dict[str, object] = {}


def machine_of(name: str, shipped):
    """The automaton of a shard, built once in a worker process."""
    if name not in MACHINES:
        while len(MACHINES) > 1:
            del MACHINES[next(iter(MACHINES))]
        MACHINES[name] = automaton(shipped.value)
    return MACHINES[name]


SPANS = "hit_from array<long>, hit_to array<long>, byte_from array<long>, byte_to array<long>, items array<string>"
NAMES = ["doc_id", "text", "n_words", "hit_from", "hit_to", "byte_from", "byte_to", "items"]


def scanner(name: str, shipped, first: bool, last: bool):
    """One shard's scan: its hits beside those of the shards before it (none for the first one, whose input is
    doc_id and text); the last one lets go of the texts."""

    def scan(batches):
        patterns = shipped.value
        machine = machine_of(name, shipped)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            raw = data.tobytes()
            spans, counts, items = [], [], []
            for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                words = raw[a:b].translate(NORMAL).split()
                counts.append(len(words))
                hits = []
                if words and patterns:
                    text = f" {b' '.join(words).decode()} "
                    hits = list(machine.iter(text))
                if first:
                    before, ids = [], []
                else:
                    before = list(zip(batch.column(3)[row].as_py(), batch.column(4)[row].as_py()))
                    ids = batch.column(7)[row].as_py()
                if not hits:
                    spans.append(([], [], [], []) if first else tuple(batch.column(k)[row].as_py() for k in (3, 4, 5, 6)))
                    items.append(ids)
                    continue
                # A match ends at the space after its last word: spaces before it number the word.
                codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                spaces = np.cumsum(codes == 32)
                stop = np.array([spaces[end] for end, _ in hits]) - 1
                size = np.array([n for _, (_, n) in hits])
                begin, end, _ = word_bounds(data[a:b], np.array([0, b - a]), GAP)
                merged = joined([*zip((stop - size).tolist(), stop.tolist()), *before])
                spans.append(([x for x, _ in merged], [y for _, y in merged], [int(begin[x]) for x, _ in merged], [int(end[y - 1]) for _, y in merged]))
                items.append(sorted({x for i in {i for _, (i, _) in hits} for x in patterns[i][1]} | set(ids), key=lambda x: (x is not None, x or "")))
            longs = pa.list_(pa.int64())
            columns = [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(counts, pa.int64()), *(pa.array([s[k] for s in spans], longs) for k in range(4)), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(*(([c for i, c in enumerate(x) if i != 1] if last else x) for x in (columns, NAMES)))

    return scan


def joined(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Overlapping or adjoining spans as one, in order."""
    out: list[list[int]] = []
    for x, y in sorted(set(spans)):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return out


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(window, items): distinct windows with the ids of their items, as strings; a null id is kept as one."""

    def cut(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [(w, i) for i, t in zip(ids, texts) for w in windows(t, width)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], ["window", "item"])

    items = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return items.mapInArrow(cut, "window string, item string").groupBy("window").agg(F.sort_array(F.transform(F.collect_set(F.struct("item")), lambda x: x["item"])).alias("items"))


def shipped_windows(benchmark: DataFrame, id_col: str, text_col: str, width: int, most_chars: int) -> list:
    """Broadcasts of (window, items), each of about ``most_chars`` characters at most."""
    found = benchmark_windows(benchmark, id_col, text_col, width)
    length = F.length("window") + F.aggregate("items", F.lit(0), lambda a, x: a + F.coalesce(F.length(x), F.lit(0)))
    shards = max(1, -(-(found.agg(F.sum(length)).first()[0] or 0) // most_chars))
    out = []
    for k in range(shards):
        own = found.where(F.pmod(F.xxhash64("window"), F.lit(shards)) == k)
        out.append(benchmark.sparkSession.sparkContext.broadcast([(r.window, list(r["items"])) for r in own.collect()]))
    return out


def without_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, width: int = 10, most_chars: int = 4_000_000) -> DataFrame:
    """The rows of ``docs``, unchanged, in which no window occurs; one pass per shard, no shuffle."""
    at = docs.columns.index(text_col)

    def sieve(name, shipped):
        def run(batches):
            machine = machine_of(name, shipped)
            for batch in batches:
                data, offsets = utf8(batch.column(at))
                raw, keep = data.tobytes(), []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    words = raw[a:b].translate(NORMAL).split() if shipped.value else []
                    keep.append(not words or next(machine.iter(f" {b' '.join(words).decode()} "), None) is None)
                yield batch.filter(pa.array(keep, pa.bool_()))

        return run

    for shipped in shipped_windows(benchmark, item_col, item_text_col, width, most_chars):
        docs = docs.mapInArrow(sieve(uuid.uuid4().hex, shipped), docs.schema)
    return docs


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    *,
    width: int = 10,
    most_chars: int = 4_000_000,
) -> DataFrame:
    """For every row: doc_id, n_words, n_hit, items (sorted ids), spans (array of
    word_from, word_to, byte_from, byte_to of the original text; ends exclusive; disjoint)."""
    shards = shipped_windows(benchmark, item_col, item_text_col, width, most_chars)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    one = texts
    for k, shipped in enumerate(shards):
        last = k == len(shards) - 1
        one = one.mapInArrow(scanner(uuid.uuid4().hex, shipped, k == 0, last), ("doc_id long, n_words long, " if last else "doc_id long, text string, n_words long, ") + SPANS)
    one = one.withColumn("spans", F.arrays_zip(F.col("hit_from").alias("word_from"), F.col("hit_to").alias("word_to"), "byte_from", "byte_to"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["word_to"] - s["word_from"])
    return one.select("doc_id", "n_words", hit.alias("n_hit"), "items", "spans")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: The same result in SQL.  Words are numbered, windows are strings of consecutive words.
ORACLE = r"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w FROM benchmark),
v AS (SELECT DISTINCT item, least(len(w), 10) n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') s
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i FROM b WHERE len(w) > 0)),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w FROM documents),
p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) i FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n),
q AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') s FROM p),
h AS (SELECT q.doc_id, q.n, q.i, v.item FROM q JOIN v ON q.n = v.n AND q.s = v.s),
k AS (SELECT doc_id, count(DISTINCT j) n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) j FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) n_items, sha256(string_agg(item, ',' ORDER BY item)) s FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit, CAST(coalesce(n_items, 0) AS BIGINT) n_items,
  coalesce(t.s, sha256('')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)
"""

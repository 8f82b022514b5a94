"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features (vectorised over UTF-8 buffers): densities of a fixed insult lexicon, of words and
of word stems learned from labelled rows, the same after undoing obfuscation (digits and
signs for letters, separators within words), second-person words near lexicon hits,
capitals, punctuation, digits, repeated letters, obfuscated words, length.

Learning takes at most ``most_rows`` labelled rows (smallest hashes of doc_id; copies of a
text count once), in three parts by hash: one gives the lexicon (document counts of
words and stems among toxic and other rows), one fits the trees on features that use that
lexicon, one fits the calibration.  Scoring covers every row and its whole text; inputs of a
score are the text's features only.

A null or empty text scores like a text without words.  Rows with equal doc_ids are scored
row by row; a null doc_id is never labelled.  Without any labelled row of both classes every
score is the fixed lexicon's: 1 with a hit, else 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import LOWER, SPACE, U64, cut, lut, slices, utf8, word_bounds, word_hashes
from .trees import Forest, boosted, isotonic

# Common insults and second-person words of four languages.
INSULTS = (
    "idiot idiots moron morons stupid dumb dumbass loser losers pathetic scum worthless trash garbage clown disgusting imbecile "
    "jerk bastard asshole bitch fool creep pig freak coward liar retard hate kill die shut disgrace vermin filth "
    "idiote imbécile connard salope stupide crétin débile ordure minable abruti "
    "trottel arschloch dummkopf abschaum widerlich hurensohn vollidiot erbärmlich schwachkopf "
    "imbécil estúpido estúpida basura idiota asqueroso patético inútil cabrón gilipollas"
).split()
SECOND_PERSON = "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer sie tú ti tus usted ustedes vosotros".split()

WORD = ~(lut((48, 57), (65, 90), (97, 122), (128, 255)))  # what is not part of a word
LETTER = lut((65, 90), (97, 122), (128, 255))
UPPER, DIGIT = lut((65, 90)), lut((48, 57))
MARK = lut((33, 33), (63, 63))
PUNCTUATION = lut((33, 47), (58, 64), (91, 96), (123, 126))
JOINER = lut((42, 42), (45, 46), (95, 95))
LEET = LOWER.copy()
for _a, _b in zip(b"0134578@$!", b"oieastbasi"):
    LEET[_a] = _b
STEMS = (4, 5, 6)
# Bytes of text taken at once: the features hold about 80 bytes for each of them.
SLICE = 1 << 17


def kinds(data: np.ndarray, offsets: np.ndarray):
    """Word positions and, for whole words and each stem length, hashes (0: too short)."""
    starts, ends, first = word_bounds(data, offsets, WORD)
    hashes = [word_hashes(data, starts, ends)]
    for k in STEMS:
        h = word_hashes(data, starts, np.minimum(starts + k, ends))
        h[ends - starts <= k] = 0
        hashes.append(h)
    return starts, ends, first, hashes


def hashed(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return np.unique(word_hashes(np.frombuffer(b"".join(raw), np.uint8), np.append(0, ends[:-1]), ends))


def inside(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def totals(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    s = np.append(0, np.cumsum(flags, dtype=np.float64))
    return s[bounds[1:]] - s[bounds[:-1]]


@dataclass
class Lexicon:
    words: np.ndarray
    stems: list[np.ndarray]


def features(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    low = LOWER[data]
    n_bytes = np.maximum(np.diff(offsets), 1).astype(np.float64)
    starts, ends, first, hashes = kinds(low, offsets)
    n = np.maximum(np.diff(first), 1).astype(np.float64)
    fixed, you = inside(hashes[0], hashed(INSULTS)), inside(hashes[0], hashed(SECOND_PERSON))
    learned = inside(hashes[0], lexicon.words)
    stem = np.zeros(len(starts), bool)
    for h, known in zip(hashes[1:], lexicon.stems):
        stem |= inside(h, known)
    any_ = fixed | learned | stem
    # Second-person words up to five words away, within the text.
    sums = np.append(0, np.cumsum(you))
    i = np.arange(len(starts))
    doc = np.searchsorted(first, i, side="right") - 1
    lo, hi = np.maximum(i - 5, first[doc]), np.minimum(i + 6, first[doc + 1])
    near = any_ & (sums[hi] > sums[lo])
    upper_at = np.append(0, np.cumsum(UPPER[data]))
    shouted = (upper_at[ends] - upper_at[starts] == ends - starts) & (ends - starts >= 3)

    # Undo obfuscation: signs to letters, separators between letters dropped.
    letter = LETTER[data]
    between = np.zeros(len(data), bool)
    if len(data) > 2:
        between[1:-1] = letter[:-2] & letter[2:]
    # A text's first and last byte have no neighbours: the next text's aren't theirs.
    begins = offsets[:-1][np.diff(offsets) > 0]
    between[begins] = between[offsets[1:][np.diff(offsets) > 0] - 1] = False
    drop = JOINER[data] & between
    kept = np.append(0, np.cumsum(~drop))
    plain = LEET[data][~drop]
    p_starts, p_ends, p_first, p_hashes = kinds(plain, kept[offsets])
    p_hit = inside(p_hashes[0], hashed(INSULTS)) | inside(p_hashes[0], lexicon.words)
    for h, known in zip(p_hashes[1:], lexicon.stems):
        p_hit |= inside(h, known)
    same = np.zeros(len(data), bool)
    if len(data) > 2:
        same[2:] = letter[2:] & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2])
    same[begins] = same[np.minimum(begins + 1, len(data) - 1)] = False
    masked = (PUNCTUATION[data] | DIGIT[data]) & between

    hits = [totals(x, first) for x in (fixed, learned, stem, any_, near, you, shouted)]
    p_hits = totals(p_hit, p_first)
    counts = [totals(t, offsets) for t in (UPPER[data], MARK[data], PUNCTUATION[data], DIGIT[data], data >= 128, same, masked)]
    lines = totals(data == 10, offsets)
    cols = [*(h / n for h in hits), *(np.minimum(h, 20) for h in hits[:5]), p_hits / n, np.minimum(p_hits, 20), np.maximum(p_hits - hits[3], 0)]
    cols += [*(c / n_bytes for c in counts), np.log1p(n), lines / n, totals(ends - starts, first) / n]
    return np.stack(cols, axis=1)


def counter(batches):
    """Document counts of words and stems among the two classes: kind, hash, toxic, other."""
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        y = batch.column(1).to_numpy(zero_copy_only=False)
        for a, b in slices(offsets, 1 << 19):
            own = offsets[a : b + 1] - offsets[a]
            _, _, first, hashes = kinds(LOWER[data[offsets[a] : offsets[b]]], own)
            doc = np.repeat(np.arange(b - a), np.diff(first)).astype(U64)
            for kind, h in enumerate(hashes):
                keep = h != 0
                pairs = np.unique(np.stack([h[keep], doc[keep]], axis=1), axis=0)
                values, at = np.unique(pairs[:, 0], return_inverse=True)
                toxic = np.bincount(at.ravel(), y[a:b][pairs[:, 1].astype(np.int64)], len(values)).astype(np.int64)
                every = np.bincount(at.ravel(), minlength=len(values))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), kind, np.int32)), pa.array(values.view(np.int64)), pa.array(toxic), pa.array(every - toxic)], ["kind", "hash", "toxic", "other"])


def feature_rows(lexicon: Lexicon):
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in slices(offsets, SLICE):
                x = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lexicon)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([flat, *(batch.column(i)[a:b] for i in (1, 2))], ["x", "y", "part"])

    return run


@dataclass
class Model:
    lexicon: Lexicon
    forest: Forest | None
    knots: tuple[np.ndarray, np.ndarray] | None

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x = features(data, offsets, self.lexicon)
        if self.forest is None:
            return (x[:, 0] > 0).astype(float)
        return np.interp(self.forest.raw(x), *self.knots)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, most_rows: int = 20_000, most_words: int = 4_000) -> Model:
    """Learn from at most ``most_rows`` rows of ``labels`` (the caller leaves out held-out ones)."""
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    marked = marked.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(most_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # Bounded by most_rows, so the labels may be broadcast.
    sample = texts.join(F.broadcast(marked), "id").groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("y").alias("y"))
    sample = cut(sample.select("text", "y", F.pmod(F.xxhash64("h", F.lit(5)), F.lit(20)).cast("int").alias("part")), "sample")
    empty = Lexicon(np.zeros(0, U64), [np.zeros(0, U64)] * len(STEMS))
    sizes = {r.y: r.n for r in sample.where("part < 9").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model(empty, None, None)
    counts = sample.where("part < 9").select("text", "y").mapInArrow(counter, "kind int, hash long, toxic long, other long")
    counts = counts.groupBy("kind", "hash").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") + 0.1) / sizes[1]) - F.log((F.col("other") + 0.5) / sizes[0])
    top = counts.where(F.col("toxic") >= 3).withColumn("odds", odds).where("odds > 2.5").orderBy(F.desc("toxic"), F.desc("odds"), "kind", "hash").limit(most_words).collect()
    by = [np.sort(np.array([r["hash"] for r in top if r["kind"] == k], np.int64).view(U64)) for k in range(1 + len(STEMS))]
    lexicon = Lexicon(by[0], by[1:])
    rows = sample.where("part >= 9").select("text", "y", "part").mapInArrow(feature_rows(lexicon), "x array<double>, y int, part int").collect()
    if len({r.y for r in rows}) < 2:
        return Model(lexicon, None, None)
    rows.sort(key=lambda r: (r.part, r.y, r.x))
    x, y, part = np.array([r.x for r in rows]), np.array([r.y for r in rows], float), np.array([r.part for r in rows])
    # Calibration rows are out of the trees' sight where both sets hold both classes.
    apart = all(len(set(y[k])) == 2 for k in (part < 16, part >= 16))
    fit_on, hold = (part < 16, part >= 16) if apart else (part >= 0, part >= 0)
    forest = boosted(x[fit_on], y[fit_on])
    return Model(lexicon, forest, isotonic(forest.raw(x[hold]), y[hold]))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shipped.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, SLICE):
                s = own.score(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b].cast(pa.int64()), pa.array(s)], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; held-out rows teach nothing."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, unchanged, whose score is below ``threshold``; no shuffle.  Null and
    empty texts, which hold nothing toxic, stay whatever the model makes of them."""
    model = fit(docs, labels.where(~held_out(F.col(id_col))), id_col, text_col)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            s = [shipped.value.score(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets, SLICE)]
            yield batch.filter(pa.array((np.concatenate(s) < threshold) | (np.diff(offsets) == 0))) if s else batch

    return docs.mapInArrow(run, docs.schema)

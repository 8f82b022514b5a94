"""LM scoring by a subword lattice over an existing vocabulary.

A word's spelling probability sums over all segmentations into the vocabulary's pieces, by
a forward recursion in log space over UTF-8 bytes.  The first piece comes from the pieces
that open a word, the others from the pieces inside words and a stop; both distributions
sum to 1, and single bytes are always possible, so that every word has a probability.
The vocabulary's own scores weight the pieces (a score of -r, the rank, weighs 1 / (r + 2)).
Learning changes neither the pieces nor those scores: a piece's weight is ``score_weight``
times the vocabulary's plus the rest times the piece's expected share in the segmentations
of all distinct training words (``em_rounds`` rounds).

A whole word is one more arc of the lattice: with c training occurrences among N tokens it
weighs (c - d(c)) / N, d(1), d(2), d(3+) the modified Kneser-Ney discounts of the counts'
counts; what is taken off all words goes to spelling.  The end of a text is a token of its
own.  A text's words are drawn from an urn: ``urn`` balls of these probabilities, and one
more ball of a word each time it is drawn, so that p(w, n times) is the product of
(urn * p(w) + j), j < n, over that of (urn + i), i from 0 to the text's words.  The
probabilities of all texts' continuations sum to at most 1.

All of this is done for each class of training texts (their languages; texts without one are
a class), and a text's probability is the classes' mixture, with their shares of training
texts as weights: the language of a text to be scored is no input.  Costs grow in proportion
to the number of classes.

Scale: distinct words are counted with partial aggregation and scored once each.  The
``hot_words`` most frequent ones (a bound on the broadcast, by a histogram of counts)
are scored where the texts are; other words of each text are joined with the table of
words, so that no frequent word makes a hot key.  Words of over ``LONG`` bytes are spelled in
blocks (the same sums, in linear time and bounded memory); they teach spelling in parts of
``LONG`` bytes.

Null and empty texts are one token, the end.  Rows are scored one by one, so repeated rows
get equal scores.  A null doc_id is a training row.  Without training rows N is 0: base is
computed with N = V = 0, and one class spells with the vocabulary's scores alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import BASE, BASE_INVERSE, LOWER, SPACE, U64, cut, powers, slices, utf8, word_bounds

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Pieces:
    """For each class (0: opens a word, 1: inside): byte strings and starting weights."""

    names: list[list[bytes]]
    prior: list[np.ndarray]

    @staticmethod
    def load(path: str = TOKENIZER) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found: list[dict[bytes, float]] = [{}, {bytes([b]): 1e-7 for b in range(256)}]
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
                continue
            piece = model.id_to_piece(i)
            opens = piece.startswith("▁")
            name = piece[opens:].encode()
            score = model.get_score(i)
            if "▁" in piece[1:] or any(65 <= b <= 90 for b in name) or score < -1e8:
                continue
            found[0 if opens else 1][name] = 1 / (2 - score)
        found[0].setdefault(b"", 0.1)
        found[1][b"\n"] = 0.1  # the stop; no word holds a line feed
        names = [sorted(f) for f in found]
        prior = [np.array([f[n] for n in own]) for f, own in zip(found, names)]
        return Pieces(names, [p / p.sum() for p in prior])

    def tables(self):
        """For each class and length: sorted keys and the pieces' numbers."""
        out = []
        for own in self.names:
            by: dict[int, list[int]] = {}
            for i, name in enumerate(own):
                by.setdefault(len(name), []).append(i)
            each = {}
            for m, ids in by.items():
                if m:
                    data = np.frombuffer(b"".join(own[i] for i in ids), np.uint8).reshape(len(ids), m)
                    keys = ((data.astype(U64) + U64(1)) * powers(BASE, m - 1)[None, :m]).sum(axis=1, dtype=U64)
                    order = np.argsort(keys)
                    each[m] = (keys[order], np.array(ids)[order])
            out.append(each)
        return out


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the bytes' polynomial, and what takes a run's sum to its start."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(BASE, max(len(data) - 1, 0))[: len(data)], dtype=U64, out=sums[1:])
    return sums, powers(BASE_INVERSE, len(data))


def _hashed(run: np.ndarray) -> np.ndarray:
    return _sums(run)[0][-1:]


def find(keys: np.ndarray, table) -> np.ndarray:
    known, ids = table
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, ids[at], -1)


class Words:
    """Words laid end to end (none empty), with the pieces found at each byte."""

    def __init__(self, by, data: np.ndarray, offsets: np.ndarray):
        size = np.diff(offsets)
        self.order = np.argsort(-size, kind="stable")
        self.size = size = size[self.order]
        self.first = first = offsets[:-1][self.order]
        self.longest = int(size[0]) if len(size) else 0
        sums, back = _sums(data)
        end = np.repeat(offsets[1:], np.diff(offsets))  # of each byte's word
        self.opening, self.inside = {}, {}
        for m, table in by[1].items():
            if m <= self.longest:
                at = np.flatnonzero(np.arange(len(data)) + m <= end)
                own = np.full(len(data), -1)
                own[at] = find((sums[at + m] - sums[at]) * back[at], table)
                self.inside[m] = own
        for m, table in by[0].items():
            n = self.active(m)
            if n:
                self.opening[m] = find((sums[first[:n] + m] - sums[first[:n]]) * back[first[:n]], table)
        self.node = np.append(0, np.cumsum(size + 1))[:-1]

    def active(self, length: int) -> int:
        """Words (in order) of that length at least."""
        return int(np.searchsorted(-self.size, -length, side="right"))


def log_sum(stack: np.ndarray) -> np.ndarray:
    top = np.maximum(stack.max(axis=0), -1e300)
    with np.errstate(divide="ignore"):
        return top + np.log(np.exp(stack - top).sum(axis=0))


LONG = 256  # bytes


class Lattice:
    def __init__(self, pieces: Pieces):
        self.names, self.by = pieces.names, pieces.tables()
        self.stop = pieces.names[1].index(b"\n")
        self.open = pieces.names[0].index(b"")
        self.reach = max(self.by[1])  # bytes of the longest piece

    def words(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        return Words(self.by, data, offsets)

    def spelled(self, data: np.ndarray, offsets: np.ndarray, weights: list[list[np.ndarray]]) -> list[np.ndarray]:
        """For each model's weights: ln of each word's probability, words of any length."""
        size = np.diff(offsets)
        out = [np.empty(len(size)) for _ in weights]
        short, long = np.flatnonzero(size <= LONG), np.flatnonzero(size > LONG)
        if len(long):
            data_s, offsets_s = data[np.repeat(size <= LONG, size)], np.append(0, np.cumsum(size[short]))
        else:
            data_s, offsets_s = data, offsets
        words = self.words(data_s, offsets_s)
        for own, x in zip(weights, out):
            x[short] = self.run(words, own)
            for i in long.tolist():
                x[i] = self.long_word(data[offsets[i] : offsets[i + 1]], own)
        return out

    def long_word(self, word: np.ndarray, weights: list[np.ndarray], block: int = 1 << 14) -> float:
        """ln of one word's probability: the recursion over the arcs by their ends, rescaled on the way."""
        tiny, huge = 1e-120, 1e120
        alpha, scaled, unit = {0: float(weights[0][self.open])}, 0, 1.0
        opened = {m: float(weights[0][i]) for m, table in self.by[0].items() if (i := int(find(_hashed(word[:m]), table)[0])) >= 0 and m <= len(word)}
        for a in range(0, len(word), block):
            b, lo = min(a + block, len(word)), max(0, a - self.reach)
            part = word[lo:b]
            sums, back = _sums(part)
            arcs: list[list[tuple[int, float]]] = [[] for _ in range(b - a)]
            for m, table in self.by[1].items():
                if m <= len(part):
                    at = np.arange(max(0, a - lo - m + 1), len(part) - m + 1)
                    own = find((sums[at + m] - sums[at]) * back[at], table)
                    ok = own >= 0
                    for i, p in zip((at[ok] + lo).tolist(), weights[1][own[ok]].tolist()):
                        arcs[i + m - a - 1].append((i, p))
            for j, own in enumerate(arcs, a + 1):
                total = opened.get(j, 0.0) * unit
                for i, p in own:
                    total += alpha[i] * p
                alpha[j] = total
                alpha.pop(j - self.reach, None)
                if total < tiny:
                    alpha = {i: x * huge for i, x in alpha.items()}
                    scaled, unit = scaled + 1, unit * huge if unit < 1e180 else unit
        return math.log(alpha[len(word)]) - scaled * math.log(huge) + math.log(weights[1][self.stop])

    def run(self, w: Words, weights: list[np.ndarray], counts: list[np.ndarray] | None = None) -> np.ndarray:
        """ln of each word's probability; adds expected piece counts to ``counts``."""
        log = [np.append(np.log(x), -np.inf) for x in weights]
        node, first, size = w.node, w.first, w.size
        logs = {m: log[1][i] for m, i in w.inside.items()}
        alpha = np.full(int((size + 1).sum()), -np.inf)
        alpha[node] = log[0][self.open]
        for j in range(1, w.longest + 1):
            n = w.active(j)
            rows = [alpha[node[:n] + (j - m)] + logs[m][first[:n] + (j - m)] for m in logs if m <= j]
            if j in w.opening:
                rows.append(log[0][w.opening[j]])
            alpha[node[:n] + j] = log_sum(np.stack(rows))
        total = alpha[node + size] + log[1][self.stop]
        if counts is not None:
            beta = np.full(len(alpha), -np.inf)
            beta[node + size] = log[1][self.stop]
            for j in range(w.longest - 1, -1, -1):
                n = w.active(j + 1)
                rows = []
                for m in logs:
                    if k := w.active(j + m):
                        row = np.full(n, -np.inf)
                        row[:k] = beta[node[:k] + (j + m)] + logs[m][first[:k] + j]
                        rows.append(row)
                beta[node[:n] + j] = log_sum(np.stack(rows))
            each = np.repeat(np.arange(len(size)), size)
            j = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
            byte, at = first[each] + j, node[each] + j
            for m in logs:
                own = w.inside[m][byte]
                ok = np.flatnonzero(own >= 0)
                p = np.exp(alpha[at[ok]] + logs[m][byte[ok]] + beta[at[ok] + m] - total[each[ok]])
                counts[1] += np.bincount(own[ok], p, len(counts[1]))
            for m, own in w.opening.items():
                ok = np.flatnonzero(own >= 0)
                p = np.exp(log[0][own[ok]] + beta[node[ok] + m] - total[ok])
                counts[0] += np.bincount(own[ok], p, len(counts[0]))
            counts[0][self.open] += np.exp(log[0][self.open] + beta[node] - total).sum()
            counts[1][self.stop] += len(size)
        out = np.empty(len(size))
        out[w.order] = total
        return out


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of texts laid end to end, and the index of each text's first one."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, SPACE)
    packed = data[~SPACE[data]]
    ends_in = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_in), pa.py_buffer(packed)])
    return words, first


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counter(n_classes: int):
    """Of texts with their class (-1: held out): word, seen, and trained by class."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            kind = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in slices(offsets, 1 << 22):
                words, first = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                coded = words.dictionary_encode()
                index = coded.indices.to_numpy(zero_copy_only=False)
                own = np.repeat(kind[a:b], np.diff(first))
                n = len(coded.dictionary)
                counts = [np.bincount(index, minlength=n), *(np.bincount(index[own == k], minlength=n) for k in range(n_classes))]
                yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.binary()), *(pa.array(c, pa.int64()) for c in counts)], ["word", "seen", *(f"c{k}" for k in range(n_classes))])

    return run


def utf8_binary(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    col = col.cast(pa.large_binary())
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


SLICE = 1 << 18


def expected(shipped):
    """Of words with counts by class: (class, piece, n), the expected counts over distinct words."""

    def run(batches):
        pieces, weights = shipped.value
        lattice = Lattice(pieces)
        counts = [[np.zeros(len(n)) for n in pieces.names] for _ in weights]
        for batch in batches:
            for k, own in enumerate(weights):
                at = np.flatnonzero(batch.column(1 + k).to_numpy(zero_copy_only=False))
                if len(at):
                    data, offsets = utf8_binary(batch.column(0).take(pa.array(at)))
                    if len(offsets) > 1 and np.diff(offsets).max() > LONG:
                        offsets = np.unique(np.concatenate([offsets, *(np.arange(x, y, LONG) for x, y in zip(offsets[:-1], offsets[1:]) if y - x > LONG)]))
                    for a, b in slices(offsets, SLICE):
                        lattice.run(lattice.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), own, counts[k])
        for k, both in enumerate(counts):
            flat = np.concatenate(both)
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at, pa.int64()), pa.array(flat[at])], ["k", "piece", "n"])

    return run


@dataclass
class Class:
    """Tokens, texts and, for counts 1, 2 and 3 or more, discounts of a class of training texts."""

    n: int
    texts: int
    discounts: np.ndarray
    spell: float

    @staticmethod
    def of(counts: list[int], total: int, types: int, texts: int) -> Class:
        """counts: how many words occur once, twice, three and four times."""
        n1, n2, n3, n4 = (max(c, 1) for c in counts)
        d = n1 / (n1 + 2 * n2)
        cuts = np.clip([1 - 2 * d * n2 / n1, 2 - 3 * d * n3 / n2, 3 - 4 * d * n4 / n3], [0.1, 0.2, 0.3], [0.9, 1.8, 2.7])
        n = total + texts
        off = cuts @ [counts[0], counts[1], types - counts[0] - counts[1]]
        return Class(n, texts, cuts, off / n if n and off > 0 else 1.0)

    def log_words(self, c: np.ndarray, ln: np.ndarray) -> np.ndarray:
        known = np.maximum(c - np.append(0, self.discounts)[np.minimum(c, 3).astype(int)], 0) / max(self.n, 1)
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(known), ln + math.log(self.spell)) / math.log(10)

    def log_end(self) -> float:
        return math.log10(self.texts / self.n) if self.texts else 0.0


def spelled(shipped, n_tokens: int, n_types: int):
    def run(batches):
        pieces, weights, classes = shipped.value
        lattice = Lattice(pieces)
        for batch in batches:
            data, offsets = utf8_binary(batch.column(0))
            counts = [batch.column(2 + k).to_numpy(zero_copy_only=False) for k in range(len(classes))]
            scores: list[list[np.ndarray]] = [[] for _ in classes]
            for a, b in slices(offsets, SLICE):
                for k, ln in enumerate(lattice.spelled(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], weights)):
                    scores[k].append(classes[k].log_words(counts[k][a:b], ln))
            c = sum(counts)
            base = np.log10((c + 1) / (n_tokens + n_types + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(c), pa.array(base), *(pa.array(np.concatenate(x) if x else np.zeros(0)) for x in scores)], ["word", "seen", "trained", "base", *(f"s{k}" for k in range(len(classes)))])

    return run


def log_draws(urn: float, n: int) -> float:
    """log10 of the product of urn + i, i < n."""
    return (math.lgamma(urn + n) - math.lgamma(urn)) / math.log(10)


def split_texts(shipped, ends: list[float], known_end: bool, urn: float):
    """Per text one row with its id and what the frequent words give, and one for each other word.
    ends: base and the classes' scores of the end."""

    def run(batches):
        hot, c, base, scores = shipped.value
        hot = pa.array(hot, pa.large_binary())
        known, balls = (c > 0).astype(np.int64), [urn * 10**x for x in scores]
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            row_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b in slices(offsets, 1 << 21):
                words, first = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                coded = words.dictionary_encode()
                spot = pc.index_in(coded.dictionary, value_set=hot).fill_null(-1).to_numpy(zero_copy_only=False)
                n_words, n = max(len(coded.dictionary), 1), b - a
                pairs, times = np.unique(np.repeat(np.arange(n), np.diff(first)) * n_words + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
                text, word = pairs // n_words, pairs % n_words
                at, rare = spot[word], spot[word] < 0
                # Draws of frequent words: the first of each, then the others by their number.
                own, where, each = text[~rare], at[~rare], times[~rare]
                sums = [np.bincount(own, known[where] * each, n), np.bincount(own, base[where] * each, n)]
                more = each > 1
                again = np.repeat(np.flatnonzero(more), each[more] - 1)
                number = np.arange(len(again)) - np.repeat(np.cumsum(each[more] - 1) - (each[more] - 1), each[more] - 1) + 1
                for x, ball in zip(scores, balls):
                    drawn = np.bincount(own, x[where] + math.log10(urn), n)
                    sums.append(drawn + np.bincount(own[again], np.log10(ball[where[again]] + number), n))
                below = np.array([log_draws(urn, k) for k in np.diff(first).tolist()])
                # A key with a space is no word: a text's own row meets nothing in the join.
                keys = pa.array([b" %d" % r for r in row_ids[a:b].tolist()], pa.binary())
                rows = pa.concat_arrays([keys, coded.dictionary.take(pa.array(word[rare])).cast(pa.binary())])
                ids = np.concatenate([row_ids[a:b], row_ids[a + text[rare]]])
                z = np.zeros(int(rare.sum()))
                docs = pa.concat_arrays([batch.column(1)[a:b], pa.nulls(len(z), pa.int64())])
                longs = [np.concatenate([np.zeros(n), times[rare]]), np.concatenate([np.diff(first) + 1, z]), np.concatenate([sums[0] + known_end, z])]
                doubles = [np.concatenate([sums[1] + ends[0], z]), *(np.concatenate([x + e - below, z]) for x, e in zip(sums[2:], ends[1:]))]
                names = ["row", "doc_id", "word", "times", "n_tokens", "n_known", "base_0", *(f"s{k}_0" for k in range(len(doubles) - 1))]
                yield pa.RecordBatch.from_arrays([pa.array(ids), docs, rows, *(pa.array(x.astype(np.int64)) for x in longs), *(pa.array(x) for x in doubles)], names)

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = "lang", *, tokenizer: str = TOKENIZER, em_rounds: int = 2, score_weight: float = 0.05, urn: float = 3000.0, hot_words: int = 150_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    kind = F.col(class_col).cast("string") if class_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), kind.alias("kind"))
    top = rows.where(~held_out(F.col("doc_id"))).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    top = top.where("kind is not null").orderBy(F.desc("n"), "kind").collect()
    named = F.create_map(*(x for k, r in enumerate(top) for x in (F.lit(r.kind), F.lit(k)))) if top else F.lit(None).cast("map<string,int>")
    number = F.coalesce(named[F.coalesce("kind", F.lit(""))], F.lit(len(top)))  # the last is of texts without a language
    number = F.when(held_out(F.col("doc_id")), F.lit(-1)).otherwise(number).cast("int")
    rows = rows.select("doc_id", "text", number.alias("class"))
    texts = {r["class"]: r.n for r in rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_classes = len(top) + (texts.get(len(top), 0) > 0 or not top)

    cs = [f"c{k}" for k in range(n_classes)]
    found = rows.select("text", "class").mapInArrow(word_counter(n_classes), ", ".join(["word binary", "seen long", *(f"{c} long" for c in cs)]))
    words = cut(found.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("seen", *cs))), "words")
    sums = [F.sum(c).alias(f"{c}_n") for c in cs] + [F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_v") for c in cs]
    sums += [F.sum((F.col(c) == i).cast("long")).alias(f"{c}_{i}") for c in cs for i in (1, 2, 3, 4)]
    trained = sum((F.col(c) for c in cs[1:]), F.col(cs[0]))
    s = words.agg(F.sum((trained > 0).cast("long")).alias("v"), *sums).first().asDict()
    s = {k: v or 0 for k, v in s.items()}
    classes = [Class.of([s[f"{c}_{i}"] for i in (1, 2, 3, 4)], s[f"{c}_n"], s[f"{c}_v"], texts.get(k, 0)) for k, c in enumerate(cs)]
    ends = sum(c.texts for c in classes)
    n_tokens, n_types = sum(c.n for c in classes), s["v"] + (ends > 0)

    pieces = Pieces.load(tokenizer)
    weights = [pieces.prior for _ in classes]
    for _ in range(em_rounds):
        shipped = spark.sparkContext.broadcast((pieces, weights))
        got = words.where(trained > 0).select("word", *cs).mapInArrow(expected(shipped), "k int, piece long, n double").groupBy("k", "piece").agg(F.sum("n").alias("n")).collect()
        counts = [np.zeros(sum(map(len, pieces.prior))) for _ in classes]
        for r in got:
            counts[r.k][r.piece] += r.n
        shares = [np.split(c, [len(pieces.prior[0])]) for c in counts]
        weights = [[score_weight * q + (1 - score_weight) * (p / p.sum() if p.sum() else q) for p, q in zip(own, pieces.prior)] for own in shares]
    shipped = spark.sparkContext.broadcast((pieces, weights, classes))
    ss = [f"s{k}" for k in range(n_classes)]
    scored = words.mapInArrow(spelled(shipped, n_tokens, n_types), ", ".join(["word binary", "seen long", "trained long", "base double", *(f"{x} double" for x in ss)]))
    scored = cut(scored, "scored")

    # The most frequent words, as many whole classes of counts as have room.
    bucket = F.floor(F.log2("seen") * 8)
    histogram = scored.where("length(word) <= 64").groupBy(bucket.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, room = None, hot_words
    for r in sorted(histogram, key=lambda r: -r.k):
        room -= r.n
        if room < 0:
            break
        least = r.k
    hot = scored.where((F.length("word") <= 64) & (bucket >= least)).select("word", "trained", "base", *ss).toArrow() if least is not None else None
    columns = [hot.column(i).combine_chunks().to_numpy(zero_copy_only=False) for i in range(1, 3 + n_classes)] if hot is not None else [np.zeros(0)] * (2 + n_classes)
    shipped = spark.sparkContext.broadcast((hot.column(0).to_pylist() if hot is not None else [], columns[0], columns[1], columns[2:]))
    at_end = [math.log10((ends + 1) / (n_tokens + n_types + 1)), *(c.log_end() for c in classes)]

    schema = ["row long", "doc_id long", "word binary", "times long", "n_tokens long", "n_known long", "base_0 double", *(f"{x}_0 double" for x in ss)]
    # A text's rows are all made by one task, its id among them: nothing is matched by the number later on.
    texts_of = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    parts = texts_of.mapInArrow(split_texts(shipped, at_end, ends > 0, urn), ", ".join(schema))
    joined = parts.join(scored.select("word", "trained", "base", *ss), "word", "left")
    times = F.col("times")

    def draws(x: str) -> Column:
        """As for frequent words, log10 of the product of urn * p + j, j < times."""
        ball = F.lit(urn) * F.pow(F.lit(10.0), F.col(x))
        again = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(times - 1, F.lit(1))), F.lit(0.0), lambda a, j: a + F.log10(ball + j))
        return F.when(F.col(x).isNull(), 0.0).otherwise(F.col(x) + math.log10(urn) + F.when(times > 1, again).otherwise(0.0))

    sums = joined.groupBy("row").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("trained") > 0, times).otherwise(0)).alias("n_known"),
        F.max("doc_id").alias("doc_id"),
        F.sum(F.col("base_0") + times * F.coalesce("base", F.lit(0.0))).alias("base_score"),
        *(F.sum(F.col(f"{x}_0") + draws(x)).alias(x) for x in ss),
    )
    # log10 of the mixture, from the largest part.
    parts = [F.col(x) + math.log10(max(c.texts, 0.5) / max(ends, 1)) for x, c in zip(ss, classes)]
    top_part = F.greatest(*parts) if n_classes > 1 else parts[0]
    total = top_part + F.log10(sum((F.pow(F.lit(10.0), p - top_part) for p in parts[1:]), F.pow(F.lit(10.0), parts[0] - top_part)))
    return sums.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", total.alias("score"))

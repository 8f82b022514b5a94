"""Token counts by section, from one encoding of each whole document.

The document is encoded once; a token's character span runs from the character of its first
byte to the end of the character of its last byte.  Sections are character spans; tokens meet
them in an interval join (binary search, vectorised).  A token that crosses section
boundaries is allocated by an explicit rule:

- ``start``: to the section of its first character;
- ``majority``: to the section that holds most of its characters, the earlier one on ties;
- ``share``: to all, in proportion to characters.

Parts of tokens that no section holds go to a row with section null and name ``outside``,
given only where there are any, so that a document's counts always sum to its tokens.

Sections are taken in order of start; where they overlap the earlier one holds the
characters; ends are cut to the text; empty sections have no tokens.  A null or empty text
has no tokens and its sections none; null sections are an empty list.  Special tokens'
strings are ordinary text.  Rows are treated one by one, so repeated rows repeat.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the splitting pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("start", "majority", "share")


class Encoder:
    def __init__(self, path: str = TOKENIZER):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for word, i in ranks.items():
            self.size[i] = len(word)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Character starts and ends of the tokens."""
        ids = self.encoding.encode_ordinary(text)
        if not ids:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        stop = np.cumsum(self.size[np.array(ids)])
        start = np.append(0, stop[:-1])
        raw = np.frombuffer(text.encode(), np.uint8)
        if len(raw) == len(text):
            return start, stop
        char = np.cumsum(raw & 0xC0 != 0x80)  # 1-based number of the byte's character
        return char[start] - 1, char[stop - 1]


def held(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int, int]]:
    """(start, end, section) without overlaps, in order."""
    out, done = [], 0
    for a, b, i in sorted((max(a or 0, 0), min(b if b is not None else length, length), i) for i, (a, b) in enumerate(spans)):
        if b > max(a, done):
            out.append((max(a, done), b, i))
            done = b
    return out


def allocate(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]], length: int, rule: str) -> np.ndarray:
    """Tokens by section; the last entry is outside."""
    own = held(spans, length)
    # Cells cover the text: sections and the gaps between them (-1).
    edges, who = [0], []
    for a, b, i in own:
        if a > edges[-1]:
            edges.append(a)
            who.append(-1)
        edges.append(b)
        who.append(i)
    if edges[-1] < length or not who:
        edges.append(max(length, edges[-1]))
        who.append(-1)
    edges, who = np.array(edges), np.array(who)
    out = np.zeros(len(spans) + 1)
    first = np.searchsorted(edges, starts, side="right") - 1
    last = np.searchsorted(edges, ends - 1, side="right") - 1
    inner = first == last
    out += np.bincount(np.where(who[first[inner]] < 0, len(spans), who[first[inner]]), minlength=len(out))
    for t in np.flatnonzero(~inner).tolist():
        a, b = int(starts[t]), int(ends[t])
        cells = range(int(first[t]), int(last[t]) + 1)
        parts = [(min(b, edges[c + 1]) - max(a, edges[c]), c) for c in cells]
        if rule == "start":
            out[who[cells[0]] if who[cells[0]] >= 0 else -1] += 1
        elif rule == "majority":
            _, c = max(parts, key=lambda p: (p[0], -p[1]))
            out[who[c] if who[c] >= 0 else -1] += 1
        else:
            for n, c in parts:
                out[who[c] if who[c] >= 0 else -1] += n / (b - a)
    return out


def line_spans(text: str) -> list[tuple[str, int, int]]:
    at, out = 0, []
    for i, line in enumerate(text.split("\n")):
        end = min(at + len(line) + 1, len(text))
        if end > at:
            out.append(("head" if i == 0 else "line", at, end))
        at = end
    return out


def token_counts(docs: DataFrame, sections_col: str | None = None, id_col: str = "doc_id", text_col: str = "text", *, rule: str = "majority", tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, section (its place in the list), name, start, end, n_tokens (double), doc_tokens.

    ``sections_col`` is array<struct<name string, start long, end long>> in characters; without
    it a text's sections are its lines, each with its line feed.  A text without sections has
    one row, with section null.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    given = sections_col is not None
    shape = "array<struct<name:string,start:bigint,end:bigint>>"
    sections = F.col(sections_col).cast(shape) if given else F.lit(None).cast(shape)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), sections.alias("sections"))

    def run(batches):
        encoder = Encoder(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            spans_in = batch.column(2).to_pylist() if given else None
            out: list[list] = [[] for _ in range(7)]
            for i, key in enumerate(ids):
                text = texts[i].as_py() or ""
                spans = [(s["name"], s["start"], s["end"]) for s in spans_in[i] or [] if s] if given else line_spans(text)
                starts, ends = encoder.spans(text)
                counts = allocate(starts, ends, [(a, b) for _, a, b in spans], len(text), rule)
                for k, (name, a, b) in enumerate(spans):
                    for column, value in zip(out, (key, k, name, a, b, counts[k], len(starts))):
                        column.append(value)
                if counts[-1] > 0 or not spans:
                    for column, value in zip(out, (key, None, "outside", None, None, counts[-1], len(starts))):
                        column.append(value)
                if len(out[0]) > 50_000:
                    yield packed(out)
                    out = [[] for _ in range(7)]
            yield packed(out)

    return rows.mapInArrow(run, "doc_id long, section long, name string, start long, end long, n_tokens double, doc_tokens long")


def packed(out: list[list]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc_id", "section", "name", "start", "end", "n_tokens", "doc_tokens"])

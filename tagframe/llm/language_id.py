"""Language identification by Bayesian fusion of evidence.

log P(l | row) = text likelihood + declared markup language + address suffix + host prior.

- Text: byte trigrams, hashed, with smoothed counts by language, learned from at most
  ``most_rows`` rows with a known language; the sum of log likelihoods is tempered to that
  of ``tempered`` trigrams, since neighbouring trigrams are not independent.
- Declared language (``<html lang>``, ``content-language``) and address suffix (top-level
  domain): likelihoods P(value | l) from grouped sums of the text posteriors.
- Host prior: grouped sums of text posteriors by host, domain, suffix and over all rows; each
  level is smoothed towards the next one with ``prior_rows`` pseudo rows, and a row's own
  share is taken out of its host's, domain's and suffix's sums, so that no row counts twice.

Aggregation is partial before the shuffle and a host's sums are one row, which is repeated for
the parts that its rows are dealt into, so that a host or declared language with a third of
all rows is not one task's group.

Null or empty texts have no text evidence: such rows are decided by the rest.  A null address
has no host: its prior is the overall one.  Ties go to the first language in order.  A key
column that has the name of a result column is given as key_<name>.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import LOWER, cut, dealt, each_part, parts_of, slices, utf8

BUCKETS = 1 << 15
RESULT = ("lang", "posterior", "text_lang", "text_posterior", "declared", "suffix", "host")
OPENS = {names: re.compile(rf"({names})\b", re.I) for names in ("article|main", "script|style|noscript|template|nav|head")}
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for names in OPENS for name in names.split("|")}
INNER, WHOLE = OPENS


def html_text(page: str | None) -> str:
    """The words of a page's articles, or of all of it.  Time grows with the page's length: an end that
    isn't there is looked for once."""
    page = page or ""
    parts = [page[a:b] for a, b in _main_parts(page)] or [page]
    return html.unescape(" ".join(_without_tags(p) for p in parts))


def _main_parts(page: str):
    at, gone = 0, set()
    while (i := page.find("<", at)) >= 0:
        at = i + 1
        m = OPENS[INNER].match(page, at)
        if not m or (name := m.group(1).lower()) in gone:
            continue
        a = page.find(">", m.end())
        end = ENDS[name].search(page, a + 1) if a >= 0 else None
        if end:
            yield a + 1, end.start()
            at = end.end()
        else:
            gone.add(name)


def _without_tags(page: str) -> str:
    out, at, gone = [], 0, set()
    while (i := page.find("<", at)) >= 0:
        out.append(page[at:i])
        m = OPENS[WHOLE].match(page, i + 1)
        name = "!--" if page.startswith("!--", i + 1) else m.group(1).lower() if m else ""
        stop = -1
        if name and name not in gone:
            if name == "!--":
                stop = page.find("-->", i + 4) + 3 if page.find("-->", i + 4) >= 0 else -1
            elif end := ENDS[name].search(page, m.end()):
                stop = end.end()
            if stop < 0:
                gone.add(name)
        if stop < 0 and ">" not in gone:
            stop = page.find(">", i) + 1 or -1
            if stop < 0:
                gone.add(">")
        out.append(" " if stop > 0 else "<")
        at = stop if stop > 0 else i + 1
    out.append(page[at:])
    return "".join(out)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of lower-cased letters (other ASCII is a space), and each one's text."""
    low = LOWER[data]
    low = np.where((low >= 97) & (low <= 122) | (low >= 128), low, 32).astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = ((low[:-2] * np.uint32(0x1F1F1) + low[1:-1] * np.uint32(0x9E37) + low[2:] * np.uint32(0x1F3D5B79)) * np.uint32(0x85EBCA6B)) >> np.uint32(17)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = (text[:-2] == text[2:]) & ~((low[:-2] == 32) & (low[1:-1] == 32))
    return h[keep].astype(np.int64), text[:-2][keep]


@dataclass
class TextModel:
    languages: list[str]
    logs: np.ndarray  # (languages, buckets)

    def score(self, data: np.ndarray, offsets: np.ndarray, tempered: float) -> np.ndarray:
        h, text = trigrams(data, offsets)
        n = len(offsets) - 1
        count = np.maximum(np.bincount(text, minlength=n), 1)
        out = np.stack([np.bincount(text, row[h], n) for row in self.logs], axis=1)
        return out * (np.minimum(count, tempered) / count)[:, None]


def count_trigrams(languages: list[str]):
    def run(batches):
        total = np.zeros((len(languages), BUCKETS))
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            own = np.array([languages.index(x) for x in batch.column(1).to_pylist()], np.int64)
            for a, b in slices(offsets):
                h, text = trigrams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                total += np.bincount(own[a:b][text] * BUCKETS + h, minlength=total.size).reshape(total.shape)
        k, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(bucket, pa.int64()), pa.array(total[k, bucket].astype(np.int64))], ["k", "bucket", "n"])

    return run


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, most_rows: int = 20_000) -> TextModel:
    """From at most ``most_rows`` rows with a text and a language, by the hash of their ids; all their languages."""
    known = docs.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang")).where("id is not null and lang is not null")
    ids = known.orderBy(F.xxhash64("id"), "id").limit(most_rows)
    languages = sorted(r.lang for r in ids.select("lang").distinct().collect())
    if not languages:
        return TextModel(["und"], np.zeros((1, BUCKETS)))
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sample = texts.where(F.col("lang").isin(languages)).join(F.broadcast(ids.select("id").distinct()), "id", "left_semi")
    got = sample.select("text", "lang").mapInArrow(count_trigrams(languages), "k long, bucket long, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.full((len(languages), BUCKETS), 0.1)
    for r in got:
        counts[r.k, r.bucket] += r.n
    return TextModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)))


def text_evidence(rows: DataFrame, model: TextModel, tempered: float) -> DataFrame:
    """Adds text_log (array, by language); a page's html is stripped first (column is_html)."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in rows.columns if c not in ("text", "is_html")]
    at = [rows.columns.index(c) for c in keep]
    text_at, html_at = rows.columns.index("text"), rows.columns.index("is_html")

    def run(batches):
        for batch in batches:
            texts, pages = batch.column(text_at), batch.column(html_at).to_pylist()
            if any(pages):
                texts = pa.array([html_text(t) if p else t for t, p in zip(texts.to_pylist(), pages)], pa.string())
            data, offsets = utf8(texts)
            parts = [shipped.value.score(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], tempered) for a, b in slices(offsets)]
            if parts:
                x = np.concatenate(parts)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in at), flat], [*keep, "text_log"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, text_log array<double>")


def softmax(logs: F.Column) -> F.Column:
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, y: a + y))


def identify(rows: DataFrame, model: TextModel, *, tempered: float = 60.0, prior_rows: float = 4.0) -> DataFrame:
    """``rows``: key columns, then text, is_html, declared, suffix, domain, host.

    Gives the key columns and lang, posterior, text_lang, text_posterior, declared, suffix, host.
    """
    languages, n = model.languages, len(model.languages)
    given = [c for c in rows.columns if c not in ("text", "is_html", "declared", "suffix", "domain", "host")]
    keys = [f"key {i}" for i in range(len(given))]  # no name of a column made here has a space
    rows = rows.withColumnsRenamed(dict(zip(given, keys)))
    seen = cut(text_evidence(rows, model, tempered), "evidence")
    # Keys of the four levels.  A null key becomes one of many that no sum has, so that rows without
    # a value meet nothing and do not meet in one task either.
    spread = F.concat(F.lit(" "), F.pmod(F.xxhash64(*keys), F.lit(4096)).cast("string"))
    levels = {"declared": F.col("declared"), "suffix": F.col("suffix"), "domain": F.concat_ws("|", F.when(F.col("domain").isNotNull(), F.coalesce("suffix", F.lit(""))), "domain"), "host": F.col("host")}
    levels["domain"] = F.when(F.col("domain").isNotNull(), levels["domain"])
    own = softmax(F.col("text_log"))
    seen = seen.withColumn("own", own).withColumn("part", dealt(spread)).withColumns({f"k_{k}": F.coalesce(v, spread) for k, v in levels.items()})
    ps = [f"p{k}" for k in range(n)]

    def sums(level: str) -> DataFrame:
        rows = seen.where(~F.col(f"k_{level}").startswith(" ")).select(f"k_{level}", "part", *(F.col("own")[k].alias(f"p{k}") for k in range(n)))
        found = rows.groupBy(f"k_{level}").agg(*(F.sum(c).alias(c) for c in ps), parts_of("part").alias("parts"))
        return found.select(f"k_{level}", each_part("parts").alias("part"), F.array(*ps).alias(f"n_{level}"))

    total = seen.agg(*(F.sum(F.col("own")[k]).alias(f"p{k}") for k in range(n))).first()
    overall = np.array([total[c] or 0.0 for c in ps]) + 1.0
    prior = overall / overall.sum()
    out = seen
    for level in levels:
        out = out.join(sums(level), [f"k_{level}", "part"], "left")
    zero = F.array(*[F.lit(0.0)] * n)
    less = lambda c: F.transform(F.coalesce(c, zero), lambda x, i: F.greatest(x - F.element_at("own", (i + 1).cast("int")), F.lit(0.0)))

    def smoothed(level: F.Column, above: F.Column) -> F.Column:
        size = F.aggregate(level, F.lit(0.0), lambda a, x: a + x)
        return F.transform(level, lambda x, i: (x + prior_rows * F.element_at(above, (i + 1).cast("int"))) / (size + prior_rows))

    for name in ("n_suffix", "n_domain", "n_host"):
        out = out.withColumn(name, F.when(F.col(name).isNotNull(), less(F.col(name))).otherwise(zero))
    out = out.withColumn("prior", F.array(*(F.lit(float(x)) for x in prior)))
    for name in ("n_suffix", "n_domain", "n_host"):
        out = out.withColumn("prior", smoothed(F.col(name), F.col("prior")))
    # P(declared | l): of all rows that text gives to l, those that declare this value.
    declared = F.when(F.col("n_declared").isNotNull(), F.transform(less(F.col("n_declared")), lambda x, i: F.log((x + 0.5) / (F.element_at(F.array(*(F.lit(float(v)) for v in overall)), (i + 1).cast("int")) + 1.0)))).otherwise(zero)
    out = out.withColumn("declared_log", declared)
    fused = F.transform("text_log", lambda x, i: x + F.element_at("declared_log", (i + 1).cast("int")) + F.log(F.element_at("prior", (i + 1).cast("int"))))
    out = out.withColumn("fused", fused)
    post = softmax(F.col("fused"))
    names = F.array(*(F.lit(x) for x in languages))
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    named = [F.col(k).alias(f"key_{c}" if c.lower() in RESULT else c) for k, c in zip(keys, given)]
    return out.select(*named, best(F.col("fused")).alias("lang"), F.array_max(post).alias("posterior"), best(F.col("text_log")).alias("text_lang"), F.array_max("own").alias("text_posterior"), "declared", "suffix", "host")


def page_rows(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    url = F.lower(F.col(url_col).cast("string"))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    host = F.when(host != "", host)
    page = F.col(html_col).cast("string")
    said = F.regexp_extract(page, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    meta = F.regexp_extract(page, r"(?i)content-language[\"']?\s+content\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    declared = F.lower(F.when(said != "", said).when(meta != "", meta))
    suffix, domain = F.regexp_extract(host, r"\.([^.]+)$", 1), F.regexp_extract(host, r"(?:^|\.)([^.]+\.[^.]+)$", 1)
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), page.alias("text"), F.lit(True).alias("is_html"), declared.alias("declared"),
        F.when(suffix != "", suffix).alias("suffix"), F.when(domain != "", domain).alias("domain"), host.alias("host"),
    )


def document_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Documents have no markup and no address; their source stands for the host."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.lit(False).alias("is_html"), none.alias("declared"),
        none.alias("suffix"), none.alias("domain"), F.col(source_col).cast("string").alias("host"),
    )

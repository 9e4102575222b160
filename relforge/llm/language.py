"""Language identification by Bayesian fusion of evidence (operator 9).

For each page and language y four pieces of evidence are added as logarithms and normalised:

- text: hashed byte trigrams of the main text under a multinomial model of y, fitted on labelled documents.
  Trigrams overlap and depend on each other, so a text counts as ``WORTH`` independent ones at most;
- declared language: P(declared | y), the lang attribute of the html element;
- address suffix: P(suffix | y), the top-level domain and a two-letter first path segment;
- host prior: P(y | host), smoothed towards the registered domain, which is smoothed towards all pages.

The last three are estimated from the pages themselves by grouped aggregation of the text posteriors
(soft counts), without the page in question, so a page is no evidence for itself. Aggregates are partial
per task, so a hot host or language costs each task one row; the tables joined back have a row per key
and language counts in fixed positions.

The trigram counts come from about ``MAX_DOCS`` labelled documents of each language, picked by a hash of
their id (a bound of the fit, as a parameter); the model is BUCKETS floats for each language. All else
covers all pages and their whole main text.

Defined results: null or empty html has no text evidence, and no declared language; a null url has an
empty host and suffix; without labelled documents the language is null; rows repeat as given and each
counts; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, col, slices
from .html_extract import Weights, extract
from .html_extract import fit as fit_weights

BUCKETS = 1 << 15
MAX_DOCS = 2_000
WORTH = 60.0
SMOOTH, HOST_WEIGHT = 1.0, 5.0
_LANG = re.compile(r"<html\b[^>]{0,2000}?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})(?![A-Za-z])", re.I)
_URL = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*(/[^/?#]*)?", re.I)


def buckets(text: str) -> np.ndarray:
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    code = raw[:-2] | raw[1:-1] << np.uint32(8) | raw[2:] << np.uint32(16)
    return (code * np.uint32(2_654_435_761)) >> np.uint32(17)


def address(url: str | None) -> tuple[str, str, str]:
    """(host, registered domain, suffix) of an address."""
    m = _URL.match(url or "")
    host = m[1].lower().strip(".") if m else ""
    labels = host.split(".") if host else []
    segment = (m[2] or "")[1:].lower() if m else ""
    suffix = (labels[-1] if labels else "") + ("/" + segment if re.fullmatch(r"[a-z]{2}(?:-[a-z]{2})?", segment) else "")
    return host, ".".join(labels[-2:]), suffix


class TextModel:
    """log P(trigram | language) for each bucket."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        share = counts + 0.5
        self.log = np.log(share / share.sum(axis=0, keepdims=True)) if languages else np.zeros((BUCKETS, 0))

    def evidence(self, text: str) -> np.ndarray:
        found = buckets(text) if text.strip() else np.empty(0, np.uint32)
        if not len(found):
            return np.zeros(len(self.languages))
        return self.log[found].mean(axis=0) * min(len(found), WORTH)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if lang not in total:
                total[lang] = np.zeros(BUCKETS, np.int64)
            total[lang] += np.bincount(buckets(text), minlength=BUCKETS)
    for lang, counts in total.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(counts[used])], ["lang", "bucket", "n"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_DOCS) -> TextModel:
    """Trigram counts of about ``max_docs`` labelled documents of each language."""
    given = docs.select(col(id_col).cast("string").alias("id"), col(text_col).cast("string").alias("text"), F.lower(col(lang_col).cast("string")).alias("lang"))
    given = given.where("lang is not null and lang <> '' and text is not null")
    sizes = {r[0]: r[1] for r in given.groupBy("lang").count().collect()}
    if not sizes:
        return TextModel([], np.zeros((BUCKETS, 0)))
    million = 1_000_000
    rate = F.create_map(*(F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(million, -(-million * max_docs // n)))))
    picked = given.where(F.pmod(F.xxhash64(F.coalesce("id", F.lit(""))), F.lit(million)) < rate[F.col("lang")])
    rows = picked.select("lang", "text").mapInArrow(_counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    languages = sorted(sizes)
    counts = np.zeros((BUCKETS, len(languages)))
    place = np.array([languages.index(x) for x in table["lang"].to_pylist()], np.int64)
    counts[table["bucket"].to_numpy(), place] = table["n"].to_numpy()
    return TextModel(languages, counts)


def _evidence(model: TextModel, weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = weights.tables()
        for batch in slices(batches):
            made: list[list] = [[] for _ in range(6)]
            for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                log = model.evidence(extract(html, weights, tables))
                post = np.exp(log - log.max()) if len(log) else log
                m = _LANG.search(html or "")
                for out, value in zip(made, (*address(url), m[1].lower() if m else "", log, post / post.sum() if len(post) else post), strict=True):
                    out.append(value)
            kinds = [pa.string()] * 4 + [pa.list_(pa.float64())] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, k) for x, k in zip(made, kinds, strict=True))],
                ["page_id", "url", "host", "domain", "suffix", "declared", "log_text", "post"])

    return run


def identify(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             weights: Weights | None = None) -> DataFrame:
    """Per row: page_id, url, host, suffix, declared, text_lang, lang, p (rounded to 6 places).

    ``weights``: the fitted model that finds a page's main text; without it one is fitted on these pages."""
    weights = weights or fit_weights(pages, id_col, html_col)
    scratch = Scratch(pages.sparkSession, "language")
    given = pages.select(col(id_col).alias("page_id"), col(url_col).cast("string").alias("url"), col(html_col).cast("string").alias("html"))
    id_type = given.schema["page_id"].dataType.simpleString()
    scored = scratch.stage(given.mapInArrow(_evidence(model, weights), (
        f"page_id {id_type}, url string, host string, domain string, suffix string, declared string, log_text array<double>, post array<double>")), "evidence")
    languages, size = model.languages, len(model.languages)
    if not size:
        none = F.lit(None).cast("string")
        return scored.select("page_id", "url", "host", "suffix", "declared", none.alias("text_lang"), none.alias("lang"), F.lit(None).cast("double").alias("p"))

    def counts(key: str, name: str) -> DataFrame:
        sums = F.array(*(F.sum(F.col("post")[y]) for y in range(size)))
        return scored.groupBy(F.col(key).alias(f"{name}_key")).agg(sums.alias(name), F.count("*").alias(f"{name}_n"))

    total = F.array(*(F.sum(F.col("post")[y]) for y in range(size)))
    joined = scored.join(F.broadcast(scored.agg(total.alias("all"), F.count("*").alias("all_n"))))
    for key in ("host", "domain", "declared", "suffix"):
        joined = joined.join(counts(key, f"c_{key}"), F.col(key) == F.col(f"c_{key}_key"))

    def without(name: str, y: int) -> Column:  # soft counts of the other pages
        return F.greatest(F.col(name)[y] - F.col("post")[y], F.lit(0.0))

    def likelihood(name: str, y: int) -> Column:
        share = F.greatest(F.col(f"{name}_n") - 1, F.lit(0)) / F.greatest(F.col("all_n") - 1, F.lit(1))
        return (without(name, y) + SMOOTH * F.greatest(share, F.lit(1e-3))) / (without("all", y) + SMOOTH)

    def prior(y: int) -> Column:
        overall = (without("all", y) + 1) / (F.col("all_n") - 1 + size)
        domain = (without("c_domain", y) + HOST_WEIGHT * overall) / (F.col("c_domain_n") - 1 + HOST_WEIGHT)
        return (without("c_host", y) + HOST_WEIGHT * domain) / (F.col("c_host_n") - 1 + HOST_WEIGHT)

    logs = [F.col("log_text")[y] + F.log(prior(y)) + F.log(likelihood("c_declared", y)) + F.log(likelihood("c_suffix", y)) for y in range(size)]
    fused = joined.withColumn("logs", F.array(*logs))
    best = F.array_max("logs")
    spread = reduce(lambda a, b: a + b, (F.exp(F.col("logs")[y] - best) for y in range(size)))
    names = F.array(*map(F.lit, languages))
    at = lambda values: names[(F.array_position(values, F.array_max(values)) - 1).cast("int")]
    return fused.select("page_id", "url", "host", "suffix", "declared", at(F.col("log_text")).alias("text_lang"), at(F.col("logs")).alias("lang"), F.round(1 / spread, 6).alias("p"))

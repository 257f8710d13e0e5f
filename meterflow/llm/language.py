"""Language identification by fusing evidence.

Text gives a likelihood per language: a naive Bayes model over hashed byte triples, counted over
all documents of known language. A page also declares a language in its markup, its address has a
suffix, and its host has published other pages. How far a declaration or a suffix is to be
trusted is learned from the pages: grouped sums of the text's own verdicts. Host priors are smoothed
towards the registered domain, and domains towards the whole collection, so that a host with few
pages follows its parents. All four are multiplied and normalised.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterflow.llm.shared import map_texts, staged, text_bytes
from meterflow.llm.url_rules import host_of

CELLS = 1 << 14
# Languages whose counts are brought to the driver at once.
FETCHED = 64
# A text counts as at most this many triples of evidence, as neighbouring triples overlap.
EVIDENCE = 200.0
SMOOTHING = 0.5
HOST_WEIGHT, DOMAIN_WEIGHT, TRUST_WEIGHT = 10.0, 20.0, 5.0
UNDETERMINED = "und"

HIDDEN = re.compile(r"<(script|style|template)\b.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>", re.S | re.I)
TAG = re.compile(r"<[^<>]*>")
# Tags do not overlap, so a page is read once whatever stands in it.
ROOT = re.compile(r"<html\b[^>]*", re.I)
DECLARED = re.compile(r"""\blang\s*=\s*["']?\s*([A-Za-z]{2,3})\b""", re.I)
NO_LETTERS = bytes(c if 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def visible(page: str) -> str:
    """Text of a page without markup, scripts and comments."""
    return html.unescape(TAG.sub(" ", HIDDEN.sub(" ", page)))


def declared(page: str) -> str | None:
    """The language that the page's markup names, wherever in the page it stands."""
    for tag in ROOT.finditer(page):
        if match := DECLARED.search(tag.group(), len("<html")):
            return match.group(1).lower()
    return None


def triples(text: str) -> np.ndarray:
    """Cells of the byte triples of a text: ASCII letters in one case, all else one blank."""
    data = b" " + b" ".join(text.lower().encode().translate(NO_LETTERS).split()) + b" "
    codes = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(codes) < 3:
        return np.empty(0, np.uint32)
    mixed = (codes[:-2] << np.uint32(16)) | (codes[1:-1] << np.uint32(8)) | codes[2:]
    return (mixed * np.uint32(2654435761)) >> np.uint32(18)


def count_triples(docs: DataFrame) -> DataFrame:
    """``lang``, ``cell``, ``n`` over all texts of known language: a table of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, np.ndarray] = {}
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("_text").to_pylist()):
                own = counts.setdefault(lang, np.zeros(CELLS, np.int64))
                own += np.bincount(triples(data.decode("utf-8", "replace")), minlength=CELLS)
            for lang, own in counts.items():
                cells = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(cells), pa.string()), pa.array(cells, pa.int32()),
                     pa.array(own[cells])], ["lang", "cell", "n"])

    return (
        docs.where("lang is not null and text is not null")
        .select("lang", text_bytes().alias("_text"))
        .mapInArrow(run, "lang string, cell int, n long")
        .groupBy("lang", "cell").agg(F.sum("n").alias("n")))


class TextModel:
    """Log likelihoods of triples by language; languages times ``CELLS`` numbers."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        smoothed = counts + SMOOTHING
        self.langs = langs
        self.log = np.log(smoothed / smoothed.sum(axis=1, keepdims=True)) if langs else counts

    @classmethod
    def fit(cls, docs: DataFrame) -> TextModel:
        """Counts over all documents and all their languages, fetched some languages at a time."""
        counted = staged(count_triples(docs), "triples")
        langs = sorted(row.lang for row in counted.select("lang").distinct().collect())
        counts = np.zeros((len(langs), CELLS))
        for at in range(0, len(langs), FETCHED):
            part = counted.where(F.col("lang").isin(langs[at: at + FETCHED]))
            places = {lang: at + n for n, lang in enumerate(langs[at: at + FETCHED])}
            for row in part.collect():
                counts[places[row.lang], row.cell] = row.n
        return cls(langs, counts)

    def posterior(self, text: str) -> list[float]:
        """Probabilities from the text alone, languages being equally likely beforehand."""
        cells = triples(text)
        if not len(cells):
            return [1.0 / len(self.langs)] * len(self.langs)
        met, times = np.unique(cells, return_counts=True)
        score = self.log[:, met] @ times / len(cells) * min(len(cells), EVIDENCE)
        weight = np.exp(score - score.max())
        return (weight / weight.sum()).tolist()


def _read_pages(pages: DataFrame, model: TextModel, keep: list[str]) -> DataFrame:
    def of_batch(texts: list[bytes]):
        for data in texts:
            page = data.decode("utf-8", "replace")
            yield declared(page), model.posterior(visible(page))

    return map_texts(pages, keep, "declared string, p_text array<double>", of_batch, text="html")


def _sums(rows: DataFrame, by: list[str], langs: list[str], name: str) -> DataFrame:
    """Soft counts: per group, the sum of the text's probabilities, rounded to whole millionths.

    Whole numbers add up to the same sum in any order.
    """
    per_lang = rows.groupBy(*by).agg(*[
        F.sum(F.round(F.col("p_text")[n] * 1_000_000).cast("long")).alias(f"s{n}")
        for n in range(len(langs))])
    return per_lang.select(*by, F.array(*[F.col(f"s{n}") / 1e6 for n in range(len(langs))]).alias(name))


def _smoothed(counts: str, parent: Column, weight: float) -> Column:
    """Shares of a group, drawn towards its parent's as if that had ``weight`` pages."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(
        F.col(counts), parent, lambda n, p: (n + weight * p) / (total + F.lit(weight)))


def _trust(rows: DataFrame, by: str, langs: list[str], whole: Column, name: str) -> DataFrame:
    """P(value | language) up to a factor: smoothed P(language | value) over P(language)."""
    sums = _sums(rows.where(F.col(by).isNotNull()), [by], langs, "_n")
    return sums.select(by, F.zip_with(
        _smoothed("_n", whole, TRUST_WEIGHT), whole, lambda p, q: p / q).alias(name))


def identify(pages: DataFrame, model: TextModel, keep: list[str] | None = None) -> DataFrame:
    """``lang``, ``probability`` and the evidence for every page, repeated pages included.

    ``text_lang`` is the verdict of the text alone, ``declared`` and ``suffix`` what the page and its
    address say. Missing evidence (null or empty page or address, nothing declared) counts as
    none. Of equally likely languages the first by name is given. Without any model
    language the verdict is ``und`` with probability zero.
    """
    keep = keep or ["page_id"]
    langs = model.langs
    if not langs:
        return _read_pages(pages, TextModel(["x"], np.ones((1, CELLS))), keep).select(
            *keep, "declared", F.lit(None).cast("string").alias("suffix"),
            F.lit(UNDETERMINED).alias("text_lang"), F.lit(UNDETERMINED).alias("lang"),
            F.lit(0.0).alias("probability"))
    host = host_of("url")
    addressed = pages.withColumns({
        "_host": F.when(host != "", F.regexp_replace(host, r":\d*$", ""))}).withColumns({
        "_domain": F.when(F.col("_host").isNotNull(), F.substring_index("_host", ".", -2)),
        "_suffix": F.when(F.col("_host").contains("."), F.substring_index("_host", ".", -1))})
    read = staged(_read_pages(addressed, model, [*keep, "_host", "_domain", "_suffix"]), "pages")
    flat = F.array(*[F.lit(1.0 / len(langs))] * len(langs))
    whole_sums = _sums(read, [], langs, "_n").first()
    n = [x or 0.0 for x in whole_sums["_n"]]
    shares = [(x + DOMAIN_WEIGHT / len(langs)) / (sum(n) + DOMAIN_WEIGHT) for x in n]
    whole = F.array(*[F.lit(x) for x in shares])
    hosts = _sums(read.where("_host is not null"), ["_domain", "_host"], langs, "_n")
    domains = _sums(read.where("_domain is not null"), ["_domain"], langs, "_m").select(
        "_domain", _smoothed("_m", whole, DOMAIN_WEIGHT).alias("_p_domain"))
    priors = staged(
        hosts.join(domains, "_domain").select(
            "_host", _smoothed("_n", F.col("_p_domain"), HOST_WEIGHT).alias("_p_host")), "priors")
    said = staged(_trust(read, "declared", langs, whole, "_p_declared"), "declared")
    ended = staged(_trust(read, "_suffix", langs, whole, "_p_suffix"), "suffixes")
    joined = (
        read.join(said, "declared", "left").join(ended, "_suffix", "left")
        .join(priors, "_host", "left"))
    product = F.coalesce(F.col("_p_host"), whole)
    for evidence in (F.col("p_text"), F.coalesce("_p_declared", flat), F.coalesce("_p_suffix", flat)):
        product = F.zip_with(product, evidence, lambda a, b: a * b)
    named = F.array(*[F.lit(name) for name in langs])
    return (
        joined.withColumn("_p", product)
        .withColumns({
            "_best": F.array_max("_p"),
            "_sum": F.aggregate("_p", F.lit(0.0), lambda a, x: a + x)})
        .select(
            *keep, "declared", F.col("_suffix").alias("suffix"),
            F.element_at(named, F.array_position("p_text", F.array_max("p_text")).cast("int"))
            .alias("text_lang"),
            F.element_at(named, F.array_position("_p", F.col("_best")).cast("int")).alias("lang"),
            F.round(F.col("_best") / F.col("_sum"), 6).alias("probability")))

"""Benchmark decontamination by spaced seeds, in DataFrame expressions only.

A mask names the positions of a span of tokens that are hashed; the others are ignored, so a
substituted token there does no harm. The two masks below leave no gap: wherever two of twelve
tokens are substituted, one of them still finds an intact seed. Hashes of the documents are
joined to those of the benchmark, and around every hit the two texts are laid side by side and
compared token by token.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.llm.shared import document_number, named, staged

MASKS = ((0, 1, 2, 5, 7), (0, 3, 5, 6, 7))
WINDOW = 12
SUBSTITUTIONS = 2
# Seeds are three numbers each; up to this many are sent to every executor, more are shuffled.
BROADCAST_SEEDS = 200_000


def sensitive(masks, window: int, substitutions: int) -> bool:
    """Whether every placing of the substitutions in a window leaves one seed intact."""
    return all(
        any(not any(start + offset in changed for offset in mask)
            for mask in masks for start in range(window - max(mask)))
        for changed in map(set, combinations(range(window), substitutions)))


def tokens(text: str = "text") -> Column:
    """Lower-cased runs of letters and digits; a text without any gives one empty token."""
    words = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.split(F.trim(words), " ")


def _tokenised(rows: DataFrame, *keep: str) -> DataFrame:
    # Behind a generator the tokens are made once; filters on them stay above it.
    return rows.select(*keep, F.explode(F.array(tokens())).alias("words"))


def _seeds(tokenised: DataFrame, keep: list[str], masks) -> DataFrame:
    """The hash of every mask at every position that holds the whole span."""
    span = 1 + max(map(max, masks))
    hashes = F.array(*[
        F.xxhash64(F.lit(number), *[F.col("words")[F.col("at") + offset] for offset in mask])
        for number, mask in enumerate(masks)])
    return (
        tokenised.where(F.size("words") >= span)
        .select(*keep, "words", F.explode(F.sequence(F.lit(0), F.size("words") - span)).alias("at"))
        .select(*keep, "at", F.explode(hashes).alias("seed")))


def _best_window(window: int) -> Column:
    """Most equal tokens in any window of the benchmark item laid at ``diagonal``."""
    same = F.transform(
        F.sequence(F.lit(0), F.size("item_words") - 1),
        lambda n: F.coalesce(
            (F.get("words", F.col("diagonal") + n) == F.get("item_words", n)).cast("int"), F.lit(0)))
    return F.array_max(F.transform(
        F.sequence(F.lit(0), F.size("item_words") - window),
        lambda n: F.aggregate(
            F.slice(same, n + 1, F.lit(window)), F.lit(0), lambda total, x: total + x)))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
    substitutions: int = SUBSTITUTIONS, masks=MASKS,
) -> DataFrame:
    """``doc_id``, ``item_id`` and ``n_equal``: documents that hold part of a benchmark item.

    Reported are pairs with ``window`` neighbouring tokens in the same places of which at most
    ``substitutions`` differ; ``n_equal`` is the number of equal ones in the best window. Items
    with fewer than ``window`` tokens are no evidence and match nothing, nor do null or empty texts.
    Repeated rows (same id, same text) are one document; a null id is reported as null.
    """
    if not sensitive(masks, window, substitutions) or len({max(mask) for mask in masks}) > 1:
        raise ValueError("the masks miss some placings of the substitutions")
    items = staged(
        _tokenised(benchmark.select(
            "item_id", F.xxhash64("item_id", "text").alias("_item"), "text"), "item_id", "_item")
        .where(F.size("words") >= window).distinct(), "items")
    seeds = staged(
        _seeds(items, ["_item"], masks).select(
            "seed", "_item", F.col("at").alias("item_at")), "seeds")
    few = seeds.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS
    keyed = docs.select(
        "doc_id", document_number().alias("_doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_digest"), "text")
    hits = staged(
        _seeds(_tokenised(keyed, "_doc", "_digest"), ["_doc", "_digest"], masks)
        .join(F.broadcast(seeds) if few else seeds, "seed")
        .select("_doc", "_digest", "_item", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .distinct(), "hits")
    beside = (
        _tokenised(keyed.join(hits, ["_doc", "_digest"]),
                   "doc_id", "_doc", "_digest", "_item", "diagonal")
        .join(items.withColumnRenamed("words", "item_words"), "_item"))
    return (
        beside.withColumn("n_equal", _best_window(window))
        .where(F.col("n_equal") >= window - substitutions)
        .groupBy("_doc", "_digest", "doc_id", "item_id", "_item")
        .agg(F.max("n_equal").alias("n_equal"))
        .select("doc_id", "item_id", "_doc", "_digest", "n_equal"))


def clean(docs: DataFrame, benchmark: DataFrame, **overlap) -> DataFrame:
    """The documents, all columns, that hold no part of a benchmark item. Repeated rows stay."""
    hit = staged(
        overlaps(docs, benchmark, **overlap).select("_doc", "_digest").distinct(), "contaminated")
    keyed = docs.withColumns({
        "_doc": document_number(), "_digest": F.xxhash64(F.coalesce("text", F.lit("")))})
    return keyed.join(hit, ["_doc", "_digest"], "left_anti").select(*named(docs.columns))

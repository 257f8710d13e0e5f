"""Ranked lexical search: the best documents for each query by the Best Position Algorithm.

The documents are cut into shards of a bounded number of postings. In a shard every query term has
an impact list: its documents by falling share of the term's weight. A query reads its lists
in blocks; each document met is looked up at once in the query's other lists (direct access), which
gives its whole score and also marks its positions there as seen. The best position of a list is the end of its
unbroken run of seen positions; no document that has not been met scores more than the sum of the
impacts at the best positions. A query stops as soon as that sum is strictly below its k-th score,
so ties at the k-th place are all found. The k-th score carries over from shard to shard of a task.

Counts, document frequencies and lengths cover all documents. Terms of the queries are counted per
document in one pass over the texts; only these counts are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterflow.llm.shared import document_number, map_texts, staged, text_bytes

# What a term is, and the constants of the score.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 20, 50

SHARD_POSTINGS = 1_000_000
FIRST_BLOCK = 64
# Queries are taken in blocks; their terms are on the driver and in every task.
BLOCK_ITEMS = 2_000


def terms_of(data: bytes) -> list[bytes]:
    """Terms of a UTF-8 text in order: runs of ASCII letters, digits and all other characters
    beyond ASCII, A-Z lower-cased."""
    return TERM.findall(data.lower())


def weight(documents: int, frequency: int) -> int:
    return int(np.floor(1000 * np.log((2 * documents + 2) / (2 * frequency + 1))))


class Shard:
    """Impact lists of some documents.

    ``doc``, ``term`` and ``impact`` are parallel: one posting each. ``impact`` is without the term's
    weight, which is the same all along a list.
    """

    def __init__(self, docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        self.docs = docs
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        terms, starts = np.unique(term[order], return_index=True)
        self.range = dict(zip(terms.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(order)])))
        # Direct access: the postings of a list by document, with their position.
        self.by_doc = np.lexsort((self.doc, term[order]))
        self.doc_sorted = self.doc[self.by_doc]

    def search(self, terms: list[tuple[int, int]], number: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """(score, doc) of the best ``k`` documents and all that tie with the last; ``terms`` are
        (term, weight), ``number`` orders documents. Scores below ``floor`` may be left out."""
        lists = [(*self.range[t], w) for t, w in terms if t in self.range and w > 0]
        seen = [np.zeros(b - a + 1, bool) for a, b, _ in lists]
        best = [0] * len(lists)
        met, block = np.zeros(self.docs, bool), FIRST_BLOCK
        scores, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while True:
            bound = sum(w * int(self.impact[a + at]) for (a, b, w), at in zip(lists, best) if a + at < b)
            if not bound or bound < floor:
                break
            read = [self.doc[a + at: min(a + at + block, b)] for (a, b, _), at in zip(lists, best)]
            new = np.unique(np.concatenate(read))
            new = new[~met[new]]
            met[new] = True
            total = np.zeros(len(new), np.int64)
            for n, (a, b, w) in enumerate(lists):
                own = self.doc_sorted[a:b]
                at = np.searchsorted(own, new)
                hit = np.flatnonzero(at < b - a)
                hit = hit[own[at[hit]] == new[hit]]
                position = self.by_doc[a + at[hit]]
                total[hit] += w * self.impact[position]
                seen[n][position - a] = True
                # The entry behind the list stays unseen, so the run ends there at the latest.
                best[n] += int(np.argmin(seen[n][best[n]:]))
            scores, found = np.concatenate((scores, total)), np.concatenate((found, new))
            if len(scores) > k:
                kth = int(np.partition(scores, len(scores) - k)[len(scores) - k])
                floor = max(floor, kth)
                keep = scores >= kth
                scores, found = scores[keep], found[keep]
            elif len(scores) == k:
                floor = max(floor, int(scores.min()))
            block *= 2
        order = np.lexsort((number[found], -scores))[:k]
        return [(s, d) for s, d in zip(scores[order].tolist(), found[order].tolist()) if s > 0]


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, all terms ``n`` of a document, and how often (``tf``) it has which query ``terms``."""

    def of_batch(texts: list[bytes]):
        for data in texts:
            words = terms_of(data)
            hits = Counter(map(vocabulary.get, words))
            hits.pop(None, None)
            yield len(words), list(hits), list(hits.values())

    return map_texts(docs, ["doc_id"], "n long, terms array<int>, tf array<int>", of_batch)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a column of lists."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy()


def _best(
    counted: DataFrame, queries: list[tuple[int, list[tuple[int, int]]]], documents: int,
    length: int, k: int,
) -> DataFrame:
    """``query``, ``doc_id`` and ``score``: the best ``k`` of each query among the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, list[tuple[int, int, int | None]]] = {q: [] for q, _ in queries}

        def search(held: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids = rows.column("doc_id").to_pylist()
            number = np.array([(1 << 63) - 1 if i is None else i for i in ids], np.int64)
            sizes, terms = _lists(rows.column("terms"))
            _, tf = _lists(rows.column("tf"))
            doc = np.repeat(np.arange(len(ids)), sizes)
            m = 100 - LENGTH_SHARE + (LENGTH_SHARE * rows.column("n").to_numpy() * documents) // length
            tf = tf.astype(np.int64)
            shard = Shard(len(ids), doc, terms, (SCALE * tf) // (1000 * tf + SATURATION * m[doc]))
            for query, wanted in queries:
                best = top[query]
                floor = -best[k - 1][0] if len(best) >= k else 1
                best += [(-score, number[d], ids[d]) for score, d in shard.search(wanted, number, k, floor)]
                best.sort(key=lambda row: row[:2])
                del best[k:]

        held, postings = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            postings += len(batch.column("terms").flatten())
            if postings >= SHARD_POSTINGS:
                search(held)
                held, postings = [], 0
        if held:
            search(held)
        rows = [(query, i, -score) for query, best in top.items() for score, _, i in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, pa.int64()) for values in (zip(*rows) if rows else ([], [], []))],
            names=["query", "doc_id", "score"])

    return counted.mapInArrow(run, "query long, doc_id long, score long")


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, object, list[bytes]]]]:
    """Queries in blocks of a bounded number: a running number, the id, and the distinct terms."""
    block = []
    rows = items.select("item_id", text_bytes().alias("_text")).toLocalIterator()
    for number, row in enumerate(rows):
        block.append((number, row["item_id"], sorted(set(terms_of(bytes(row["_text"]))))))
        if len(block) == BLOCK_ITEMS:
            yield block
            block = []
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``k`` best documents of each item.

    Equal scores rank by rising doc_id, a null doc_id behind all others. Documents without terms (null
    and empty texts) count nowhere; each of repeated rows is a document of its own, and each of repeated
    items is answered on its own. Items without terms, and items none of whose terms occurs, have
    no row; no documents or no items give no rows. Texts are read whole, however long.
    """
    spark = docs.sparkSession
    result = None
    for block in _blocks(items.select("item_id", "text")):
        words = sorted({word for _, _, own in block for word in own})
        vocabulary = {word: n for n, word in enumerate(words)}
        counted = staged(_counted(docs.select("doc_id", "text"), vocabulary), "counted")
        documents, length = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not length:
            continue
        # At most one row per term of the block.
        frequency = dict(
            counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        queries = [(number, [
            (vocabulary[w], weight(documents, frequency[vocabulary[w]]))
            for w in own if vocabulary[w] in frequency]) for number, _, own in block]
        best = _best(counted, queries, documents, length, k)
        names = spark.createDataFrame([(n, i) for n, i, _ in block], "query long, item_id long")
        place = Window.partitionBy("query").orderBy(F.col("score").desc(), document_number())
        ranked = staged(
            best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"), "ranked")
        result = ranked if result is None else result.unionByName(ranked)
    if result is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result

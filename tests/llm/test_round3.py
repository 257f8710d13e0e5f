"""Prefix trie, lexical search and n-gram join against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from conftest import ODD_TEXTS, SF_DIR, ordered

from meterflow.llm import decontaminate, lexical, lines, ngram_join, prefix_trie, queries, simhash, word_hash
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ---- prefix trie -----------------------------------------------------------------------------

def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), Counter()
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        turns = own.get(conv - int(math.fmod(conv, 20)), [])[:h] + turns[h:]
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
        ends[tuple(turns)].append(conv)
    children.update(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        worth = (len(convs) - 1) * len(brute.words_of(path[-1][1])) if path else 0
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += children[path] == 0
            saved[path[:depth]] += worth
    return [
        (min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path],
         leaves[path], saved[path], hashlib.sha256(
             ",".join(map(str, sorted(ends[path]))).encode()).hexdigest())
        for path, convs in members.items()]


def odd_conversations():
    chance, rows = random.Random(1), []
    for conv in [*range(-5, 90), 100, 120, 131, None]:
        if conv in (20, 40):  # groups without their first conversation
            continue
        for turn in range(chance.choice([1, 1, 2, 3, 5, 8])):
            rows.append((conv, turn or None, chance.choice(["u", None, "a"]),
                         chance.choice(["x y", "", None, "x", "é  z\x0bq"]), "clash", turn))
    # A long conversation twice, and one turn repeated as a whole row.
    for conv in (7, 27):
        rows += [(conv, 100 + n, "u", f"long {n % 3}", None, n) for n in range(700)]
    return rows + [(70, 50, "u", "same", None, 0)] * 3


ODD_CONVERSATIONS = "conv_id long, turn int, role string, text string, words string, depth int"


@pytest.mark.parametrize("cells", [None, 64])
def test_trie_odd_conversations(spark, monkeypatch, cells):
    """Also with a sketch so small that it screens next to nothing."""
    if cells:
        monkeypatch.setattr(prefix_trie, "LEAST_CELLS", cells)
        monkeypatch.setattr(prefix_trie, "MOST_CELLS", cells)
    rows = odd_conversations()
    got = prefix_trie.nodes(spark.createDataFrame(rows, ODD_CONVERSATIONS).repartition(5))
    assert ordered(got.collect()) == ordered(plain_trie([r[:4] for r in rows]))


def test_trie_conversation_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 2)
    rows = [(conv, n, "u", f"t{n if conv != 3 else -n}") for conv in range(1, 9) for n in range(300)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert ordered(prefix_trie.nodes(given).collect()) == ordered(plain_trie(rows))


def test_trie_screens_tails(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    numbered = prefix_trie._numbered(prefix_trie._turns(rows))
    prefixes = prefix_trie._prefixes(numbered, prefix_trie._heads(numbered))
    judged = prefix_trie._judged(prefixes, prefix_trie._cells(prefixes.count())).collect()
    times = Counter((r.kh, r.kl) for r in judged)
    assert all(r.shared for r in judged if times[r.kh, r.kl] > 1)
    alone = [r for r in judged if times[r.kh, r.kl] == 1]
    assert sum(not r.shared for r in alone) > 0.99 * len(alone) > 0


def test_trie_query_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert ordered(queries.op11_prefix_trie(spark, SF_DIR).collect()) == ordered(plain_trie(rows))


def test_trie_no_rows(spark):
    assert prefix_trie.nodes(spark.createDataFrame([], ODD_CONVERSATIONS)).collect() == []


# ---- lexical search --------------------------------------------------------------------------

def plain_search(docs, items, k=50):
    counted = [(i, Counter(TERM.findall((t or "").translate(brute.ASCII_LOWER)))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    frequency = Counter(word for _, c, _ in counted for word in c)
    rows = []
    for item, text in items:
        found = []
        for i, counts, n in counted:
            m = 50 + 50 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[w] + 1)))
                * (10**9 * counts[w] // (1000 * counts[w] + 20 * m))
                for w in set(TERM.findall((text or "").translate(brute.ASCII_LOWER))) if w in counts)
            if score:
                found.append((-score, i is None, i))
        rows += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(found)[:k], 1)]
    return rows


ODD_ITEMS = [(0, "Same WORDS long again"), (0, "Same WORDS long again"), (1, None), (2, ""), (3, "w77 w3001 w9 nowhere"),
             (None, "ünï k one"), (5, "nowhere at all"), (6, "x" * 50_000), (7, "K again and 0")]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_search_odd_documents(spark, odd_docs, monkeypatch, k):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 4)
    items = spark.createDataFrame([(*row, "clash") for row in ODD_ITEMS], "item_id long, text string, score string")
    got = lexical.search(odd_docs, items.coalesce(1), k)
    assert ordered(got.collect()) == ordered(plain_search(ODD_TEXTS, ODD_ITEMS, k))


def test_search_ties_across_shards(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 40)
    monkeypatch.setattr(lexical, "FIRST_BLOCK", 1)
    chance = random.Random(3)
    docs = [(n, " ".join(chance.choices("abcdefgh", k=chance.choice([2, 2, 3, 9])))) for n in range(3000)]
    items = [(n, " ".join(chance.choices("abcdefgh", k=4))) for n in range(20)]
    got = lexical.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), 10)
    assert ordered(got.collect()) == ordered(plain_search(docs, items, 10))


def test_search_stops_early():
    """A list is not read behind the point where no unread document can reach the best one."""
    count = 50_000
    doc = np.tile(np.arange(count), 2)
    impact = np.concatenate((np.arange(count)[::-1] + 1, np.arange(count)[::-1] + 1))
    shard = lexical.Shard(count, doc, np.repeat([0, 1], count), impact)
    read = []
    shard.doc_sorted = CountedReads(shard.doc_sorted, read)
    assert shard.search([(0, 5), (1, 3)], np.arange(count), 10, 1) == [(8 * (count - n), n) for n in range(10)]
    assert len(read) < 10


class CountedReads(np.ndarray):
    """An array that notes how often it is sliced."""

    def __new__(cls, values, read):
        made = np.asarray(values).view(cls)
        made.read = read
        return made

    def __array_finalize__(self, other):
        self.read = getattr(other, "read", [])

    def __getitem__(self, key):
        if isinstance(key, slice):
            self.read.append(key)
        return np.asarray(self).__getitem__(key)


def test_search_nothing_given(spark, no_docs, odd_docs):
    items = spark.createDataFrame(ODD_ITEMS, "item_id long, text string")
    assert lexical.search(no_docs, items).collect() == []
    assert lexical.search(odd_docs, items.limit(0)).collect() == []


def test_search_query_whole_table(spark, small_docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert ordered(queries.op12_lexical_search(spark, SF_DIR).collect()) == ordered(
        plain_search(small_docs, items))


# ---- n-gram join -----------------------------------------------------------------------------

def grams(text, length=3):
    words = brute.words_of((text or "").translate(brute.ASCII_LOWER))
    return {tuple(words[n: n + length]) for n in range(max(1, len(words) - length + 1))} if words else set()


def plain_join(docs, percent=90):
    sets = [grams(t) for _, t in docs]

    def linked(a, b):
        a, b = sets[a], sets[b]
        return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)

    return [(i, len(s), c) for (i, _), s, c in zip(docs, sets, brute.components([i for i, _ in docs], linked))]


def variants(seed, sizes, each, words=400):
    """Texts of given word counts, each with variants that change, drop or add some words."""
    chance, docs = random.Random(seed), []
    for size in sizes:
        text = [f"v{chance.randrange(words)}" for _ in range(size)]
        for _ in range(each):
            now = list(text)
            for _ in range(chance.choice([0, 1, 1, 2, max(1, size // 30)])):
                at = chance.randrange(len(now))
                now[at: at + 1] = chance.choice([[], ["new"], [now[at], "more"], [f"u{chance.randrange(9)}"]]) or now[at: at + 1][:0]
                now = now or ["left"]
            docs.append((len(docs), " ".join(now)))
    return docs


@pytest.mark.parametrize("light", [0, 15, 39])
def test_join_around_the_bound(spark, monkeypatch, light):
    """Light with light, light with heavy, and heavy with heavy sets give the same links wherever the bound is."""
    monkeypatch.setattr(ngram_join, "_light_bound", lambda *_: light)
    docs = variants(5, [3, 8, 11, 12, 13, 17, 18, 21, 22, 25, 30, 39, 41, 43, 60, 120], 12)
    got = ngram_join.components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert ordered(got.collect()) == ordered(plain_join(docs))


def test_join_crowded_lists(spark):
    """More variants of one text than a list is paired for, most of them not linked to its first member."""
    docs = variants(6, [150], 150) + [(1000 + n, t) for n, t in variants(7, [60, 200], 40, words=20)]
    got = ngram_join.components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert ordered(got.collect()) == ordered(plain_join(docs))


def test_join_needs_and_subsets():
    for n in range(1, 40):
        assert ngram_join.subsets(n) == sum(math.comb(n, k) for k in range(ngram_join.spare(n) + 1))
        for m in range(1, 45):
            least = min((o for o in range(min(n, m) + 1) if 100 * o >= 90 * (n + m - o)), default=None)
            if least is not None:
                assert ngram_join.needed(n, m) == least >= n - ngram_join.spare(n)


def test_join_odd_documents(odd_docs, no_docs):
    assert ordered(ngram_join.components(odd_docs).collect()) == ordered(plain_join(ODD_TEXTS))
    assert ngram_join.components(no_docs).collect() == []


def test_join_query_whole_table(spark, small_docs):
    assert ordered(queries.op13_ngram_join(spark, SF_DIR).collect()) == ordered(plain_join(small_docs))


# ---- word hashes -----------------------------------------------------------------------------

@pytest.mark.parametrize("group", [7, 1 << 21])
def test_word_hashes_tell_words_apart(monkeypatch, group):
    monkeypatch.setattr(word_hash, "GROUP_BYTES", group)
    texts = [(t or "").encode() for _, t in ODD_TEXTS if len(t or "") < 2000] + [b"  lead", b"trail \x0b", b"ab ba AB aB"]
    seen: dict[bytes, int] = {}
    for first, last, data, hashes, starts, ends, begins in word_hash.grouped_words(texts):
        assert [data[a:b] for a, b in zip(starts, ends)] == b" ".join(texts[first:last]).split()
        assert np.diff(begins).tolist() == [len(t.split()) for t in texts[first:last]]
        for a, b, h in zip(starts, ends, hashes.tolist()):
            assert seen.setdefault(data[a:b], h) == h
    assert len(set(seen.values())) == len(seen)
    lower = [h.tolist() for *_, h, _, _, _ in word_hash.grouped_words([b"ab BA Ab \xc3\x84 \xc3\xa4"], lower=True)]
    assert len(set(lower[0])) == 4


def test_shingle_sets_are_those_of_words():
    texts = [(t or "").encode() for _, t in ODD_TEXTS]
    for (_, text), own in zip(ODD_TEXTS, word_hash.shingle_sets(texts, 3)):
        assert len(own) == len(grams(text))


# ---- column names ----------------------------------------------------------------------------

def test_column_names_with_dots(spark, odd_docs):
    docs = odd_docs.withColumn("my.col", F.lit(1))
    items = spark.createDataFrame([(1, "nothing of this is in any of the documents at all " * 3)], "item_id long, text string")
    assert lines.dedup(docs).columns == [*docs.columns, "n_lines", "n_removed"]
    for kept in (simhash.keep_one(docs), decontaminate.clean(docs, items)):
        assert kept.columns == docs.columns and kept.count() > 0

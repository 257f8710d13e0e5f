"""Near copies by wide fingerprints, and the corpus pipeline against a plain version."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from conftest import ODD_TEXTS, SF_DIR, ordered
from meterflow.llm import lines, quality, queries, simhash
from test_dealt import kept_lines, mixed, overlapping


def near_groups(texts, length=5, percent=80):
    """Group number per text by the Jaccard similarity of all pairs alone."""
    sets = []
    for text in texts:
        words = brute.words_of((text or "").translate(brute.ASCII_LOWER))
        sets.append({tuple(words[n: n + length]) for n in range(max(1, len(words) - length + 1))} if words else set())
    return brute.components(
        list(range(len(texts))), lambda a, b: 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))


def first_of_groups(docs):
    """Rows that stay: smallest id of a group, one of repeated rows."""
    group = near_groups([t for _, t in docs])
    best, stays = {}, []
    for (doc_id, text), g in zip(docs, group):
        order = (doc_id is None, doc_id or 0)
        best[g] = min(best.get(g, order), order)
    seen = set()
    for (doc_id, text), g in zip(docs, group):
        if (doc_id is None, doc_id or 0) == best[g] and g not in seen:
            seen.add(g)
            stays.append((doc_id, text))
    return stays


def changed(words, count, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), count):
        words[at] = f"other{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near_docs():
    rng = random.Random(3)
    docs, number = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(400)]
        for count in (0, 0, 1, 2, 3, 5):
            docs.append((number, changed(base, count, rng)))
            number += 1
    hot = [f"h{rng.randrange(5000)}" for _ in range(300)]
    docs += [(number + n, changed(hot, 3, rng)) for n in range(150)]
    return docs + docs[:3] + [(None, " ".join(hot)), (None, None), (None, None), (9000, "")]


def test_near_groups_match_plain_version(spark, near_docs):
    rows = simhash.near_groups(spark.createDataFrame(near_docs, "doc_id long, text string")).collect()
    by_root, by_brute = {}, {}
    for row in rows:
        by_root.setdefault(row.root, set()).add(row._doc)
    for (doc_id, _), g in zip(near_docs, near_groups([t for _, t in near_docs])):
        by_brute.setdefault(g, set()).add(2**63 - 1 if doc_id is None else doc_id)
    assert ordered((sorted(s),) for s in by_root.values()) == ordered((sorted(s),) for s in by_brute.values())


def test_near_copies_are_found(spark, near_docs):
    """Copies with one to three of 400 words changed join their originals; large groups too."""
    rows = simhash.near_groups(spark.createDataFrame(near_docs, "doc_id long, text string")).collect()
    root = {r._doc: r.root for r in rows}
    assert all(root[6 * g + k] == root[6 * g] for g in range(12) for k in range(1, 5))
    assert len({root[n] for n in range(0, 72, 6)}) == 12
    assert len({root[n] for n in range(72, 222)}) == 1


def test_keep_one(spark, near_docs):
    docs = spark.createDataFrame(near_docs, "doc_id long, text string").withColumn("root", F.lit("clash"))
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert ordered((r.doc_id, r.text or "") for r in got.collect()) == \
        ordered((i, t or "") for i, t in first_of_groups(near_docs))


# ---- stages ----

def accepted(docs, rules):
    kept = []
    for row in docs:
        n_words, word_chars, n_symbols, n_dup, n_repeat, failed = brute.quality_base(row[1])
        if failed:
            continue
        text, words = row[1], brute.words_of(row[1])
        data = text.encode()
        value = {
            "chars_per_word": word_chars / n_words, "symbols_per_word": n_symbols / n_words,
            "repeat_share": n_repeat / n_words,
            "dup_line_share": n_dup / max(1, sum(bool(brute.WORD.search(x)) for x in text.split("\n"))),
            "upper_share": sum("A" <= c <= "Z" for c in text) / word_chars,
            "punctuation_share": sum(c in quality.PUNCTUATION for c in data) / word_chars,
            "digit_share": sum("0" <= c <= "9" for c in text) / word_chars,
            "distinct_share": len(set(words)) / n_words}
        if not any(all((value[c.feature] > c.threshold) == c.above for c in rule) for rule in rules):
            kept.append(row)
    return kept


def cut(docs):
    places, group, index = kept_lines([(d[0], d[1]) for d in docs])
    first, rows = {}, []
    for doc_id, _, number, normal in places:
        g = group[index[normal]]
        first[g] = min(first.get(g, (doc_id, number)), (doc_id, number))
    for doc_id, text, lang, source in docs:
        parts = text.encode().split(b"\n")
        left = [line for number, line in enumerate(parts)
                if not (n := lines.normalised(line)) or first[group[index[n]]] == (doc_id, number)]
        text = b"\n".join(left).decode()
        if len(left) == len(parts) or brute.WORD.search(text):
            rows.append((doc_id, text, lang, source))
    return rows


def domain_of(source):
    return next((name for name, sources in queries.DOMAINS.items() if source in sources), "other")


def test_pipeline_against_plain_version(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = [tuple(r) for r in documents.select("doc_id", "text", "lang", "source").collect()]
    rules = quality.learn(documents, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    docs = cut(accepted(docs, rules))
    stay = {i for i, _ in first_of_groups([(d[0], d[1]) for d in docs])}
    docs = [d for d in docs if d[0] in stay]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {i for i, _, _ in overlapping([(d[0], d[1]) for d in docs], items)}
    docs = [d for d in docs if d[0] not in leaked]
    want = mixed([(i, domain_of(s), l, s, len(brute.words_of(t))) for i, t, l, s in docs], queries.MIX)
    assert ordered(corpus_pipeline.run(spark, SF_DIR).collect()) == ordered(want)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_and_no_documents(spark, odd_docs, no_docs, name, stage):
    got = stage(spark, odd_docs, SF_DIR)
    rows = got.collect()
    assert 0 < len(rows) <= len(ODD_TEXTS)
    if name != "source_mix":
        assert got.schema.simpleString() == odd_docs.schema.simpleString()
    assert stage(spark, no_docs, SF_DIR).count() == 0


def test_learned_rules_tell_junk_from_prose(spark):
    """Two unlike kinds of junk need two rules; clean texts all stay."""
    rng = random.Random(1)
    prose = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(999)}word" for _ in range(60)) for _ in range(300)]
    junk = [p.upper() for p in prose[:100]] + [" ".join(w + "$$" for w in p.split()) for p in prose[100:200]]
    docs = spark.createDataFrame(list(enumerate(prose + junk)), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 300).cast("int").alias("quality"))
    rules = quality.learn(docs, labels)
    assert len(rules) >= 2
    kept = {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
    assert kept == set(range(300))
    few = quality.learn(docs, labels, max_labelled=50)
    assert few and quality.learn(docs, labels.limit(0)) == []


def test_contradicting_and_odd_labels(spark):
    docs = spark.createDataFrame([(1, "x " * 20), (2, None), (None, "y " * 20)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (None, 0), (3, None), (9, 0)], "doc_id long, quality int")
    assert quality.learn(docs, labels) == []


def test_fingerprints_count_every_bit():
    rng = np.random.default_rng(4)
    for size in (1, 2, 255, 256, 700):
        hashes = rng.integers(0, 1 << 63, size, np.uint64)
        lanes = simhash.lane_words(hashes)
        bits = np.unpackbits(np.ascontiguousarray(lanes).view(np.uint8).reshape(size, -1), axis=1, bitorder="little")
        words, least = simhash.wide_fingerprint(hashes)
        assert (np.unpackbits(words.view(np.uint8), bitorder="little") == (2 * bits.sum(axis=0, dtype=int) > size)).all()
        assert (least == lanes.min(axis=0)).all()
        assert len(set(simhash.block_keys(words, least).tolist())) == simhash.KEYED_LANES * simhash.LANE_BLOCKS


def test_block_recall_at_the_bound():
    """Of random pairs of sets around the similarity bound nearly all share a block and pass the distance."""
    rng, found = np.random.default_rng(6), []
    for _ in range(300):
        common = rng.integers(0, 1 << 63, 400, np.uint64)
        prints = [simhash.wide_fingerprint(np.concatenate((common, rng.integers(0, 1 << 63, 50, np.uint64)))) for _ in "ab"]
        keys = [set(simhash.block_keys(*p).tolist()) for p in prints]
        distance = int(np.bitwise_count(prints[0][0] ^ prints[1][0]).sum())
        found.append(bool(keys[0] & keys[1]) and distance <= simhash.most_distance(0.8))
    assert np.mean(found) > 0.98

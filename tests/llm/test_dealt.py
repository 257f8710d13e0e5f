"""Decontamination, line dedup, language, pseudonyms and mixing against plain versions."""

from __future__ import annotations

import re
from fractions import Fraction
from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from conftest import ODD_TEXTS, SF_DIR, ordered
from meterflow.llm import decontaminate, edit, language, lines, mixing, pii, queries
from meterflow.llm.pigeonhole import close_pairs
from meterflow.llm.components import connected


# ---- decontamination ----

def overlapping(docs, items, window=12, substitutions=2):
    def tokens(text):
        return re.sub(r"[\W_]+", " ", (text or "").lower()).split()

    rows = set()
    for doc_id, text in docs:
        words = tokens(text)
        for item_id, item in items:
            item = tokens(item)
            best = 0
            for shift in range(-len(item), len(words)):
                same = [0 <= shift + n < len(words) and words[shift + n] == w for n, w in enumerate(item)]
                if sum(same) >= window - substitutions:
                    best = max([best, *(sum(same[s: s + window]) for s in range(len(item) - window + 1))])
            if best >= window - substitutions:
                rows.add((doc_id, item_id, best))
    return rows


PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly boil purple jam"
LEAKS = [
    (1, f"before {PASSAGE} after"), (2, f"x {PASSAGE.replace('fox', 'cat').replace('lazy', 'idle')}. y"),
    (3, PASSAGE.replace("fox", "a").replace("over", "b").replace("dog", "c").replace("wizards", "d").replace("boil", "e")),
    (4, "The QUICK, brown -- fox jumps over the lazy dog; while seven wizards"), (5, None), (6, ""),
    (7, "nothing of the kind " * 40), (None, f"{PASSAGE} {PASSAGE}"), (1, f"before {PASSAGE} after"),
    (8, PASSAGE.split(" ", 4)[4] + " x" * 20_000), (9, " ".join(PASSAGE.split()[:11])),
]
ITEMS = [(1, PASSAGE), (1, PASSAGE), (2, "too short"), (3, None), (None, PASSAGE + " and more"), (4, "z " * 3000)]


def test_decontaminate_substitutions(spark):
    docs = spark.createDataFrame(LEAKS, "doc_id long, text string").withColumn("n_equal", F.lit("clash"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.overlaps(docs, items).select("doc_id", "item_id", "n_equal").collect()
    assert {tuple(row) for row in got} == overlapping(LEAKS, ITEMS)
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    hit = {doc_id for doc_id, _, _ in overlapping(LEAKS, ITEMS)}
    assert ordered((r.doc_id,) for r in left.collect()) == ordered((i,) for i, _ in LEAKS if i not in hit)


def test_decontaminate_many_seeds_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 3)
    test_decontaminate_substitutions(spark)


def test_decontaminate_odd_and_empty(odd_docs, no_docs, spark):
    items = spark.createDataFrame([(1, " ".join(f"w{n}" for n in range(4000, 4030)))], "item_id long, text string")
    got = decontaminate.overlaps(odd_docs, items).select("doc_id", "item_id", "n_equal").collect()
    assert {tuple(r) for r in got} == overlapping(ODD_TEXTS, [(1, " ".join(f"w{n}" for n in range(4000, 4030)))])
    assert decontaminate.overlaps(no_docs, items).count() == 0
    assert decontaminate.overlaps(odd_docs, items.limit(0)).count() == 0
    assert decontaminate.clean(odd_docs, items.limit(0)).count() == len(ODD_TEXTS)


def test_masks_must_be_sensitive(odd_docs):
    with pytest.raises(ValueError):
        decontaminate.overlaps(odd_docs, odd_docs.select(F.lit(1).alias("item_id"), "text"), masks=((0, 1, 2, 3, 4),))


# ---- pigeonhole and components ----

@pytest.mark.parametrize("distance", [1, 2])
def test_close_pairs_connect_what_is_close(spark, distance):
    rng = np.random.default_rng(7)
    centre = int(rng.integers(0, 2**63))
    fps = {centre ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in (0, 1, 2, 3) for _ in range(90)}
    fps |= {int(x) for x in rng.integers(-2**63, 2**63, 300)}
    fps = sorted(x - (1 << 64) if x >> 63 and x > 0 else x for x in fps)
    pairs = close_pairs(spark.createDataFrame([(x,) for x in fps], "fp long"), distance)
    got = pairs.collect()
    assert all(bin((r.u ^ r.v) & (2**64 - 1)).count("1") <= distance and r.u < r.v for r in got)
    want = brute.components(fps, lambda a, b: bin((fps[a] ^ fps[b]) & (2**64 - 1)).count("1") <= distance)
    roots = {r.node: r.root for r in connected(pairs).collect()}
    assert [roots.get(x, x) for x in fps] == want


def test_components_of_a_long_chain_and_none(spark):
    links = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.root for r in connected(links).collect()} == {0}
    assert connected(links.limit(0)).count() == 0


# ---- line dedup ----

def test_edit_distance_by_table():
    rng = np.random.default_rng(2)
    for _ in range(1500):
        a, b = (list(rng.integers(0, 3, rng.integers(0, 14))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        for most in (2, 5, 20):
            found = edit.distance(a, b, most)
            assert found == row[-1] if row[-1] <= most else found > most
    assert edit.similar("", "", 0.8) and edit.similar("abcde", "abcdx", 0.8) and not edit.similar("abcd", "abcx", 0.8)


def kept_lines(docs, least=0.8):
    """Comparable lines with their places, and the group of each by the edit similarity of all pairs alone."""
    places = []
    for doc_id, text in docs:
        for number, line in enumerate((text or "").encode().split(b"\n")):
            if normal := lines.normalised(line):
                places.append((doc_id, text, number, normal))
    normals = sorted({normal for *_, normal in places})
    words = [normal.split() for normal in normals]

    def linked(a, b):
        return len(words[a]) >= lines.MIN_WORDS and len(words[b]) >= lines.MIN_WORDS and edit.similar(
            words[a], words[b], least)

    group = brute.components(list(range(len(normals))), linked)
    return places, group, {normal: k for k, normal in enumerate(normals)}


NEAR = "this line tells about a river that flows slowly through the wide green valley in spring and summer"
LINE_DOCS = [
    (3, f"{NEAR}\nshort one\n{NEAR}"), (1, f"alpha beta gamma delta epsilon\n{NEAR.replace('slowly', 'slovly')}\nshort one"),
    (2, f"Alpha, beta; gamma -- DELTA epsilon!\nunlike all the others is this very line\n\n"), (4, None), (5, ""),
    (6, "on 12 May 1999 he paid 500 in cash\nOn 13 may 2001 he paid 700 in cash"), (7, "x" * 70_000 + " a b c d e"),
    (None, NEAR.upper()), (7, "x" * 70_000 + " a b c d e"), (8, "\n".join(f"{NEAR} {n} {'abcdefghij'[n % 10] * 2}" for n in range(60))),
]


def test_line_dedup_groups(spark):
    docs = spark.createDataFrame(LINE_DOCS, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    got = lines.dedup(docs).collect()
    places, group, index = kept_lines(LINE_DOCS)
    first = {}
    for doc_id, text, number, normal in places:
        order = (doc_id is None, doc_id or 0, number)
        first[group[index[normal]]] = min(first.get(group[index[normal]], order), order)
    want = []
    for doc_id, text in LINE_DOCS:
        parts = (text or "").encode().split(b"\n")
        left = [line for number, line in enumerate(parts)
                if not (n := lines.normalised(line)) or first[group[index[n]]] == (doc_id is None, doc_id or 0, number)]
        want.append((doc_id, text if len(left) == len(parts) else b"\n".join(left).decode(),
                     len(parts) if text else 0, len(parts) - len(left)))
    assert ordered((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got) == ordered(want)
    assert sum(r.n_removed for r in got) >= 8


def test_line_dedup_query_whole_table(spark, small_docs):
    got = {r.doc_id: r for r in queries.op2_line_dedup(spark, SF_DIR).collect()}
    places, group, index = kept_lines(small_docs)
    first = {}
    for doc_id, _, number, normal in places:
        first[group[index[normal]]] = min(first.get(group[index[normal]], (doc_id, number)), (doc_id, number))
    for doc_id, text in small_docs:
        parts = text.encode().split(b"\n")
        left = [line for number, line in enumerate(parts)
                if not (n := lines.normalised(line)) or first[group[index[n]]] == (doc_id, number)]
        assert got[doc_id].n_removed == len(parts) - len(left)
        assert got[doc_id].text_md5 == md5(b"\n".join(left)).hexdigest()


def test_line_dedup_odd_and_empty(odd_docs, no_docs):
    rows = lines.dedup(odd_docs)
    assert rows.columns == [*odd_docs.columns, "n_lines", "n_removed"]
    assert rows.count() == len(ODD_TEXTS) and lines.dedup(no_docs).count() == 0


# ---- language ----

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.TextModel.fit(docs.where("doc_id % 5 != 0"))
    held = docs.where("doc_id % 5 = 0").select("lang", "text").collect()
    right = sum(model.langs[int(np.argmax(model.posterior(r.text)))] == r.lang for r in held)
    assert right >= 0.97 * len(held)


def fused(pages, model):
    """The same evidence multiplied in plain Python."""
    size, rows = len(model.langs), []
    for page_id, url, page in pages:
        host = (url or "").partition("://")[2]
        host = re.split(r"[/?#]", host)[0].translate(brute.ASCII_LOWER)
        host = re.sub(r":\d*$", "", host) if host else None
        domain = ".".join(host.split(".")[-2:]) if host is not None else None
        suffix = host.split(".")[-1] if host and "." in host else None
        p = np.array(model.posterior(language.visible(page or "")))
        rows.append((page_id, host, domain, suffix, language.declared(page or ""), p))
    def total(at, value):
        chosen = [np.floor(r[5] * 1e6 + 0.5) for r in rows if at is None or r[at] == value]
        return sum(chosen, np.zeros(size)) / 1e6
    whole = total(None, None)
    whole = (whole + language.DOMAIN_WEIGHT / size) / (whole.sum() + language.DOMAIN_WEIGHT)
    def drawn(counts, parent, weight):
        return (counts + weight * parent) / (counts.sum() + weight)
    out = []
    for page_id, host, domain, suffix, said, p in rows:
        prior = whole if host is None else drawn(
            total(1, host), drawn(total(2, domain), whole, language.DOMAIN_WEIGHT), language.HOST_WEIGHT)
        q = prior * p
        for at, value in ((4, said), (3, suffix)):
            q = q * (drawn(total(at, value), whole, language.TRUST_WEIGHT) / whole if value is not None else 1 / size)
        out.append((page_id, model.langs[int(np.argmax(q))], round(float(q.max() / q.sum()), 5)))
    return out


PAGES = [
    (1, "http://a.example.de/x", "<html lang='de'><p>der die das und ist nicht</p></html>"), (2, None, None), (3, "", ""),
    (4, "http://a.example.de/y", "<html lang=en><p>und der die ein</p>"), (5, "no scheme", "<p>the of and"), (5, "no scheme", "<p>the of and"),
    (6, "http://b.example.fr:80/", "<script>der die das</script><!-- und --> le la les &eacute;t&eacute;"), (None, "http://localhost/", "<html lang=\"fr\">"),
    (7, "http://a.example.de/z", "<p>" + "the of and " * 30_000),
]


def test_language_fusion(spark):
    docs = spark.createDataFrame(
        [("de", "der die das und ist nicht ein eine " * 20), ("en", "the of and to in is that for it " * 20),
         ("fr", "le la les et est un une dans que été " * 20), (None, "x y z"), ("en", None)], "lang string, text string")
    model = language.TextModel.fit(docs)
    assert model.langs == ["de", "en", "fr"]
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("lang", F.lit("clash"))
    got = language.identify(pages, model).collect()
    assert ordered((r.page_id, r.lang, round(r.probability, 5)) for r in got) == ordered(fused(PAGES, model))
    assert language.identify(pages.limit(0), model).count() == 0
    nothing = language.identify(pages, language.TextModel.fit(docs.limit(0)))
    assert {(r.lang, r.probability) for r in nothing.collect()} == {("und", 0.0)}


def test_language_query_whole_table(spark):
    got = queries.op3_language_id(spark, SF_DIR).collect()
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    model = language.TextModel.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    want = fused(pages, model)
    assert ordered((r.page_id, r.lang) for r in got) == ordered(w[:2] for w in want)
    close = dict((w[0], w[2]) for w in want)
    assert all(abs(r.probability - close[r.page_id]) < 2e-5 for r in got)


# ---- pseudonyms ----

PERSONAL = [
    (1, "card 4539 1488 0343 6467 and 4539148803436467 and again 4539-1488-0343-6467."), (2, "not a card 4539 1488 0343 6466"),
    (3, "born 1984-02-29, not 1983-02-29, 31.12.1999 and 12/11/2001"), (4, "ssn 123-45-6789, never 000-12-3456"),
    (5, "call +1 (017) 555-7713 or +49 30 1234567"), (6, "from 97.51.17.173 not 300.1.1.1 or 1.2.3.4.5"),
    (7, "GB82 WEST 1234 5698 7654 32 and DE89370400440532013000"), (8, "und.34@mail7.example.com"), (9, None), (10, ""),
    (11, "in 1999 there were 12345 of 20 kinds, version 1.2.3"), (11, "in 1999 there were 12345 of 20 kinds, version 1.2.3"),
    (12, "9" * 5000 + " " + "4539148803436467 " * 3000), (None, "4539148803436467"),
]


def test_pseudonyms_keep_format_and_come_back(spark):
    docs = spark.createDataFrame(PERSONAL, "doc_id long, text string").withColumn("n_card", F.lit("clash"))
    made = pii.pseudonymise(docs, b"key").collect()
    texts = [r.text for r in made]
    for (doc_id, text), row in zip(PERSONAL, made):
        if text:
            assert re.sub(r"[a-z]", "a", re.sub(r"\d+", lambda m: "0" * len(m.group()) if "." not in text else "0", text)) == \
                re.sub(r"[a-z]", "a", re.sub(r"\d+", lambda m: "0" * len(m.group()) if "." not in text else "0", row.text)) or doc_id in (3, 5, 6, 8)
    assert texts[1] == PERSONAL[1][1] and texts[10] == PERSONAL[10][1] and texts[8] is None and texts[9] == ""
    first = re.findall(r"4[\d -]{15,18}", texts[0])
    plain = {pii._digits(x) for x in first}
    assert len(plain) == 1 and plain != {"4539148803436467"}  # one value in three forms is one pseudonym
    assert pii.luhn_digit(next(iter(plain))[:-1]) == next(iter(plain))[-1]
    assert next(iter(plain)) == texts[13] and texts[12].count(texts[13]) == 3000
    assert "1983-02-29" in texts[2] and "1984-02-29" not in texts[2]
    assert "300.1.1.1" in texts[5] and "1.2.3.4.5" in texts[5] and "97.51.17.173" not in texts[5]
    assert [made[n][f"n_{k}"] for n, k in ((0, "card"), (2, "date"), (2, "date_dotted"), (3, "social"), (4, "phone"),
                                          (5, "ipv4"), (6, "iban"), (7, "mail"))] == [3, 1, 2, 1, 2, 1, 2, 1]
    back = pii.pseudonymise(spark.createDataFrame(
        [(r.doc_id, r.text) for r in made], "doc_id long, text string"), b"key", back=True).collect()
    assert [r.text for r in back] == [t for _, t in PERSONAL]
    assert [r.text for r in pii.pseudonymise(docs, b"other").collect()] != texts
    assert pii.pseudonymise(docs.limit(0), b"key").count() == 0


def test_feistel_is_a_permutation():
    feistel = pii.Feistel(b"k")
    for size in (1, 2, 10, 97, 1000):
        assert sorted(feistel.number("n", x, size) for x in range(size)) == list(range(size))
        assert all(feistel.number("n", feistel.number("n", x, size), size, True) == x for x in range(size))
    for length in (1, 2, 3):
        values = [str(x).zfill(length) for x in range(10 ** length)]
        assert sorted(feistel.text("t", v, pii.DIGITS) for v in values) == values


def test_pseudonyms_query_round_trip(spark, small_docs):
    made = queries.op5_pii_pseudonyms(spark, SF_DIR)
    back = pii.pseudonymise(made.select("doc_id", "text"), queries.PSEUDONYM_KEY, back=True)
    assert ordered((r.doc_id, r.text) for r in back.collect()) == ordered(small_docs)
    assert made.where("n_card + n_phone + n_ipv4 > 0").count() > 0


# ---- mixing ----

def shared_out(budget, children):
    """Budgets by repeated filling: exact fractions, rounded down at the end."""
    open_, given, left = dict(children), {}, budget
    while open_:
        weight = sum(w for _, w in open_.values())
        full = [n for n, (supply, w) in open_.items() if supply <= Fraction(left * w, weight)]
        if not full:
            return given | {n: int(Fraction(left * w, weight)) for n, (_, w) in open_.items()}
        for name in full:
            given[name] = open_.pop(name)[0]
        left = budget - sum(given.values())
    return given


def mixed(docs, mix):
    """docs: (doc_id, domain, lang, source, n_tokens)."""
    docs = [d for d in docs if d[4]]
    weights = (mix.domains, mix.langs, mix.sources)
    alive = [d for d in docs if all(w.get(d[1 + k], 1) > 0 for k, w in enumerate(weights))]
    budgets = {(): sum(d[4] for d in docs) * mix.budget_percent // 100}
    for level in range(3):
        nxt = {}
        for parent, budget in budgets.items():
            children = {}
            for d in alive:
                if d[1:1 + level] == parent:
                    name = d[1 + level]
                    children[name] = (children.get(name, (0,))[0] + d[4] * mix.max_epochs, weights[level].get(name, 1))
            nxt |= {parent + (n,): b for n, b in shared_out(budget, children).items()}
        budgets = nxt
    rows = []
    for leaf, budget in budgets.items():
        own = [d for d in alive if d[1:4] == leaf]
        epochs, tail = divmod(budget, sum(d[4] for d in own))
        own.sort(key=lambda d: (md5(f"{mix.seed}:{epochs}:{'' if d[0] is None else d[0]}".encode()).hexdigest(), d[4]))
        for d in own:
            take = min(d[4], tail)
            tail -= take
            if epochs or take:
                rows.append((*d, epochs, take))
    return rows


@pytest.mark.parametrize("mix", [
    mixing.Mix({"a": 5, "b": 3}, {"en": 4}, {"s1": 7}, 60, 2, 1), mixing.Mix({"a": 1000, "b": 1}, {}, {}, 150, 2, 2),
    mixing.Mix({"b": 0}, {"en": 9}, {}, 500, 3, 3), mixing.Mix({}, {}, {}, 0, 1, 4),
])
def test_mixing_trees(spark, mix):
    rng = np.random.default_rng(5)
    docs = [(n if n % 9 else None, "ab"[int(rng.random() < 0.2)], ["en", "de", None][int(rng.integers(3))],
             [f"s{k}" for k in range(5)][int(rng.integers(5)) if n % 3 else 0], " ".join("w" * int(rng.integers(0, 40))))
            for n in range(400)]
    docs += docs[:20] + [(7, "a", "en", "s1", None), (8, "b", "fr", "long", "w " * 30_000)]
    frame = spark.createDataFrame(docs, "doc_id long, domain string, lang string, source string, text string").withColumn("tail", F.lit(1))
    got = mixing.select_mix(frame, F.col("domain"), mix).collect()
    want = mixed([(i, d or "", l or "", s or "", len((t or "").split())) for i, d, l, s, t in docs], mix)
    assert ordered(got) == ordered(want)


def test_mixing_odd_and_empty(odd_docs, no_docs):
    got = mixing.select_mix(odd_docs, queries.domain(), queries.MIX).collect()
    assert sum(r.n_tokens * r.epochs + r.tail_tokens for r in got) <= 0.6 * sum(len(brute.words_of(t)) for _, t in ODD_TEXTS)
    assert mixing.select_mix(no_docs, queries.domain(), queries.MIX).count() == 0

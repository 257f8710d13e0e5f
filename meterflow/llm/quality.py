"""Quality rules: base statistics of a text, and a decision list learned from labelled ones.

Sequential covering: a rule is grown as a conjunction of thresholds that separates rejected from
good examples, pruned on examples it was not grown on, and accepted only if it is precise there;
the examples it covers are set aside and the next rule is grown. The list becomes one ordered
conditional expression, so applying it is plain column arithmetic.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from meterflow.llm.shared import map_texts

MAX_LABELLED = 20_000
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
PUNCTUATION = b"!\"'(),-./:;?@[\\]^_`{}~+="
DIGITS = b"0123456789"
CONTINUATION = bytes(range(0x80, 0xC0))
BLANKS = b" \t\n\v\f\r"

STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_punctuation long, n_digits long, n_distinct_words long")


def count_of(data: bytes, characters: bytes) -> int:
    return len(data) - len(data.translate(None, characters))


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words inside a window of words that occurs at least twice in the text, first one included."""
    grams = list(zip(*(words[n:] for n in range(window))))
    if len(set(grams)) == len(grams):
        return 0
    seen: dict[tuple, int] = {}
    for gram in grams:
        seen[gram] = seen.get(gram, 0) + 1
    total = reach = 0
    for at, gram in enumerate(grams):
        if seen[gram] > 1:
            total += at + window - max(at, reach)
            reach = at + window
    return total


def statistics_of(data: bytes) -> tuple:
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words), len(data.translate(None, CONTINUATION + BLANKS)), count_of(data, SYMBOLS),
        len(lines) - len(set(lines)), repeated_words(words), len(lines), count_of(data, UPPER),
        count_of(data, PUNCTUATION), count_of(data, DIGITS), len(set(words)))


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and the statistics of every whole text; null counts as empty."""
    return map_texts(docs, keep, STATISTICS, lambda texts: map(statistics_of, texts))


def features() -> dict[str, Column]:
    """What rules may hold against a threshold: shares, so that a text's length does not decide."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "chars_per_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "upper_share": F.col("n_upper") / chars,
        "punctuation_share": F.col("n_punctuation") / chars,
        "digit_share": F.col("n_digits") / chars,
        "distinct_share": F.col("n_distinct_words") / words,
    }


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, frame: pd.DataFrame) -> np.ndarray:
        values = frame[self.feature].to_numpy()
        return values > self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, frame: pd.DataFrame) -> np.ndarray:
    held = np.ones(len(frame), bool)
    for condition in rule:
        held &= condition.holds(frame)
    return held


def _thresholds(values: np.ndarray, cuts: int = 64) -> np.ndarray:
    distinct = np.unique(values)
    if len(distinct) > cuts:
        distinct = np.unique(np.quantile(distinct, np.linspace(0, 1, cuts + 1)))
    return (distinct[:-1] + distinct[1:]) / 2


def grow(frame: pd.DataFrame, bad: np.ndarray, names: list[str], most: int = 4) -> Rule:
    """Add the condition of highest information gain until only bad examples are covered."""
    rule: Rule = ()
    inside = np.ones(len(frame), bool)
    while len(rule) < most and (inside & ~bad).any():
        hits, all_in = int((inside & bad).sum()), int(inside.sum())
        before = np.log2(max(hits, 1e-9) / max(all_in, 1))
        best, best_gain = None, 1e-9
        for name in names:
            for threshold in _thresholds(frame[name].to_numpy()[inside]):
                for above in (True, False):
                    condition = Condition(name, above, float(threshold))
                    held = inside & condition.holds(frame)
                    good_hits = int((held & bad).sum())
                    if good_hits:
                        gain = good_hits * (np.log2(good_hits / int(held.sum())) - before)
                        if gain > best_gain:
                            best, best_gain = condition, gain
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(frame)
    return rule


def prune(rule: Rule, frame: pd.DataFrame, bad: np.ndarray) -> Rule:
    """The leading conditions that do best on other examples; the shorter of equals."""

    def worth(short: Rule) -> float:
        held = covers(short, frame)
        hits, misses = int((held & bad).sum()), int((held & ~bad).sum())
        return (hits - misses) / (hits + misses) if hits + misses else -1.0

    return max((rule[:n] for n in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)),
               default=())


def cover(
    frame: pd.DataFrame, bad: np.ndarray, names: list[str], precision: float = 0.95,
    most_rules: int = 12, least_hits: int = 3,
) -> list[Rule]:
    """Sequential covering of the bad examples; even rows grow, odd rows prune and judge."""
    rules: list[Rule] = []
    grown, other = np.arange(len(frame)) % 2 == 0, np.arange(len(frame)) % 2 == 1
    left = np.ones(len(frame), bool)
    for _ in range(most_rules):
        if not (left & grown & bad).any():
            break
        rule = grow(frame[left & grown], bad[left & grown], names)
        rule = prune(rule, frame[left & other], bad[left & other])
        if not rule:
            break
        held = covers(rule, frame) & left
        hits = int((held & bad & other).sum())
        if hits < least_hits or hits < precision * int((held & other).sum()):
            break
        rules.append(rule)
        left &= ~held
    return rules


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """A decision list from at most ``max_labelled`` labelled documents.

    Labelled ids are taken in the order of their hash, so the choice does not depend on the
    layout. Ids with contradicting labels and labels without a document are not used; documents
    that the base rules reject have nothing to teach. No labels give an empty list.
    """
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("quality"))
        .where("low = quality").select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    # At most max_labelled rows of two numbers.
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    names = list(features())
    frame = (
        statistics(labelled, ["doc_id", "quality"]).where(~base_failed())
        .select("doc_id", "quality", *[value.alias(name) for name, value in features().items()])
        .orderBy(F.xxhash64("doc_id"), "doc_id", *names).limit(max_labelled).toPandas())
    return cover(frame, frame["quality"].to_numpy() == 0, names)


def fired(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects a row, null if none does."""
    chain = None
    for number, rule in enumerate(rules):
        held = F.lit(True)
        for condition in rule:
            held &= condition.column()
        chain = F.when(held, number) if chain is None else chain.when(held, number)
    return F.lit(None).cast("int") if chain is None else chain


def judge(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, **learning) -> DataFrame:
    """Statistics, ``base_failed``, ``rule`` (the learned rule that fired) and ``kept``.

    One row per input row, repeated rows included. A null or empty text has no words and fails the
    base rules. Columns of the documents appear only as named in ``keep``.
    """
    rules = learn(docs, labels, **learning)
    failed = base_failed()
    return statistics(docs, keep or ["doc_id"]).withColumns({
        "base_failed": failed, "rule": fired(rules),
    }).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def accept(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """The documents, all columns under their own names, that the rules keep."""
    plain = docs.select(*[F.col(f"`{name}`").alias(f"_c{n}") for n, name in enumerate(docs.columns)],
                        "text")
    rules = learn(docs, labels, **learning)
    kept = statistics(plain, [f"_c{n}" for n in range(len(docs.columns))]).where(
        ~base_failed() & fired(rules).isNull())
    return kept.select(*[F.col(f"_c{n}").alias(name) for n, name in enumerate(docs.columns)])

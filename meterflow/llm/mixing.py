"""Mixing sources to target weights over a tree of domains, languages and sources.

The token budget is handed down the tree by weight. No subtree gets more than it can supply in
the allowed number of epochs; what it cannot use goes to its siblings first, and only what a whole
subtree cannot use goes to the siblings of its ancestors. A leaf with a budget of k times its
tokens is read k times in full, and once more up to a prefix of a seeded order of its documents.

Sums and products are integers, so the result does not depend on the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterflow.llm.shared import staged
from meterflow.operators.skew import broadcast_if_small

LEVELS = ["domain", "lang", "source"]
WHOLE = "decimal(38,0)"
SLOT_DIGITS = 3


@dataclass(frozen=True)
class Mix:
    """Targets: integer weights by name (one for names not listed), and the budget."""

    domains: dict[str, int] = field(default_factory=dict)
    langs: dict[str, int] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)
    budget_percent: int = 60
    max_epochs: int = 4
    seed: int = 17


def n_tokens(text: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(name: str, weights: dict[str, int]) -> Column:
    chain = F.lit(1)
    for value, weight in sorted(weights.items()):
        chain = F.when(F.col(name) == value, F.lit(weight)).otherwise(chain)
    return chain.cast("long")


def share_out(children: DataFrame, parent: list[str], order: str) -> DataFrame:
    """``budget`` of each child from its parent's ``parent_budget``, weights and ``supply``.

    Children in the order of supply per weight are filled as long as their proportional part of
    what is left exceeds their supply; the others share the rest by weight, rounded down.
    """
    siblings = Window.partitionBy(*parent)
    ranked = siblings.orderBy("_ratio", order)
    whole = {name: F.col(name).cast(WHOLE) for name in ("supply", "weight", "parent_budget")}
    filled = F.col("_full")
    weighed = children.where("weight > 0").withColumn("_ratio", F.col("supply") / F.col("weight"))
    placed = weighed.withColumns({
        "_before": F.coalesce(F.sum("supply").over(
            ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_rest": F.sum("weight").over(ranked.rowsBetween(0, Window.unboundedFollowing)),
    }).withColumn("_full", whole["supply"] * F.col("_rest").cast(WHOLE)
                  <= F.greatest(whole["parent_budget"] - F.col("_before"), F.lit(0)) * whole["weight"])
    left = placed.withColumns({
        "_left": (F.col("parent_budget") - F.coalesce(
            F.sum(F.when(filled, F.col("supply"))).over(siblings), F.lit(0))).cast(WHOLE),
        "_weights": F.sum(F.when(~filled, F.col("weight"))).over(siblings).cast(WHOLE)})
    return left.withColumn("budget", F.when(filled, F.col("supply")).otherwise(
        F.expr("cast(_left as decimal(38,0)) * cast(weight as decimal(38,0)) div _weights")
        .cast("long"))).drop("_ratio", "_before", "_rest", "_full", "_left", "_weights")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``budget`` and ``tokens`` of every leaf; one row per leaf goes in, so this stays small.

    Subtrees without tokens or with a weight of zero get nothing, as if they were not there.
    """
    weights = dict(zip(LEVELS, (mix.domains, mix.langs, mix.sources)))
    alive = leaves.where("tokens > 0")
    for name in LEVELS:
        alive = alive.where(_weight(name, weights[name]) > 0)
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    current, parent = None, []
    for name in LEVELS:
        group = parent + [name]
        supply = alive.groupBy(*group).agg((F.sum("tokens") * mix.max_epochs).alias("supply"))
        above = supply.withColumn(
            "parent_budget", F.lit(total * mix.budget_percent // 100)) if current is None else \
            supply.join(current.select(*parent, F.col("budget").alias("parent_budget")), parent)
        current = share_out(
            above.withColumn("weight", _weight(name, weights[name])), parent, name)
        parent = group
    return current.select(*LEVELS, "budget", (F.col("supply") / mix.max_epochs).cast("long").alias("tokens"))


def select_mix(docs: DataFrame, domain: Column, mix: Mix) -> DataFrame:
    """One row per document that is used: its leaf, ``n_tokens``, ``epochs`` and ``tail_tokens``.

    ``epochs`` counts full readings, ``tail_tokens`` is the prefix of the document that belongs
    to the last, partial reading of its leaf. Null names count as empty ones, a null text has no
    tokens and is never used. Repeated rows are separate; rows of equal id and length are
    interchangeable. Columns of the documents beyond the named ones are not carried on.
    """
    empty = F.lit("")
    counted = staged(docs.select(
        "doc_id", F.coalesce(domain, empty).alias("domain"),
        F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"),
        n_tokens().alias("n_tokens")).where("n_tokens > 0"), "counted")
    leaves = staged(
        leaf_budgets(counted.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), mix)
        .select(*LEVELS, F.expr("budget div tokens").alias("epochs"),
                (F.col("budget") % F.col("tokens")).alias("tail")), "leaves")
    key = F.md5(F.concat_ws(
        ":", F.lit(str(mix.seed)), F.col("epochs").cast("string"),
        F.coalesce(F.col("doc_id").cast("string"), empty)))
    drawn = staged(
        counted.join(broadcast_if_small(leaves), LEVELS).withColumn("_key", key)
        .withColumn("_slot", F.substring("_key", 1, SLOT_DIGITS)), "drawn")
    # Seeded keys are spread evenly: only the slot that the prefix ends in must be ordered.
    upto = Window.partitionBy(*LEVELS).orderBy("_slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ends = staged(
        drawn.where("tail > 0").groupBy(*LEVELS, "_slot", "tail")
        .agg(F.sum("n_tokens").alias("_sum")).withColumn("_upto", F.sum("_sum").over(upto))
        .where("_upto >= tail and _upto - _sum < tail")
        .select(*LEVELS, F.col("_slot").alias("_end"), (F.col("_upto") - F.col("_sum")).alias("_before")),
        "ends")
    marked = drawn.join(broadcast_if_small(ends), LEVELS, "left")
    outside = marked.where("_end is null or _slot != _end").withColumn(
        "tail_tokens", F.when(F.col("_slot") < F.col("_end"), F.col("n_tokens")).otherwise(F.lit(0)))
    within = Window.partitionBy(*LEVELS).orderBy("_key", "n_tokens").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    at_end = marked.where("_slot = _end").withColumn(
        "_start", F.col("_before") + F.sum("n_tokens").over(within) - F.col("n_tokens")).withColumn(
        "tail_tokens", F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("tail") - F.col("_start"))))
    out = ["doc_id", *LEVELS, "n_tokens", "epochs", "tail_tokens"]
    return outside.select(*out).union(at_end.select(*out)).where("epochs > 0 or tail_tokens > 0")

"""Isolation forest: profile, training, model as data, and two scorers.

Training follows Liu, Ting, Zhou 2008: trees of random axis-parallel splits on small samples.
Scoring compares values as 32-bit floats with the split thresholds.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from meterflow.functions import path_normaliser
from meterflow.operators.skew import exact_percentile, global_rank, materialise
from meterflow.schemas import MODEL, TREE

ALL_FEATURES = [
    "event_count_15m", "avg_voltage_15m", "voltage_range_15m", "power_failure_count_15m",
]
ROW_KEY = ["msn", "window_start"]
N_TREES, CONTAMINATION, SEED, MAX_SAMPLES = 200, 0.10, 42, 256
LEAF = -2
# Draws are located in so many leading bits of a hash, then in so many more at a time, until a
# drawn cell has at most so many rows.
CELL_BITS, FINER_BITS, CELL_ROWS = 16, 4, 4096


@dataclass
class ForestModel:
    """Model header and trees; a few hundred trees of a few hundred nodes, so driver-sized."""

    features: list[str]
    trees: list[dict]
    offset: float
    normalization_c: float
    max_samples: int
    contamination: float = CONTAMINATION
    excluded_constant_features: list[str] = field(default_factory=list)
    model_type: str = "IsolationForest"
    sklearn_version: str = ""
    n_estimators: int = 0

    def __post_init__(self) -> None:
        self.n_estimators = len(self.trees)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The model as one row, ready for ``write.json`` or ``write.parquet``."""
        return spark.createDataFrame([asdict(self)], MODEL)

    @classmethod
    def from_frame(cls, model: DataFrame) -> ForestModel:
        record = model.first().asDict(recursive=True)
        record.pop("n_estimators")
        return cls(**record)

    def depth(self) -> int:
        """Most splits on any path."""
        deepest = 0
        for tree in self.trees:
            level, nodes = 0, [0]
            while nodes := [
                child for node in nodes
                if tree["children_left"][node] != tree["children_right"][node]
                for child in (tree["children_left"][node], tree["children_right"][node])
            ]:
                level += 1
            deepest = max(deepest, level)
        return deepest


def load_model(spark: SparkSession, path: str) -> ForestModel:
    """A model written as one JSON document."""
    return ForestModel.from_frame(spark.read.schema(MODEL).option("multiLine", True).json(path))


def save_model(spark: SparkSession, model: ForestModel, path: str) -> None:
    model.to_frame(spark).coalesce(1).write.mode("overwrite").json(path)


# ---- profile ---------------------------------------------------------------------------------

def feature_profile(rows: DataFrame, features: list[str] = ALL_FEATURES) -> DataFrame:
    """Per feature: rows, meters, missing values, distinct values and whether it varies."""
    overall = rows.agg(
        F.count("*").alias("rows"), F.count_distinct("msn").alias("meters"),
        *[F.count_if(F.col(name).isNull()).alias(f"missing_{name}") for name in features],
        *[F.count_distinct(name).alias(f"distinct_{name}") for name in features])
    per_feature = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.col(f"missing_{name}").alias("missing"),
                 F.col(f"distinct_{name}").alias("distinct_values"),
                 (F.col(f"distinct_{name}") > 1).alias("varies"))
        for name in features])
    return overall.select("rows", "meters", F.inline(per_feature))


def varying_features(rows: DataFrame, features: list[str] = ALL_FEATURES) -> list[str]:
    """Features with more than one value; smallest and largest decide, no distinct needed."""
    differs = rows.agg(
        *[(F.min(name) < F.max(name)).alias(name) for name in features]).first()
    return [name for name in features if differs[name]]


# ---- training --------------------------------------------------------------------------------

def _complete(rows: DataFrame, features: list[str]) -> DataFrame:
    return rows.where(reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in features]))


def draw_samples(
    rows: DataFrame, features: list[str], n_trees: int, max_samples: int, seed: int = SEED,
    cell_rows: int = CELL_ROWS,
) -> tuple[DataFrame, int]:
    """``tree_index`` and ``slot`` with the features: each tree's own draw from all complete rows.

    Rows are numbered in the order of a hash of their key, so a draw depends on the data and the
    seed but not on the layout. No row is sorted to be numbered: rows are counted by the leading
    bits of the hash, the counts tell in which cell a drawn number lies and how far in, and only
    drawn cells are read again, in finer ones, until none holds more than ``cell_rows``. Equal rows
    are one row with a count. Also the sample size.
    """
    spark = rows.sparkSession
    left = materialise(_complete(rows, features).select(
        *ROW_KEY, *features, F.xxhash64(F.lit(seed), *ROW_KEY).alias("_hash")))
    bits = CELL_BITS
    counted = _cell_counts(left, bits)
    available = int(counted["n"].sum())
    size = min(max_samples, available)
    rng = np.random.default_rng(seed)
    # n_trees x max_samples numbers: bounded by the two parameters, as are the drawn cells.
    draws = pd.DataFrame({
        "tree_index": np.repeat(np.arange(n_trees), size),
        "slot": np.concatenate([_distinct_draw(rng, available, size) for _ in range(n_trees)]),
    }).astype("int64")
    largest = _locate(draws, counted)
    while largest > cell_rows and bits < 64:
        left = materialise(_in_cells(left, draws, bits).drop("_cell"))
        finer = min(64, bits + FINER_BITS)
        largest = _locate(draws, _cell_counts(left, finer), finer - bits)
        bits = finer
    same = _in_cells(left, draws, bits).groupBy("_cell", "_hash", *ROW_KEY, *features).agg(
        F.count("*").alias("_n"))
    upto = F.sum("_n").over(
        Window.partitionBy("_cell").orderBy("_hash", *ROW_KEY, *features)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    drawn = F.broadcast(spark.createDataFrame(
        draws, "tree_index int, slot bigint, _drawn bigint, _rank bigint"))
    numbered = same.withColumn("_upto", upto)
    within = (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n"))
    return numbered.join(drawn, (F.col("_cell") == F.col("_drawn")) & within).select(
        "tree_index", "slot", *ROW_KEY, *features), size


def _cell(bits: int) -> Column:
    """The leading bits of the hash, in the order of the hash."""
    return F.shiftright("_hash", 64 - bits)


def _cell_counts(rows: DataFrame, bits: int) -> pd.DataFrame:
    """Rows per cell in the order of the cells, combined map-side.

    At most 2^CELL_BITS cells at first, later 2^FINER_BITS for each drawn one.
    """
    counts = rows.groupBy(_cell(bits).alias("cell")).agg(F.count("*").alias("n")).toArrow()
    return pd.DataFrame({name: counts.column(name).to_numpy() for name in ("cell", "n")}).sort_values(
        "cell", ignore_index=True)


def _locate(draws: pd.DataFrame, counted: pd.DataFrame, split: int | None = None) -> int:
    """Set the cell ``_drawn`` of each draw and its place ``_rank`` there; rows of the largest such cell.

    ``split`` is the number of bits by which the cells counted are finer than those set before.
    """
    if not len(draws):
        draws["_drawn"] = draws["_rank"] = pd.Series(dtype="int64")
        return 0
    cells, upto = counted["cell"].to_numpy(), np.cumsum(counted["n"].to_numpy())
    base = np.concatenate(([0], upto))
    if split is None:
        places = draws["slot"].to_numpy()
    else:
        # Rows counted before the first finer cell of the draw's cell.
        first = np.searchsorted(cells, draws["_drawn"].to_numpy() << split)
        places = base[first] + draws["_rank"].to_numpy()
    at = np.searchsorted(upto, places, side="right")
    draws["_drawn"], draws["_rank"] = cells[at], places - base[at]
    return int(counted["n"].to_numpy()[at].max())


def _in_cells(rows: DataFrame, draws: pd.DataFrame, bits: int) -> DataFrame:
    """The rows of the drawn cells, with ``_cell``."""
    cells = rows.sparkSession.createDataFrame(
        pd.DataFrame({"_cell": np.unique(draws["_drawn"].to_numpy())}), "_cell bigint")
    return rows.withColumn("_cell", _cell(bits)).join(F.broadcast(cells), "_cell")


def _distinct_draw(rng: np.random.Generator, available: int, size: int) -> np.ndarray:
    """``size`` different numbers below ``available``, with memory for the draw alone."""
    if available <= 4 * size:
        return rng.choice(available, size, replace=False)
    drawn = np.unique(rng.integers(available, size=size))
    while len(drawn) < size:
        drawn = np.unique(np.concatenate([drawn, rng.integers(available, size=size - len(drawn))]))
    return drawn


def _grow(values: np.ndarray, rng: np.random.Generator, max_depth: int) -> dict:
    """One tree on a sample: random feature, random threshold between its extremes."""
    left, right, feature, threshold, steps, average = [], [], [], [], [], []

    def add(rows: np.ndarray, depth: int) -> int:
        node = len(left)
        for column, value in ((left, -1), (right, -1), (feature, LEAF), (threshold, float(LEAF)),
                              (steps, depth + 1.0), (average, path_normaliser(len(rows)))):
            column.append(value)
        low, high = values[rows].min(axis=0), values[rows].max(axis=0)
        splittable = np.flatnonzero(low < high)
        if depth >= max_depth or len(rows) <= 1 or not len(splittable):
            return node
        chosen = int(rng.choice(splittable))
        cut = float(rng.uniform(low[chosen], high[chosen]))
        goes_left = values[rows, chosen] <= cut
        feature[node], threshold[node] = chosen, cut
        left[node] = add(rows[goes_left], depth + 1)
        right[node] = add(rows[~goes_left], depth + 1)
        return node

    add(np.arange(len(values)), 0)
    return {"children_left": left, "children_right": right, "feature": feature,
            "threshold": threshold, "decision_path_lengths": steps, "average_path_lengths": average}


def fit_trees(
    samples: DataFrame, features: list[str], size: int, seed: int = SEED,
) -> DataFrame:
    """One row per tree; every tree is grown in its own task from its own sample."""
    max_depth = math.ceil(math.log2(max(size, 2)))

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        index = int(sample["tree_index"].iloc[0])
        values = sample.sort_values("slot")[features].to_numpy(np.float32).astype(np.float64)
        tree = _grow(values, np.random.default_rng([seed, index]), max_depth)
        return pd.DataFrame([{
            "tree_index": index, "feature_indices": list(range(len(features))), **tree}])

    return samples.groupBy("tree_index").applyInPandas(grow, TREE)


def train_and_score(
    rows: DataFrame, features: list[str] = ALL_FEATURES, n_trees: int = N_TREES,
    contamination: float = CONTAMINATION, max_samples: int = MAX_SAMPLES, seed: int = SEED,
) -> tuple[ForestModel, DataFrame]:
    """Fit on the features that vary, and score the rows it was fitted on.

    The offset puts ``contamination`` of the rows below zero. It only shifts the scores, so the trees
    are applied to the rows once and the shift is subtracted afterwards.
    """
    active = varying_features(rows, features)
    if not active:
        raise ValueError("no feature varies")
    samples, size = draw_samples(rows, active, n_trees, max_samples, seed)
    trees = [tree.asDict() for tree in
             fit_trees(samples, active, size, seed).orderBy("tree_index").collect()]
    model = ForestModel(
        features=active, trees=trees, offset=0.0, normalization_c=path_normaliser(size),
        max_samples=size, contamination=contamination,
        excluded_constant_features=[name for name in features if name not in active])
    raw = materialise(rows.withColumn("decision", decision(model)))
    model.offset = exact_percentile(
        raw, [], "decision", contamination, bin_width=1e-4, out="offset").first()["offset"]
    return model, judged(raw.withColumn("decision", F.col("decision") - F.lit(model.offset)))


def train(rows: DataFrame, features: list[str] = ALL_FEATURES, **settings) -> ForestModel:
    """The model alone; see ``train_and_score``."""
    return train_and_score(rows, features, **settings)[0]


# ---- scoring ---------------------------------------------------------------------------------

class _Traversal:
    """Trees as flat arrays for walking many rows at once; leaves lead to themselves."""

    def __init__(self, model: ForestModel) -> None:
        self.depth, self.trees = model.depth(), []
        for tree in model.trees:
            left, right = np.array(tree["children_left"]), np.array(tree["children_right"])
            leaf = left == right
            nodes = np.arange(len(left))
            local = np.where(leaf, 0, tree["feature"])
            self.trees.append((
                np.asarray(tree["feature_indices"])[local],
                np.where(leaf, np.inf, tree["threshold"]),
                np.stack([np.where(leaf, nodes, left), np.where(leaf, nodes, right)], axis=1).ravel(),
                np.asarray(tree["decision_path_lengths"], float)
                + np.asarray(tree["average_path_lengths"], float) - 1.0))
        self.scale = len(model.trees) * model.normalization_c
        self.offset = model.offset

    def decide(self, values: np.ndarray) -> np.ndarray:
        count, width = values.shape
        flat = values.astype(np.float32).astype(np.float64).ravel()
        base = np.arange(count) * width
        total = np.zeros(count)
        for feature, threshold, children, length in self.trees:
            node = np.zeros(count, dtype=np.int64)
            for _ in range(self.depth):
                beyond = flat[base + feature[node]] > threshold[node]
                node = children[2 * node + beyond]
            total += length[node]
        return -np.power(2.0, -total / self.scale) - self.offset


def decision(model: ForestModel) -> Column:
    """Decision score, negative for anomalies, null where a feature is missing."""
    traversal = _Traversal(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            values = np.column_stack([column.to_numpy(np.float64) for column in columns])
            known = ~np.isnan(values).any(axis=1)
            out = np.full(len(values), np.nan)
            out[known] = traversal.decide(values[known])
            yield pd.Series(out).astype(object).where(known, None)

    return score(*[F.col(name).cast("double") for name in model.features])


def decision_sql(model: ForestModel) -> Column:
    """The same score with higher-order functions only, the model being literals.

    Nodes of all trees lie in flat arrays, and leaves lead to themselves: a step is four lookups and a
    comparison, and looks at no tree.
    """
    left, right, feature, threshold, length, roots = [], [], [], [], [], []
    for tree in model.trees:
        roots.append(base := len(left))
        for node, (low, high) in enumerate(zip(tree["children_left"], tree["children_right"])):
            leaf = low == high
            left.append(base + (node if leaf else low))
            right.append(base + (node if leaf else high))
            feature.append(tree["feature_indices"][0 if leaf else tree["feature"][node]])
            threshold.append(0.0 if leaf else tree["threshold"][node])
            length.append(tree["decision_path_lengths"][node] + tree["average_path_lengths"][node] - 1.0)
    array = lambda values, kind: F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")
    left, right, feature = array(left, "int"), array(right, "int"), array(feature, "int")
    threshold, length, roots = array(threshold, "double"), array(length, "double"), array(roots, "int")
    levels = F.sequence(F.lit(1), F.lit(max(model.depth(), 1)))
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in model.features])

    def path_lengths(values: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            beyond = F.get(values, F.get(feature, node)) > F.get(threshold, node)
            return F.when(beyond, F.get(right, node)).otherwise(F.get(left, node))

        return F.aggregate(
            roots, F.lit(0.0), lambda sofar, root: sofar + F.get(length, F.aggregate(levels, root, step)))

    # An array of one, so that the row's values are built once and not at every step.
    values = F.array(*[F.col(name).cast("float").cast("double") for name in model.features])
    total = F.get(F.transform(F.array(values), path_lengths), F.lit(0))
    scale = len(model.trees) * model.normalization_c
    return F.when(complete, -F.pow(F.lit(2.0), -total / scale) - model.offset)


def decisions_by_trees(rows: DataFrame, model: ForestModel) -> DataFrame:
    """Row key and the same score, each row met with each tree: compiled steps, where ``decision_sql`` interprets
    them. One row for each given, whether or not its key is repeated.

    Rows with equal features have equal scores, so each combination of features is scored once and goes back to its
    rows. The trees are broadcast, a row per tree as flat arrays; leaves lead to themselves. Path lengths are added
    up where the combination is.
    """
    spark, depth = rows.sparkSession, model.depth()
    trees = []
    for tree in model.trees:
        children, feature, threshold, length = [], [], [], []
        for node, (low, high) in enumerate(zip(tree["children_left"], tree["children_right"])):
            leaf = low == high
            children += [node, node] if leaf else [low, high]
            feature.append(tree["feature_indices"][0 if leaf else tree["feature"][node]])
            threshold.append(0.0 if leaf else float(tree["threshold"][node]))
            length.append(float(tree["decision_path_lengths"][node] + tree["average_path_lengths"][node] - 1.0))
        trees.append((children, feature, threshold, length))
    columns = [("_children", T.IntegerType()), ("_feature", T.IntegerType()),
               ("_threshold", T.DoubleType()), ("_length", T.DoubleType())]
    nodes = spark.createDataFrame(trees, T.StructType([
        T.StructField(name, T.ArrayType(kind, False), False) for name, kind in columns])).coalesce(1)
    names = [f"_value{n}" for n in range(len(model.features))]
    given = rows.select(*ROW_KEY, *[
        F.col(name).cast("float").cast("double").alias(value) for name, value in zip(model.features, names)])
    walked = _complete(given, names).select(names).distinct().crossJoin(F.broadcast(nodes)).withColumn(
        "_node", F.lit(0))
    for _ in range(depth):
        at = F.get("_feature", F.col("_node"))
        walked = walked.withColumn("_node", F.get("_children", 2 * F.col("_node") + F.when(
            _picked_value(at, len(names)) > F.get("_threshold", F.col("_node")), 1).otherwise(0)))
    scale = len(model.trees) * model.normalization_c
    scored = walked.groupBy(names).agg(F.sum(F.get("_length", F.col("_node"))).alias("_total")).select(
        *names, (-F.pow(F.lit(2.0), -F.col("_total") / scale) - model.offset).alias("decision"))
    return given.join(scored, names, "left").select(*ROW_KEY, "decision")


def _picked_value(at: Column, count: int) -> Column:
    """The value of the feature at a place."""
    value = F.col(f"_value{count - 1}")
    for n in reversed(range(count - 1)):
        value = F.when(at == n, F.col(f"_value{n}")).otherwise(value)
    return value


def label(decision_score: Column) -> Column:
    return F.when(decision_score < 0, "ANOMALY").when(decision_score.isNotNull(), "NORMAL")


def score_rows(rows: DataFrame, model: ForestModel, scorer=decision) -> DataFrame:
    """Add decision, the negated anomaly score, the 1 / -1 prediction and its label."""
    return judged(rows.withColumn("decision", scorer(model)))


def judged(decided: DataFrame) -> DataFrame:
    """What follows from a decision score."""
    verdict = label(F.col("decision"))
    return decided.withColumns({
        "anomaly_score": -F.col("decision"),
        "prediction": F.when(verdict == "ANOMALY", -1).when(verdict == "NORMAL", 1),
        "anomaly_label": verdict})


def most_anomalous_first() -> list[Column]:
    return [F.col("anomaly_score").desc_nulls_last(), *[F.col(name).asc() for name in ROW_KEY]]


def ranked(scored: DataFrame) -> DataFrame:
    """Add ``anomaly_rank`` 1..n over all scored rows."""
    return global_rank(
        scored.where(F.col("anomaly_score").isNotNull()), most_anomalous_first(), "anomaly_rank")


def top_anomalies(scored: DataFrame, count: int = 10) -> DataFrame:
    return scored.orderBy(*most_anomalous_first()).limit(count)


def lowest_decisions(scored: DataFrame, count: int = 6) -> DataFrame:
    return scored.orderBy(F.col("decision").asc_nulls_last(), *ROW_KEY).limit(count)


def anomaly_count(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("anomaly_label") == "ANOMALY").alias("anomalies"))


def parity(one: DataFrame, other: DataFrame) -> DataFrame:
    """Compare two scorings of the same rows, joined on their key."""
    left = one.select(*ROW_KEY, F.col("decision").alias("_a"), F.col("prediction").alias("_pa"))
    right = other.select(*ROW_KEY, F.col("decision").alias("_b"), F.col("prediction").alias("_pb"))
    gap = F.abs(F.col("_a") - F.col("_b"))
    report = left.join(right, ROW_KEY).agg(
        F.count("*").alias("rows"), F.max(gap).alias("max_difference"),
        F.avg(gap).alias("mean_difference"),
        F.count_if(F.col("_pa").eqNullSafe(F.col("_pb"))).alias("matching_predictions"))
    mismatching = F.col("rows") - F.col("matching_predictions")
    # A pair that is scored by one scorer only shows in its predictions.
    return report.withColumn("mismatching_predictions", mismatching).withColumn(
        "verdict", F.when(mismatching > 0, "REVIEW")
        .when(F.coalesce("max_difference", F.lit(0.0)) < 1e-10, "STRICT")
        .when(F.col("max_difference") < 1e-6, "TOLERANCE").otherwise("REVIEW"))

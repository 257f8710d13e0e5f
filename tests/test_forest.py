from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.operators import anomaly, forest
from meterflow.operators.skew import exact_percentile, global_rank
from meterflow.plans.demo_model import DEMO_MODEL

FEATURES = ["event_count_15m", "avg_voltage_15m", "voltage_range_15m", "power_failure_count_15m"]


@pytest.fixture(scope="module")
def windows(spark):
    rng = np.random.default_rng(5)
    rows = [(f"m{i}", i, int(rng.integers(1, 5)), float(230 + rng.normal()), float(abs(rng.normal())), 0)
            for i in range(1500)]
    rows += [(f"odd{i}", i, 40, 120.0 + i, 90.0 + i, 0) for i in range(5)]
    rows += [("gap", 1, 1, None, None, 0)]
    return spark.createDataFrame(
        rows, "msn string, window_start bigint, event_count_15m bigint, avg_voltage_15m double, "
        "voltage_range_15m double, power_failure_count_15m bigint").cache()


@pytest.fixture(scope="module")
def model(windows):
    return forest.train(windows, n_trees=60)


def test_training(spark, windows, model):
    assert model.features == FEATURES[:3] and model.excluded_constant_features == FEATURES[3:]
    assert (model.n_estimators, model.max_samples) == (60, 256)
    for tree in model.trees:
        leaves = [i for i, f in enumerate(tree["feature"]) if f == forest.LEAF]
        assert len(leaves) == (len(tree["feature"]) + 1) // 2
        assert max(tree["decision_path_lengths"]) <= math.ceil(math.log2(256)) + 1
    scored = forest.score_rows(windows, model)
    counts = forest.anomaly_count(scored).first()
    assert abs(counts["anomalies"] / 1505 - 0.10) < 0.005
    top = [r["msn"] for r in forest.top_anomalies(scored, 5).collect()]
    assert all(name.startswith("odd") for name in top)


def test_training_is_repeatable_whatever_the_layout(windows, model):
    again = forest.train(windows.repartition(7), n_trees=60)
    assert again.trees == model.trees and again.offset == model.offset
    assert forest.train(windows, n_trees=60, seed=1).trees != model.trees


def test_every_tree_draws_from_all_rows(windows):
    samples, size = forest.draw_samples(windows, FEATURES[:3], 30, 200)
    drawn = samples.select("tree_index", "slot", "msn").collect()
    assert size == 200 and len({(r["tree_index"], r["slot"]) for r in drawn}) == len(drawn) == 30 * 200
    # 6,000 draws of 1,505 rows: a shared pool of 200 rows would show here.
    assert len({r["slot"] for r in drawn}) > 1300 and max(r["slot"] for r in drawn) <= 1505
    few, size = forest.draw_samples(windows.limit(9), FEATURES[:3], 4, 200)
    assert size == few.where("tree_index = 0").count() <= 9


def test_parity_reports_mismatches(spark):
    rows = spark.createDataFrame(
        [("a", 1, 0.1, 1), ("b", 1, None, None)], "msn string, window_start int, decision double, prediction int")
    same = forest.parity(rows, rows).first()
    assert same["verdict"] == "STRICT" and same["mismatching_predictions"] == 0
    other = rows.withColumn("prediction", F.when(F.col("msn") == "b", 1).otherwise(F.col("prediction")))
    assert forest.parity(rows, other).first()["verdict"] == "REVIEW"


@pytest.mark.parametrize("which", ["trained", "demo"])
def test_scorers_agree(windows, model, which):
    chosen = model if which == "trained" else DEMO_MODEL
    report = forest.parity(
        forest.score_rows(windows, chosen),
        forest.score_rows(windows, chosen, forest.decision_sql)).first()
    assert report["verdict"] == "STRICT" and report["matching_predictions"] == report["rows"] == 1506


def test_hand_worked_score(spark):
    row = spark.createDataFrame(
        [("a", 1, 1, 231.0, 5.0, 0)],
        "msn string, window_start bigint, event_count_15m bigint, avg_voltage_15m double, "
        "voltage_range_15m double, power_failure_count_15m bigint")
    total = (2 + 9.5 - 1) + (3 + 7.5 - 1) + (2 + 8.5 - 1)
    want = -2 ** (-total / (3 * DEMO_MODEL.normalization_c)) - DEMO_MODEL.offset
    for scorer in (forest.decision, forest.decision_sql):
        assert abs(forest.score_rows(row, DEMO_MODEL, scorer).first()["decision"] - want) < 1e-12


def test_values_compare_as_32_bit_floats(spark):
    # 231.5 + 1e-9 is above the threshold as a double, equal to it as a float: goes left.
    row = spark.createDataFrame(
        [("a", 1, 1, v, 5.0, 0) for v in (231.5, 231.5 + 1e-9)],
        "msn string, window_start bigint, event_count_15m bigint, avg_voltage_15m double, "
        "voltage_range_15m double, power_failure_count_15m bigint")
    for scorer in (forest.decision, forest.decision_sql):
        assert forest.score_rows(row, DEMO_MODEL, scorer).select("decision").distinct().count() == 1


def test_zero_decision_is_normal(spark):
    rows = spark.createDataFrame([(0.0,), (-1e-9,), (None,)], "d double")
    assert [r[0] for r in rows.select(forest.label(F.col("d"))).collect()] == [
        "NORMAL", "ANOMALY", None]


def test_verdicts(windows, model):
    rows = {r["msn"]: r for r in anomaly.anomaly_results(
        windows.withColumn("window_end", F.lit(0)), model).collect()}
    assert rows["gap"]["prediction"] == "UNSCORABLE" and rows["gap"]["severity"] == "UNKNOWN"
    assert rows["gap"]["anomaly_score"] is None
    assert rows["odd0"]["prediction"] == "ANOMALY" and rows["odd0"]["severity"] == "WARNING"
    assert rows["odd0"]["confidence"] is None and rows["odd0"]["anomaly_score"] > 0


def test_model_round_trip(spark, model, tmp_path):
    path = str(tmp_path / "model")
    forest.save_model(spark, model, path)
    assert forest.load_model(spark, path) == model


def test_profile(windows):
    rows = {r["feature"]: r for r in forest.feature_profile(windows).collect()}
    assert rows["avg_voltage_15m"]["missing"] == 1 and rows["avg_voltage_15m"]["varies"]
    assert not rows["power_failure_count_15m"]["varies"] and rows["event_count_15m"]["meters"] == 1506


def test_global_rank_with_one_dominating_value(spark):
    rng = random.Random(3)
    rows = spark.createDataFrame(
        [(i, 0.5 if i % 3 else rng.random()) for i in range(3000)], "id bigint, score double")
    ranked = global_rank(rows, [F.col("score").desc(), F.col("id").asc()], "rank")
    got = [r["id"] for r in ranked.orderBy("rank").collect()]
    assert got == [r["id"] for r in rows.orderBy(F.col("score").desc(), "id").collect()]
    assert [r["rank"] for r in ranked.orderBy("rank").collect()] == list(range(1, 3001))


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.99, 1.0])
def test_exact_percentile(spark, fraction):
    rng = random.Random(4)
    values = [("g", rng.choice([5.0, rng.uniform(-50, 50)])) for _ in range(801)] + [("h", 1.5)]
    rows = spark.createDataFrame(values, "g string, v double")
    got = {r["g"]: r["percentile"] for r in
           exact_percentile(rows, ["g"], "v", fraction, bin_width=0.5).collect()}
    want = np.percentile([v for g, v in values if g == "g"], fraction * 100)
    assert abs(got["g"] - want) < 1e-9 and got["h"] == 1.5


@pytest.mark.parametrize("cell_rows", [4096, 1])
def test_draws_are_ranks_by_hash(spark, windows, monkeypatch, cell_rows):
    """The same rows as numbering all of them by hash and key; repeated rows each have a number."""
    monkeypatch.setattr(forest, "CELL_BITS", 3)
    rows = windows.union(windows.limit(40)).union(windows.limit(40))
    samples, size = forest.draw_samples(rows, FEATURES[:3], 30, 64, cell_rows=cell_rows)
    names = [*forest.ROW_KEY, *FEATURES[:3]]
    ordered = sorted(
        rows.na.drop(subset=FEATURES[:3]).select(F.xxhash64(F.lit(forest.SEED), *forest.ROW_KEY), *names).collect())
    got = samples.collect()
    assert size == 64 and len(got) == 30 * 64
    assert len({(r.tree_index, r.slot) for r in got}) == len(got)
    assert all(tuple(r[name] for name in names) == tuple(ordered[r.slot])[1:] for r in got)


def test_draws_shuffle_no_whole_rows(spark, windows):
    """Rows reach an exchange only after the join with the drawn cells; nothing is range sorted."""
    samples, _ = forest.draw_samples(windows, FEATURES[:3], 2, 16)
    plan = samples._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan
    # Read from the bottom: rows, the join with the drawn cells, only then the aggregate that shuffles.
    assert plan.index("Aggregate") < plan.index("Join Inner", plan.index("Aggregate"))

"""The SQL scorer on flat node arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.operators import forest


def test_sql_scorer_looks_at_no_tree(spark):
    """Walking nested trees, with the row's values built at every step, cost five times as much."""
    chain = {  # four leaves down one side, one on the other
        "tree_index": 0, "feature_indices": [1, 0], "children_left": [1, 2, 3, -1, -1, -1, -1],
        "children_right": [6, 5, 4, -1, -1, -1, -1], "feature": [0, 1, 0, -2, -2, -2, -2],
        "threshold": [5.0, 3.0, 1.0, -2.0, -2.0, -2.0, -2.0],
        "decision_path_lengths": [1.0, 2.0, 3.0, 4.0, 4.0, 3.0, 2.0],
        "average_path_lengths": [0.0, 0.0, 0.0, 1.5, 0.25, 0.0, 2.0]}
    stump = {
        "tree_index": 1, "feature_indices": [0, 1], "children_left": [-1], "children_right": [-1], "feature": [-2],
        "threshold": [-2.0], "decision_path_lengths": [1.0], "average_path_lengths": [0.5]}
    model = forest.ForestModel(["a", "b"], [chain, stump, chain], -0.5, 2.0, 8)
    rows = spark.range(100).select(
        F.expr("cast(nullif(id % 10, 9) as double)").alias("a"), F.expr("cast(id div 10 as double)").alias("b"))
    scored = rows.select(forest.decision(model).alias("x"), forest.decision_sql(model).alias("y"))
    assert all(r["x"] == r["y"] or abs(r["x"] - r["y"]) < 1e-15 for r in scored.collect())
    assert scored.where("x is null").count() == 10
    plan = rows.select(forest.decision_sql(model))._jdf.queryExecution().optimizedPlan().toString()
    assert "children_left" not in plan

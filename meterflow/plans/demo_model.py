"""A three-tree forest small enough to state as SQL, for the scoring queries."""

from __future__ import annotations

from meterflow.functions import path_normaliser
from meterflow.operators.forest import LEAF, ForestModel

_FEATURES = ["event_count_15m", "avg_voltage_15m", "voltage_range_15m"]


def _tree(index, order, left, right, feature, threshold, steps, average):
    return {
        "tree_index": index, "feature_indices": order, "children_left": left,
        "children_right": right, "feature": feature, "threshold": threshold,
        "decision_path_lengths": steps, "average_path_lengths": average}


DEMO_MODEL = ForestModel(
    features=_FEATURES,
    excluded_constant_features=["power_failure_count_15m"],
    offset=-0.52, normalization_c=path_normaliser(256), max_samples=256, contamination=0.1,
    trees=[
        _tree(0, [0, 1, 2], [1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [1, LEAF, 0, LEAF, LEAF],
              [231.5, -2.0, 1.5, -2.0, -2.0], [1.0, 2.0, 2.0, 3.0, 3.0], [0.0, 9.5, 0.0, 8.0, 4.0]),
        _tree(1, [0, 1, 2], [1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [2, LEAF, 1, LEAF, LEAF],
              [4.25, -2.0, 230.75, -2.0, -2.0], [1.0, 2.0, 2.0, 3.0, 3.0], [0.0, 9.0, 0.0, 2.5, 7.5]),
        _tree(2, [2, 0, 1], [1, -1, -1], [2, -1, -1], [0, LEAF, LEAF], [9.5, -2.0, -2.0],
              [1.0, 2.0, 2.0], [0.0, 8.5, 3.0]),
    ])

# The trees above over the feature table, path length = steps + average - 1 at the leaf.
DEMO_TOTAL_SQL = """
  (case when avg_voltage_15m::float::double <= 231.5 then 2.0 + 9.5 - 1.0
        when event_count_15m::float::double <= 1.5 then 3.0 + 8.0 - 1.0 else 3.0 + 4.0 - 1.0 end
   + case when voltage_range_15m::float::double <= 4.25 then 2.0 + 9.0 - 1.0
        when avg_voltage_15m::float::double <= 230.75 then 3.0 + 2.5 - 1.0
        else 3.0 + 7.5 - 1.0 end
   + case when voltage_range_15m::float::double <= 9.5 then 2.0 + 8.5 - 1.0
        else 2.0 + 3.0 - 1.0 end)::double"""

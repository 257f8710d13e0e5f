"""Column lists of every stored entity, as DDL strings ``spark.read.schema`` accepts."""

from __future__ import annotations

RAW_EVENT = (
    "msn string, msn_id bigint, evnt_id int, ts string, log_seq_no bigint, "
    "v_r double, v_y double, v_b double, dt string, replayed_at string, "
    "latitude double, longitude double"
)

EVENT_CATALOGUE = (
    "event_id int, event_tblrefid int, event_name string, event_description string, "
    "amr_event_id int, amr_eventstatus int, event_state string, isrestoration boolean, "
    "prioritytblrefid int, priorityname string, eventclassification_tblrefid int, "
    "eventclassification_name string, phase string, dlmsevents_tblrefid int"
)

NETWORK_HIERARCHY = (
    "substation_name string, feeder_name string, dtr_name string, dtr_network_code string, "
    "msn string, msn_normalized string"
)

PROCESSED_EVENT = (
    "msn string, msn_id bigint, evnt_id int, event_ts string, log_seq_no bigint, "
    "v_r double, v_y double, v_b double, validation_status string, validation_reason string, "
    "event_catalogue_match boolean, event_tblrefid int, event_name string, event_state string, "
    "isrestoration boolean, priorityname string, eventclassification_name string, "
    "hierarchy_match boolean, msn_normalized string, dtr_name string, dtr_network_code string, "
    "feeder_name string, substation_name string"
)

# The older, narrow form of the processed table.
PROCESSED_EVENT_NARROW = (
    "msn string, msn_id bigint, evnt_id int, event_ts string, log_seq_no bigint, "
    "v_r double, v_y double, v_b double, validation_status string, validation_reason string"
)

METER_FEATURES = (
    "msn string, window_start timestamp, window_end timestamp, event_count_15m bigint, "
    "avg_voltage_15m double, voltage_range_15m double, power_failure_count_15m bigint"
)

OUTAGE_INCIDENT = (
    "incident_id string, msn string, event_name string, event_tblrefid int, "
    "incident_status string, start_ts string, end_ts string, duration_minutes double, "
    "dtr_name string, dtr_network_code string, feeder_name string, substation_name string"
)

TOPOLOGY_RESULT = (
    "inference_id string, use_case string, unknown_msn string, event_ts string, "
    "candidate_rank int, candidate_feeder string, candidate_substation string, "
    "supporting_meter_count bigint, cooccurrence_score double, distance_km double, "
    "proximity_score double, topology_score double, prediction string, confidence double, "
    "severity string, reason string, recommendation string, generated_at string"
)

ANOMALY_RESULT = (
    "msn string, window_start timestamp, window_end timestamp, event_count_15m bigint, "
    "avg_voltage_15m double, voltage_range_15m double, power_failure_count_15m bigint, "
    "use_case string, model_type string, sklearn_version string, model_contamination double, "
    "prediction string, confidence double, anomaly_score double, severity string, "
    "reason string, recommendation string"
)

# Raw messages that are no JSON objects.
QUARANTINED = "seq bigint, payload string, reject_reason string"

TRAINING_FEATURES = (
    "msn string, window_start timestamp, event_count_15m bigint, avg_voltage_15m double, "
    "voltage_range_15m double, power_failure_count_15m bigint"
)

TREE = (
    "tree_index int, feature_indices array<int>, children_left array<int>, "
    "children_right array<int>, feature array<int>, threshold array<double>, "
    "decision_path_lengths array<double>, average_path_lengths array<double>"
)

MODEL = (
    "model_type string, sklearn_version string, features array<string>, "
    "excluded_constant_features array<string>, contamination double, n_estimators int, "
    "max_samples int, offset double, normalization_c double, "
    "trees array<struct<tree_index: int, feature_indices: array<int>, "
    "children_left: array<int>, children_right: array<int>, feature: array<int>, "
    "threshold: array<double>, decision_path_lengths: array<double>, "
    "average_path_lengths: array<double>>>"
)


def column_names(ddl: str) -> list[str]:
    """Names of a flat DDL string, in order."""
    return [part.split()[0] for part in ddl.split(", ")]


# Per result table: schema, arrival-stamp column and stored sort key.
RESULT_TABLES = {
    "processed_events": (PROCESSED_EVENT, "processed_at", ["processed_at"]),
    "quarantined_messages": (QUARANTINED, "received_at", ["received_at"]),
    "meter_features_15m": (METER_FEATURES, "ingested_at", ["msn", "window_start"]),
    "outage_incident_events": (OUTAGE_INCIDENT, "received_at", ["incident_id", "received_at"]),
    "topology_inference_results": (
        TOPOLOGY_RESULT, "received_at",
        ["unknown_msn", "event_ts", "candidate_rank", "received_at"]),
    "anomaly_detection_results": (
        ANOMALY_RESULT, "received_at", ["msn", "window_start", "received_at"]),
}

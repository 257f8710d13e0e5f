"""Every operator as a named query over the driver's tables.

Doubles that come out of sums are rounded to six digits so that they compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from meterflow.functions import haversine_km, linear_decay, micros_text, seconds_text
from meterflow.operators import (
    anomaly, enrich, features, forest, outage, parse, project, reliability, replay, topology,
)
from meterflow.operators.skew import materialise
from meterflow.plans import batch, derive
from meterflow.plans.demo_model import DEMO_MODEL
from meterflow.schemas import (
    ANOMALY_RESULT, METER_FEATURES, NETWORK_HIERARCHY, PROCESSED_EVENT_NARROW, TRAINING_FEATURES,
    column_names,
)
from meterflow.session import scratch_path
from meterflow.sinks.tables import append_table, read_table, write_scored_csv
from meterflow.sources import lookups, messages
from meterflow.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

PARSED = ["seq", "msn", "msn_id", "evnt_id", "ts", "log_seq_no", "v_r", "v_y", "v_b",
          "v_r_num", "v_y_num", "v_b_num", "dt", "latitude", "longitude", "event_us"]
SQL_PARSED = ["seq", "msn", "msn_id", "evnt_id", "event_ts", "log_seq_no", "v_r", "v_y", "v_b"]


def rounded(rows: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return rows.withColumns({name: F.round(name, digits) for name in names})


def timed_text(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns(
        {name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in names})


# ---- parse and validate ----------------------------------------------------------------------

def parse_events(spark, sf_dir):
    return parse.parse_events(derive.raw_messages(spark, sf_dir)).select(*PARSED)


def parse_events_sql(spark, sf_dir):
    return parse.parse_events_sql(derive.raw_messages(spark, sf_dir)).select(*SQL_PARSED)


def quarantine_events(spark, sf_dir):
    return parse.quarantine(derive.raw_messages(spark, sf_dir)).select("seq", "reject_reason")


def validated(spark, sf_dir):
    return parse.validate(parse.parse_events(derive.raw_messages(spark, sf_dir)))


def validated_sql(spark, sf_dir):
    return parse.validate_sql(parse.parse_events_sql(derive.raw_messages(spark, sf_dir)))


def validate_events(spark, sf_dir):
    return validated(spark, sf_dir).select("seq", "msn", "validation_status", "validation_reason")


def validate_events_sqlcodes(spark, sf_dir):
    return validated_sql(spark, sf_dir).select(
        "seq", "msn", "validation_status", "validation_reason")


# ---- enrichment and projections --------------------------------------------------------------

def enrich_catalogue(spark, sf_dir):
    lookup = enrich.catalogue_lookup(derive.event_catalogue(spark))
    return enrich.join_catalogue(validated(spark, sf_dir), lookup).select(
        "seq", "evnt_id", "event_catalogue_match", *enrich.CATALOGUE_COLUMNS)


def enrich_hierarchy(spark, sf_dir):
    lookup = enrich.hierarchy_lookup(derive.network_hierarchy(spark, sf_dir))
    return enrich.join_hierarchy(validated(spark, sf_dir), lookup).select(
        "seq", "msn", "hierarchy_match", "msn_normalized", *enrich.HIERARCHY_COLUMNS)


def hierarchy_lookup(spark, sf_dir):
    return enrich.hierarchy_lookup(derive.network_hierarchy(spark, sf_dir))


def enriched_events(spark, sf_dir):
    return batch.derived_enriched(spark, sf_dir).select(
        "seq", "msn", "evnt_id", "ts", "latitude", "longitude", "event_catalogue_match",
        *enrich.CATALOGUE_COLUMNS, "hierarchy_match", "msn_normalized",
        *enrich.HIERARCHY_COLUMNS, "validation_status")


def enriched_sql_variant(spark, sf_dir):
    hierarchy = derive.network_hierarchy(spark, sf_dir).withColumn(
        "msn_normalized", F.upper(F.trim("msn_normalized")))
    joined = enrich.enrich_sql(
        validated_sql(spark, sf_dir), derive.event_catalogue(spark), hierarchy)
    return project.enriched_events_sql(joined)


def enriched_service_variant(spark, sf_dir):
    joined = enrich.enrich_service(
        validated(spark, sf_dir), derive.event_catalogue(spark),
        derive.network_hierarchy(spark, sf_dir))
    return joined.select(
        "seq", *[c for c in column_names(PROCESSED_EVENT_NARROW) if c != "event_ts"],
        *enrich.SQL_CATALOGUE_COLUMNS, *enrich.HIERARCHY_COLUMNS)


def processed_events(spark, sf_dir):
    return project.processed_events(batch.derived_enriched(spark, sf_dir))


def processed_events_narrow(spark, sf_dir):
    return project.processed_events_narrow(validated(spark, sf_dir))


def processed_json(spark, sf_dir):
    """Round trip through the JSON record form: written as text, read back by schema."""
    narrow = project.processed_events_narrow(validated(spark, sf_dir))
    return project.as_json(narrow).select(
        F.from_json("value", PROCESSED_EVENT_NARROW).alias("r")).select("r.*")


def _record_columns(rows, ddl):
    """Written as JSON records and read back, times staying text as other readers see them."""
    return project.as_json(rows).select(
        F.from_json("value", ddl.replace(" timestamp", " string")).alias("r")).select("r.*")


def features_json(spark, sf_dir):
    return rounded(_record_columns(meter_features(spark, sf_dir), METER_FEATURES),
                   "avg_voltage_15m", "voltage_range_15m", digits=7)


def anomalies_json(spark, sf_dir):
    results = anomaly.anomaly_results(meter_features(spark, sf_dir), DEMO_MODEL)
    return rounded(rounded(_record_columns(results, ANOMALY_RESULT),
                           "avg_voltage_15m", "voltage_range_15m", digits=7),
                   "anomaly_score", digits=9)


# ---- files: derived tables written in their file forms and read back ---------------------------

def catalogue_csv(spark, sf_dir):
    """The catalogue as CSV with header and padded cells, joined to the events."""
    path = scratch_path(spark, "catalogue")
    rows = derive.event_catalogue(spark).orderBy("ordinal").drop("ordinal")
    padded = rows.select(*[F.concat(F.lit(" "), F.col(c).cast("string"), F.lit(" ")).alias(c)
                           for c in rows.columns])
    padded.coalesce(1).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    lookup = enrich.catalogue_lookup(lookups.event_catalogue(spark, path))
    return enrich.join_catalogue(validated(spark, sf_dir), lookup).select(
        "seq", "evnt_id", "event_catalogue_match", *enrich.CATALOGUE_COLUMNS)


def _hierarchy_file(spark, sf_dir, header):
    path = scratch_path(spark, "hierarchy")
    rows = derive.network_hierarchy(spark, sf_dir)
    columns = column_names(NETWORK_HIERARCHY)
    # Files are read in the order of their names, which follow the ranges.
    rows.repartitionByRange("ordinal").sortWithinPartitions("ordinal").select(*columns).write.option(
        "header", header).csv(path)
    return lookups.network_hierarchy(spark, path, header)


def hierarchy_csv(spark, sf_dir):
    """The hierarchy as CSV with header; of duplicate meters the last row wins."""
    return enrich.hierarchy_lookup(_hierarchy_file(spark, sf_dir, True))


def hierarchy_csv_positional(spark, sf_dir):
    return enrich.hierarchy_lookup(_hierarchy_file(spark, sf_dir, False))


def events_jsonl(spark, sf_dir):
    """Messages as JSON lines with blank lines between, parsed from the file."""
    path = scratch_path(spark, "jsonl")
    derive.raw_messages(spark, sf_dir).select(
        F.explode(F.array("payload", F.lit("  "))).alias("value")).write.text(path)
    return parse.parse_events(messages.jsonl_messages(spark, path)).select(
        *[name for name in PARSED if name != "seq"])


def training_csv(spark, sf_dir):
    """Feature windows exported as CSV and read as training rows."""
    path = scratch_path(spark, "training")
    timed_text(meter_features(spark, sf_dir), "window_start").select(
        *column_names(TRAINING_FEATURES)).write.option("header", True).csv(path)
    rows = messages.training_features(spark, path)
    return rounded(timed_text(rows, "window_start"), "avg_voltage_15m", "voltage_range_15m", digits=7)


def scored_csv(spark, sf_dir):
    """Scored windows written as CSV, most anomalous first, and read back."""
    path = scratch_path(spark, "scored")
    scored = timed_text(_scored(spark, sf_dir), "window_start").select(*SCORES)
    write_scored_csv(scored.orderBy(*forest.most_anomalous_first()), path)
    ddl = ("msn string, window_start string, event_count_15m bigint, decision double, "
           "anomaly_score double, prediction int, anomaly_label string")
    rows = spark.read.schema(ddl).option("header", True).csv(path)
    return rounded(rows, "decision", "anomaly_score", digits=9)


def model_file_scores(spark, sf_dir):
    """The model written as a JSON document, loaded again and applied."""
    path = scratch_path(spark, "model")
    forest.save_model(spark, DEMO_MODEL, path)
    model = forest.load_model(spark, path)
    return _score_columns(forest.score_rows(meter_features(spark, sf_dir), model))


def arrival_stamps(spark, sf_dir):
    """Arrival times of a stored table lie between the start of the write and now."""
    root = scratch_path(spark, "stamped")
    append_table(meter_features(spark, sf_dir), "meter_features_15m", root)
    stamp = F.col("ingested_at")
    return read_table(spark, "meter_features_15m", root).agg(
        F.count("*").alias("rows"), F.count_if(
            stamp.isNotNull() & (stamp <= F.current_timestamp())
            & (stamp > F.current_timestamp() - F.expr("interval 1 hour"))).alias("stamped"))


# ---- features --------------------------------------------------------------------------------

def feature_eligible(spark, sf_dir):
    return features.eligible(validated(spark, sf_dir)).select("seq", "msn", "event_us")


def meter_features(spark, sf_dir):
    return features.meter_features(batch.derived_enriched(spark, sf_dir))


def meter_features_15m(spark, sf_dir):
    return rounded(timed_text(meter_features(spark, sf_dir), "window_start", "window_end"),
                   "avg_voltage_15m", "voltage_range_15m", digits=7)


# ---- outages ---------------------------------------------------------------------------------

def outage_pairs(spark, sf_dir, **options):
    return outage.pair_incidents(
        outage.outage_rows(batch.derived_enriched(spark, sf_dir)), **options)


def outage_events(spark, sf_dir):
    rows = outage.outage_rows(batch.derived_enriched(spark, sf_dir))
    return rows.select("msn", "event_tblrefid", "seq", "occurs", "event_us")


def outage_previous_state(spark, sf_dir, **options):
    """Occurrence or restoration next to the preceding one of the same meter."""
    rows = outage.outage_rows(batch.derived_enriched(spark, sf_dir))
    return outage.previous_states(rows, **options).select(
        "msn", "event_tblrefid", "seq", "occurs", "previous_occurs")


def outage_previous_state_chunked(spark, sf_dir):
    """The same with chunks so small that most meters span several."""
    return outage_previous_state(spark, sf_dir, chunk_rows=500)


def outage_incidents(spark, sf_dir):
    return rounded(outage.incident_log(outage_pairs(spark, sf_dir), None), "duration_minutes")


def outage_incidents_chunked(spark, sf_dir):
    """The same pairing with chunks so small that most outages span several."""
    log = outage.incident_log(outage_pairs(spark, sf_dir, chunk_rows=500), None)
    return rounded(log, "duration_minutes")


def outage_unresolved_event_time(spark, sf_dir):
    log = outage.incident_log(outage_pairs(spark, sf_dir), "event")
    return rounded(log, "duration_minutes").where(F.col("incident_status") == "UNRESOLVED")


def outage_service_variant(spark, sf_dir):
    return outage.service_incidents(batch.derived_enriched(spark, sf_dir))


def outage_rejects(spark, sf_dir):
    return outage.service_rejects(batch.derived_enriched(spark, sf_dir)).select(
        "seq", "event_state", "reject_reason")


# ---- reliability -----------------------------------------------------------------------------

def incident_log(spark, sf_dir):
    """The incident table of the reports that read it once."""
    return outage.outage_incidents(batch.derived_enriched(spark, sf_dir))


def incident_latest(spark, sf_dir):
    return rounded(reliability.latest_per_incident(incident_log(spark, sf_dir)), "duration_minutes")


def active_incidents(spark, sf_dir):
    return reliability.active_incidents(materialise(incident_log(spark, sf_dir))).select(
        "incident_id", "msn", "start_ts", "feeder_name", "substation_name")


def outage_frequency(spark, sf_dir):
    return reliability.outage_frequency(incident_log(spark, sf_dir))


def restoration_activity(spark, sf_dir):
    return rounded(reliability.restoration_activity(incident_log(spark, sf_dir)), "share_closed")


def outage_duration(spark, sf_dir):
    return rounded(reliability.outage_duration(materialise(incident_log(spark, sf_dir))),
                   "max_minutes", "median_minutes")


def reliability_rollup(spark, sf_dir):
    return reliability.network_rollup(incident_log(spark, sf_dir))


# ---- topology --------------------------------------------------------------------------------

def _occurrences(spark, sf_dir):
    return topology.outage_occurrences(batch.derived_enriched(spark, sf_dir))


def topology_evidence(spark, sf_dir):
    occurred = _occurrences(spark, sf_dir)
    known = topology.known_evidence(occurred).select("seq", "msn", F.lit("known").alias("side"))
    unknown = topology.unknown_outages(occurred).select(
        "seq", "msn", F.lit("unknown").alias("side"))
    return known.unionByName(unknown)


def topology_candidates(spark, sf_dir):
    ranked = topology.candidates(_occurrences(spark, sf_dir))
    return rounded(
        ranked.select("seq", "msn", "feeder_name", "substation_name", "n", "first_seq",
                      "centroid_lat", "centroid_lon", "distance", "cooccurrence", "proximity",
                      "score", "candidate_rank"),
        "centroid_lat", "centroid_lon", "distance", "cooccurrence", "proximity", "score")


def topology_top3(spark, sf_dir):
    return topology.topology_results(_occurrences(spark, sf_dir)).drop("generated_at")


def haversine_distance(spark, sf_dir):
    """Distance of every event to the network centre and its proximity."""
    events = parse.parse_events(derive.raw_messages(spark, sf_dir))
    km = haversine_km(F.col("latitude"), F.col("longitude"), F.lit(28.2), F.lit(77.2))
    return rounded(
        events.select("seq", km.alias("km"), linear_decay(km, 20.0).alias("proximity")),
        "km", "proximity")


# ---- replay ----------------------------------------------------------------------------------

def replay_order(spark, sf_dir):
    ordered = replay.replay_order(parse.parse_events(derive.raw_messages(spark, sf_dir)))
    return ordered.select("seq", "dt", "replay_us")


# ---- anomalies -------------------------------------------------------------------------------

SCORES = ["msn", "window_start", "event_count_15m", "decision", "anomaly_score", "prediction",
          "anomaly_label"]


def _scored(spark, sf_dir, scorer=forest.decision):
    return forest.score_rows(meter_features(spark, sf_dir), DEMO_MODEL, scorer)


def _score_columns(rows, *more):
    return rounded(timed_text(rows, "window_start").select(*SCORES, *more),
                   "decision", "anomaly_score", digits=9)


def anomaly_scores_pandas(spark, sf_dir):
    return _score_columns(_scored(spark, sf_dir))


def anomaly_scores_hof(spark, sf_dir):
    return _score_columns(_scored(spark, sf_dir, forest.decision_sql))


def anomaly_results(spark, sf_dir):
    results = anomaly.anomaly_results(meter_features(spark, sf_dir), DEMO_MODEL)
    return rounded(
        rounded(timed_text(results, "window_start", "window_end"),
                "avg_voltage_15m", "voltage_range_15m", digits=7), "anomaly_score", digits=9)


def anomaly_rank(spark, sf_dir):
    return _score_columns(forest.ranked(_scored(spark, sf_dir)), "anomaly_rank")


def anomaly_top10(spark, sf_dir):
    return _score_columns(forest.top_anomalies(_scored(spark, sf_dir)))


def lowest_decisions(spark, sf_dir):
    return _score_columns(forest.lowest_decisions(_scored(spark, sf_dir)))


def anomaly_count(spark, sf_dir):
    return forest.anomaly_count(_scored(spark, sf_dir))


def feature_profile(spark, sf_dir):
    stable = rounded(meter_features(spark, sf_dir), "avg_voltage_15m", "voltage_range_15m",
                     digits=7)
    return forest.feature_profile(stable)


def score_quantile(spark, sf_dir):
    """The score below which a tenth of the windows lies."""
    scored = _scored(spark, sf_dir).where(F.col("decision").isNotNull())
    return rounded(forest.exact_percentile(
        scored, [], "decision", forest.CONTAMINATION, 1e-4, "quantile"), "quantile", digits=9)


def _parity(rows, model, pandas_scored):
    """The pandas scorer against the SQL scorer on every window; differences in whole 1e-10."""
    report = forest.parity(pandas_scored, forest.judged(forest.decisions_by_trees(rows, model)))
    return report.select(
        "rows", "matching_predictions", "mismatching_predictions", "verdict",
        F.round("max_difference", 10).alias("max_difference"),
        F.round("mean_difference", 10).alias("mean_difference"))


def scorer_parity(spark, sf_dir):
    rows = materialise(meter_features(spark, sf_dir))
    return _parity(rows, DEMO_MODEL, forest.score_rows(rows, DEMO_MODEL))


def scorer_parity_trained(spark, sf_dir):
    """The same for a model of 200 trees trained on all windows."""
    rows = materialise(meter_features(spark, sf_dir))
    model, scored = forest.train_and_score(rows)
    return _parity(rows, model, scored)


def iforest_train_summary(spark, sf_dir):
    """Train on all windows with the default settings, score them, and summarise."""
    rows = materialise(meter_features(spark, sf_dir))
    model, scored = forest.train_and_score(rows)
    return forest.anomaly_count(scored).select(
        F.lit(model.n_estimators).alias("trees"), F.lit(model.max_samples).alias("max_samples"),
        F.lit(",".join(model.features)).alias("features"), "rows",
        F.round(F.col("anomalies") / F.col("rows"), 1).alias("flagged_share"))


# ---- streams, drained into result tables -----------------------------------------------------

# Files, each a micro-batch, that the stream queries with state across batches read.
STREAM_FILES = 3


def _drained(spark, sf_dir, start, table, folder=None, parts=None, finish=None):
    """Run a job over the events as a stream until nothing is left, and read its table."""
    root = scratch_path(spark, table)
    target = jobs.Target(f"{root}/tables", f"{root}/checkpoints", available_now=True)
    start(batch.derived_enriched_stream(spark, sf_dir, parts), target).awaitTermination()
    if finish is not None:
        finish(spark, target)
    return read_table(spark, table, target.root, folder)


def _stream_anomalies(enriched, target):
    return jobs.start_features_and_anomalies(enriched, DEMO_MODEL, target)


def stream_enriched(spark, sf_dir):
    """Enriched events landed for the use cases."""
    root = scratch_path(spark, "enriched")
    target = jobs.Target(f"{root}/tables", f"{root}/checkpoints", available_now=True)
    jobs.start_enriched(batch.derived_enriched_stream(spark, sf_dir), target).awaitTermination()
    return spark.read.parquet(f"{target.root}/{jobs.ENRICHED}").select(
        "seq", "msn", "evnt_id", "ts", "latitude", "longitude", "event_catalogue_match",
        *enrich.CATALOGUE_COLUMNS, "hierarchy_match", "msn_normalized",
        *enrich.HIERARCHY_COLUMNS, "validation_status")


def stream_quarantine(spark, sf_dir):
    """Broken messages of the stream."""
    root = scratch_path(spark, "quarantine")
    target = jobs.Target(f"{root}/tables", f"{root}/checkpoints", available_now=True)
    jobs.start_quarantine(derive.raw_message_stream(spark, sf_dir), target).awaitTermination()
    return read_table(spark, "quarantined_messages", target.root).select("seq", "reject_reason")


def stream_processed_events(spark, sf_dir):
    rows = _drained(spark, sf_dir, jobs.start_processed, "processed_events")
    return rows.drop("processed_at")


def stream_meter_features(spark, sf_dir):
    rows = _drained(spark, sf_dir, jobs.start_features, "meter_features_15m")
    return rounded(timed_text(rows, "window_start", "window_end").drop("ingested_at"),
                   "avg_voltage_15m", "voltage_range_15m", digits=7)


def stream_anomalies(spark, sf_dir):
    rows = _drained(spark, sf_dir, _stream_anomalies, "anomaly_detection_results")
    return rounded(
        rounded(timed_text(rows, "window_start", "window_end").drop("received_at"),
                "avg_voltage_15m", "voltage_range_15m", digits=7), "anomaly_score", digits=9)


def _stream_incidents(spark, sf_dir):
    return _drained(spark, sf_dir, jobs.start_outages, "outage_incident_events",
                    parts=STREAM_FILES, finish=jobs.finish_outages)


def stream_outages(spark, sf_dir):
    """OPEN and CLOSED records of the stream."""
    rows = _stream_incidents(spark, sf_dir).where("incident_status <> 'UNRESOLVED'")
    return rounded(rows.drop("received_at"), "duration_minutes")


def stream_unresolved(spark, sf_dir):
    """Alerts of the drained stream, those of outages still open at its end included."""
    rows = _stream_incidents(spark, sf_dir).where("incident_status = 'UNRESOLVED'")
    return rows.drop("received_at")


def _stream_summary(spark, sf_dir, name):
    """A reliability summary kept by the drained stream over several files."""
    root = scratch_path(spark, name)
    target = jobs.Target(f"{root}/tables", f"{root}/checkpoints", available_now=True)
    # Two parts a level, so that a few batches reach several levels.
    jobs.start_reliability(
        batch.derived_enriched_stream(spark, sf_dir, STREAM_FILES), target, fan=2).awaitTermination()
    jobs.finish_reliability(spark, target)
    return jobs.reliability_summary(spark, target, name, fan=2)


def stream_reliability(spark, sf_dir):
    """Closed outages rolled up over the network, from the stream's counts."""
    return reliability.rollup_of(_stream_summary(spark, sf_dir, "network"))


def stream_restoration(spark, sf_dir):
    """Counts and shares per level, from the stream's counts."""
    reports = reliability.reports_of(_stream_summary(spark, sf_dir, "levels"))
    return rounded(reports.select("level", "name", "opened", "unresolved", "closed", "share_closed"),
                   "share_closed")


def stream_current_status(spark, sf_dir):
    """Last status of each incident, from the stream's status parts."""
    return rounded(_stream_summary(spark, sf_dir, "status"), "duration_minutes")


def stream_service_outages(spark, sf_dir):
    rows = _drained(spark, sf_dir, jobs.start_service_outages, "outage_incident_events",
                    "service_outages", STREAM_FILES)
    return rows.drop("received_at")


def stream_topology(spark, sf_dir):
    rows = _drained(spark, sf_dir, jobs.start_topology, "topology_inference_results", parts=2,
                    finish=jobs.finish_topology)
    return rows.drop("generated_at", "received_at")


def stored_features(spark, sf_dir):
    """Features written to their sorted table and read back."""
    root = scratch_path(spark, "stored")
    append_table(meter_features(spark, sf_dir), "meter_features_15m", root)
    rows = read_table(spark, "meter_features_15m", root).drop("ingested_at")
    return rounded(timed_text(rows, "window_start", "window_end"),
                   "avg_voltage_15m", "voltage_range_15m", digits=7)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        parse_events, parse_events_sql, quarantine_events, validate_events,
        validate_events_sqlcodes, enrich_catalogue, enrich_hierarchy, hierarchy_lookup,
        enriched_events, enriched_sql_variant, enriched_service_variant, processed_events,
        processed_events_narrow, processed_json, features_json, anomalies_json, catalogue_csv,
        hierarchy_csv, hierarchy_csv_positional, events_jsonl, training_csv, scored_csv,
        model_file_scores, arrival_stamps, feature_eligible, meter_features_15m,
        outage_events, outage_previous_state, outage_previous_state_chunked, outage_incidents, outage_incidents_chunked,
        outage_unresolved_event_time, outage_service_variant, outage_rejects, incident_latest,
        active_incidents, outage_frequency, restoration_activity, outage_duration,
        reliability_rollup, topology_evidence, topology_candidates, topology_top3,
        haversine_distance, replay_order, anomaly_scores_pandas, anomaly_scores_hof,
        anomaly_results, anomaly_rank, anomaly_top10, lowest_decisions, anomaly_count,
        feature_profile, score_quantile, scorer_parity, scorer_parity_trained, iforest_train_summary,
        stream_enriched, stream_quarantine, stream_processed_events, stream_meter_features, stream_anomalies, stream_outages,
        stream_unresolved, stream_reliability, stream_restoration, stream_current_status, stream_service_outages, stream_topology, stored_features,
    )
}

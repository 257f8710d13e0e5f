"""Streaming jobs: the standing outputs and the configured use cases."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from meterflow.operators.anomaly import anomaly_results
from meterflow.operators.features import LATENESS, meter_features
from meterflow.operators.forest import ForestModel
from meterflow.operators.parse import quarantine
from meterflow.operators.project import processed_events
from meterflow.schemas import RESULT_TABLES
from meterflow.sinks.kafka import start_kafka
from meterflow.sinks.tables import read_table, start_batches, start_table, write_batch
from meterflow.sources.messages import MAX_FILES
from meterflow.streaming.outage_state import finish, outage_stream, service_stream
from meterflow.streaming.reliability_state import FAN, ReliabilityTables
from meterflow.streaming.topology_state import TopologyBatches


ENRICHED = "enriched_events"
# Batch number of the records a finished run owes; batches of a query count from 0.
OWED = -2


@dataclass(frozen=True)
class Target:
    """Where a job writes: result tables, checkpoints, and whether it stops once drained."""

    root: str
    checkpoint: str
    available_now: bool = False


@dataclass(frozen=True)
class UseCase:
    """A configured use case; ``output`` names its result folder, or its topic when publishing."""

    name: str
    enabled: bool
    output: str


DEFAULT_USE_CASES = (
    UseCase("outage-intelligence", True, "outage_incident_events"),
    UseCase("topology-inference", True, "topology_inference_results"),
    UseCase("anomaly-detection", True, "anomaly_detection_results"),
)


def _is_true(value: object) -> bool:
    """JSON true or the word "true"; any other word, number or nothing is false."""
    return value is True or (isinstance(value, str) and value.strip().lower() == "true")


def load_use_cases(text: str) -> list[UseCase]:
    """Enabled entries of ``{"plugins": [{name, enabled, outputTopic, ...}, ...]}``."""
    entries = [UseCase(entry["name"], _is_true(entry.get("enabled")), entry["outputTopic"])
               for entry in json.loads(text)["plugins"]]
    return [entry for entry in entries if entry.enabled]


def start_processed(enriched: DataFrame, target: Target) -> StreamingQuery:
    """The 23-column processed event table."""
    return start_table(
        processed_events(enriched), "processed_events", target.root, target.checkpoint,
        target.available_now)


def start_quarantine(messages: DataFrame, target: Target) -> StreamingQuery:
    """Broken raw messages with the reason; parsing leaves them out of every other output."""
    return start_table(
        quarantine(messages), "quarantined_messages", target.root, target.checkpoint,
        target.available_now)


def start_enriched(enriched: DataFrame, target: Target) -> StreamingQuery:
    """All columns of the enriched events, landed once for every use case to read."""
    landed = f"{target.root}/{ENRICHED}"
    # An empty first batch: readers can start before there are events.
    enriched.sparkSession.createDataFrame([], enriched.schema).write.mode("overwrite").parquet(
        f"{landed}/batch_id=-1")
    return start_batches(
        enriched,
        lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{landed}/batch_id={batch_id}"),
        ENRICHED, target.checkpoint, target.available_now)


def landed_events(enriched: DataFrame, target: Target, max_files: int = MAX_FILES) -> DataFrame:
    """The landed enriched events as a stream of their own."""
    return (
        enriched.sparkSession.readStream.schema(enriched.schema)
        .option("maxFilesPerTrigger", max_files).parquet(f"{target.root}/{ENRICHED}/*"))


def start_features(enriched: DataFrame, target: Target) -> StreamingQuery:
    """Feature windows, each emitted once the watermark has passed its end.

    Windows the watermark has not reached when a drained run ends are not emitted.
    """
    return start_table(
        meter_features(enriched, LATENESS), "meter_features_15m", target.root, target.checkpoint,
        target.available_now)


def start_features_and_anomalies(
    enriched: DataFrame, model: ForestModel, target: Target,
    output: str = "anomaly_detection_results",
) -> StreamingQuery:
    """Feature windows and their verdicts from one windowed aggregation, as ``start_features``."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            write_batch(rows, "meter_features_15m", target.root, batch_id)
            write_batch(anomaly_results(rows, model), "anomaly_detection_results",
                        target.root, batch_id, output)
        finally:
            rows.unpersist()

    return start_batches(
        meter_features(enriched, LATENESS), write, output, target.checkpoint, target.available_now)


def start_outages(
    enriched: DataFrame, target: Target, output: str = "outage_incident_events",
    wall_clock: bool = False,
) -> StreamingQuery:
    """Incident records; alerts by the stream's clock, or by wall clock.

    What the run before had finished with is taken back: its rows go on from the state.
    """
    _write_owed(enriched.sparkSession.createDataFrame([], RESULT_TABLES["outage_incident_events"][0]), target, output)
    return start_table(
        outage_stream(enriched, wall_clock=wall_clock), "outage_incident_events", target.root,
        target.checkpoint, target.available_now, output)


def _write_owed(records: DataFrame, target: Target, output: str) -> None:
    write_batch(records, "outage_incident_events", target.root, OWED, output)


def finish_outages(
    spark: SparkSession, target: Target, output: str = "outage_incident_events",
) -> None:
    """After a drained run: write what waiting rows and open outages still give, as a batch of its own.

    The next run replaces that batch, so running and finishing again counts nothing twice.
    """
    _write_owed(finish(spark, f"{target.checkpoint}/{output}"), target, output)


def _reliability(target: Target, output: str, fan: int = FAN) -> ReliabilityTables:
    return ReliabilityTables(f"{target.root}/{output}_reliability", fan)


def start_reliability(
    enriched: DataFrame, target: Target, output: str = "outage_incident_events", fan: int = FAN,
) -> StreamingQuery:
    """``start_outages`` that also keeps the reliability summaries, in the same micro-batch."""
    spark, tables = enriched.sparkSession, _reliability(target, output, fan)
    _write_owed(spark.createDataFrame([], RESULT_TABLES["outage_incident_events"][0]), target, output)
    tables.prepare(spark)

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            write_batch(rows, "outage_incident_events", target.root, batch_id, output)
            tables.update(rows, batch_id)
        finally:
            rows.unpersist()

    return start_batches(
        outage_stream(enriched), write, output, target.checkpoint, target.available_now)


def finish_reliability(
    spark: SparkSession, target: Target, output: str = "outage_incident_events",
) -> None:
    """``finish_outages`` and its part of the summaries; the next run takes both back."""
    finish_outages(spark, target, output)
    _reliability(target, output).owe(
        read_table(spark, "outage_incident_events", f"{target.root}/{output}", f"batch_id={OWED}"))


def reliability_summary(
    spark: SparkSession, target: Target, name: str, output: str = "outage_incident_events",
    fan: int = FAN,
) -> DataFrame:
    """``levels``, ``network`` or ``status`` as of the last micro-batch, with the ``fan`` it was started with."""
    return _reliability(target, output, fan).read(spark, name)


def start_service_outages(enriched: DataFrame, target: Target) -> StreamingQuery:
    """Incident records of the service variant."""
    return start_table(
        service_stream(enriched), "outage_incident_events", target.root, target.checkpoint,
        target.available_now, "service_outages")


def start_topology(
    enriched: DataFrame, target: Target, output: str = "topology_inference_results",
) -> StreamingQuery:
    return start_batches(
        enriched, _topology(target, output), output, target.checkpoint, target.available_now)


def _topology(target: Target, output: str) -> TopologyBatches:
    return TopologyBatches(f"{target.checkpoint}/topology-evidence", target.root, output)


def finish_topology(
    spark: SparkSession, target: Target, output: str = "topology_inference_results",
) -> None:
    """After a drained run: replace results whose evidence came in a later micro-batch."""
    _topology(target, output).finish(spark)


Starter = Callable[[DataFrame, Target, str], StreamingQuery]


def registry(model: ForestModel) -> dict[str, Starter]:
    """Use-case name to the function that starts it on the enriched stream."""
    return {
        "outage-intelligence": start_outages,
        "topology-inference": start_topology,
        "anomaly-detection": lambda enriched, target, output: start_features_and_anomalies(
            enriched, model, target, output),
    }


def start_use_cases(
    enriched: DataFrame, use_cases: list[UseCase], model: ForestModel, target: Target,
) -> list[StreamingQuery]:
    """Land the enriched events and start every enabled use case on them.

    The source is read, parsed and enriched once. An unknown name is an error before anything
    starts. A run that is to end when drained lands everything first.
    """
    known = registry(model)
    wanted = [entry for entry in use_cases if entry.enabled]
    unknown = [entry.name for entry in wanted if entry.name not in known]
    if unknown:
        raise ValueError(f"unknown use cases: {unknown}")
    landing = start_enriched(enriched, target)
    if target.available_now:
        landing.awaitTermination()
    return [landing, *[
        known[entry.name](landed_events(enriched, target), target, entry.output)
        for entry in wanted]]


# Key column of each use case's records on its topic.
TOPIC_KEYS = {"outage-intelligence": "incident_id", "topology-inference": None, "anomaly-detection": "msn"}
_RESULTS = {
    "outage-intelligence": "outage_incident_events",
    "topology-inference": "topology_inference_results",
    "anomaly-detection": "anomaly_detection_results",
}


def publish_use_case(
    spark: SparkSession, use_case: UseCase, servers: str, target: Target,
) -> StreamingQuery:
    """Send a started use case's result folder to the topic of the same name."""
    ddl, stamp, _ = RESULT_TABLES[_RESULTS[use_case.name]]
    results = spark.readStream.schema(f"{ddl}, {stamp} timestamp").parquet(
        f"{target.root}/{use_case.output}/*").drop(stamp)
    return start_kafka(
        results, servers, use_case.output, target.checkpoint, TOPIC_KEYS[use_case.name])

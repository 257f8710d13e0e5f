"""Anomaly verdicts of feature windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.operators.forest import ForestModel, decision
from meterflow.schemas import ANOMALY_RESULT, column_names

USE_CASE = "anomaly-detection"

# Fixed result texts: severity, reason, recommendation per prediction.
VERDICTS = {
    "UNSCORABLE": (
        "UNKNOWN", "Required Isolation Forest feature values are missing.",
        "Review feature completeness before anomaly assessment."),
    "ANOMALY": (
        "WARNING",
        "Unusual combination of 15-minute meter features relative to the learned training "
        "distribution.",
        "Review the source events and phase-voltage readings for this meter and time window."),
    "NORMAL": (
        "NORMAL",
        "15-minute meter feature combination falls within the learned operating distribution.",
        "No anomaly-specific action required."),
}


def _verdict_text(part: int) -> Column:
    return F.coalesce(*[
        F.when(F.col("prediction") == prediction, texts[part])
        for prediction, texts in VERDICTS.items()])


def anomaly_results(features: DataFrame, model: ForestModel, scorer=decision) -> DataFrame:
    """One result record per feature window; windows with a missing feature are UNSCORABLE."""
    score = F.col("_decision")
    return (
        features.withColumn("_decision", scorer(model))
        .withColumns({
            "use_case": F.lit(USE_CASE), "model_type": F.lit(model.model_type),
            "sklearn_version": F.lit(model.sklearn_version),
            "model_contamination": F.lit(model.contamination),
            "prediction": F.when(score.isNull(), "UNSCORABLE").when(score < 0, "ANOMALY")
            .otherwise("NORMAL"),
            "confidence": F.lit(None).cast("double"), "anomaly_score": -score})
        .withColumns({"severity": _verdict_text(0), "reason": _verdict_text(1),
                      "recommendation": _verdict_text(2)})
        .select(*column_names(ANOMALY_RESULT)))

"""Drift of a new table against the stored baseline, and the decision to train."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tablewright import scratch
from tablewright.operators.drift import ALPHA, drift_report, drift_verdict, retrain_gate
from tablewright.sources.documents import read_document, write_document
from tablewright.sources.models import model_exists

STATUS_SCHEMA = "drift_detected boolean, n_drifted bigint, n_features bigint"


def validate(
    new: DataFrame,
    baseline: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    status_path: str,
    alpha: float = ALPHA,
) -> DataFrame:
    """Write the drift status and return the per-feature report, computed once."""
    report = scratch.write_table(drift_report(new, baseline, numeric, categorical, alpha), "drift-report")
    write_document(drift_verdict(report), status_path)
    return report


def decide(spark: SparkSession, status_path: str, model_path: str) -> DataFrame:
    """One row: train or skip, and why. A missing status is an error."""
    status = read_document(spark, status_path, STATUS_SCHEMA)
    return retrain_gate(status, model_exists(spark, model_path))

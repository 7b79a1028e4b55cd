"""Saving and loading fitted models."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a saved model, on whatever file system it lies."""
    try:
        return not spark.read.text(f"{path}/metadata").isEmpty()
    except AnalysisException:
        return False

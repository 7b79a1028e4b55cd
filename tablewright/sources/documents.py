"""Small JSON documents: metrics, reports, parameters, drift status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

METRIC_SCHEMA = "name string, value double"


def write_document(df: DataFrame, path: str) -> None:
    """Store a small table as JSON rows in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_document(spark: SparkSession, path: str, schema: str = METRIC_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)

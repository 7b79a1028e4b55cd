"""Scoring of arriving files with the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_score(
    spark: SparkSession,
    input_path: str,
    schema: StructType | str,
    score: Callable[[DataFrame], DataFrame],
    output_path: str,
    checkpoint_path: str,
    input_format: str = "parquet",
    max_files_per_trigger: int = 1000,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Apply ``score`` to every file that arrives; each input row is written exactly once.

    ``score`` is the function used on tables. The default trigger takes all files present and
    stops; give ``{"processingTime": "1 minute"}`` to keep running. A restart with the same
    checkpoint goes on after the last finished batch.
    """
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if input_format == "csv":
        source = source.option("header", True)
    return (
        score(source.format(input_format).load(input_path))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start(output_path)
    )

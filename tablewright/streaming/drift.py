"""Arriving batches: store each one, test it against the baseline, decide about training."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablewright.operators.clean import align_to
from tablewright.operators.baseline import StoredBaseline
from tablewright.operators.drift import ALPHA, drift_verdict, retrain_gate


def batch_handler(
    baseline: StoredBaseline,
    table_path: str,
    report_path: str,
    decision_path: str,
    table_schema: StructType,
    model_exists: Callable[[], bool],
    alpha: float = ALPHA,
    method: str = "corrected",
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: append the batch by name, report its drift, store the decision.

    The baseline comes as stored counts, so a batch costs its own size plus the baseline's distinct values.

    Each batch owns the partition ``batch_id=<n>`` of every output and overwrites it, so a batch
    that is replayed after a failure leaves one copy.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        stored_path = f"{table_path}/batch_id={batch_id}"
        align_to(batch, table_schema).write.mode("overwrite").parquet(stored_path)
        # The stored batch is read back, so the source is not read once per test.
        stored = spark.read.schema(table_schema).parquet(stored_path)
        reported = f"{report_path}/batch_id={batch_id}"
        report = baseline.report(stored, alpha, method)
        report.coalesce(1).write.mode("overwrite").parquet(reported)
        verdict = drift_verdict(spark.read.schema(report.schema).parquet(reported))
        retrain_gate(verdict, model_exists()).write.mode("overwrite").parquet(f"{decision_path}/batch_id={batch_id}")

    return handle


def stream_drift(
    spark: SparkSession,
    input_path: str,
    schema: StructType,
    handler: Callable[[DataFrame, int], None],
    checkpoint_path: str,
    input_format: str = "parquet",
    trigger: dict | None = None,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Run the handler on every micro-batch of arriving files; a backlog comes in batches of ``max_files_per_trigger``."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if input_format == "csv":
        source = source.option("header", True)
    return (
        source.format(input_format)
        .load(input_path)
        .writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """An output of the handler over all batches, with the batch number as a column."""
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))

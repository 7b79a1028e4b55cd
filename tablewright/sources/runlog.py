"""Run log: parameters, tags and metrics of (nested) runs in one table, a partition per run.

A run that is repeated under its id (a replay after a failure) replaces what it had written.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run_id string, parent_run_id string, kind string, key string, text string, number double, ts timestamp"


@dataclass
class Run:
    """One run. Entries are kept until ``close`` writes them to the run's partition of the table in one go.

    Give a ``run_id`` to make the run repeatable; its children's ids follow from it, their names and their order.
    """

    spark: SparkSession
    path: str
    name: str
    parent: Run | None = None
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    _rows: list[tuple] = field(default_factory=list)
    _frames: list[DataFrame] = field(default_factory=list)
    _children: int = 0

    def child(self, name: str) -> Run:
        self._children += 1
        own = uuid.uuid5(uuid.NAMESPACE_OID, f"{self.run_id}/{self._children}/{name}").hex
        return Run(self.spark, self.path, name, self, own)

    def params(self, values: Mapping[str, object]) -> None:
        self._add("param", {k: str(v) for k, v in values.items()})

    def tags(self, values: Mapping[str, object]) -> None:
        self._add("tag", {k: str(v) for k, v in values.items()})

    def metrics(self, values: Mapping[str, float]) -> None:
        for key, value in values.items():
            self._rows.append(self._row("metric", key, None, float(value)))

    def metric_table(self, metrics: DataFrame) -> None:
        """Metrics as ``name, value`` rows, written from the executors."""
        self._frames.append(
            metrics.select(
                F.lit(self.run_id).alias("run_id"),
                F.lit(self.parent.run_id if self.parent else None).cast("string").alias("parent_run_id"),
                F.lit("metric").alias("kind"),
                F.col("name").alias("key"),
                F.lit(None).cast("string").alias("text"),
                F.col("value").alias("number"),
                F.lit(_now()).alias("ts"),
            )
        )

    def close(self) -> None:
        self.tags({"run_name": self.name})
        out = self.spark.createDataFrame(self._rows, SCHEMA).coalesce(1)
        for frame in self._frames:
            out = out.unionByName(frame)
        # Only this run's partition is exchanged, once all its files are there.
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(self.path)
        self._rows, self._frames = [], []

    def __enter__(self) -> Run:
        return self

    def __exit__(self, failure, *_) -> None:
        self.tags({"status": "failed" if failure else "finished"})
        self.close()

    def _add(self, kind: str, values: Mapping[str, str]) -> None:
        for key, value in values.items():
            self._rows.append(self._row(kind, key, value, None))

    def _row(self, kind: str, key: str, text: str | None, number: float | None) -> tuple:
        return self.run_id, self.parent.run_id if self.parent else None, kind, key, text, number, _now()


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    names = spark.createDataFrame([], SCHEMA).columns
    return spark.read.schema(SCHEMA).parquet(path).select(*names)


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)

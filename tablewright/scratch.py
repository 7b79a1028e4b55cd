"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its executor, so a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tablewright-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table."""
    return f"{shared_folder(spark)}/tablewright/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Compute ``df`` once, into a Parquet table, and return that table.

    Unlike a cached frame it survives the loss of executors, and Catalyst knows its true size. ``codec`` names
    a compression other than the session's: "zstd" takes a quarter less disk than "snappy" for texts, and some more time.
    """
    path = new_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablewright import scratch
from tablewright.operators.clean import align_to

# Partition column of a table whose batches have ids.
BATCH_COLUMN = "_batch"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Give a schema: without one Spark reads the whole input once more to guess it.

    A record with too few or too many fields, or with a value that isn't of its column's type, is an error when it is read,
    whatever columns are asked for (a wrong value only where its column is); ``read_csv_accounted`` sets such records aside.
    """
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("columnPruning", False)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_csv_accounted(
    spark: SparkSession, path: str, schema: StructType | str, rejects_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The good rows of a CSV with a header, and its malformed records: together one row per record.

    A reject has the ``file`` it stands in and the whole ``record``. The input is parsed once, into a stored table, so that
    both sides come from the same reading; with ``rejects_path`` the rejects are written there too (replacing earlier
    ones). Empty lines are no records. A header that differs from the schema is an error.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    record = "_record"
    while record in wanted.names:
        record = f"_{record}"
    reader = spark.read.option("header", True).option("enforceSchema", False).option("columnPruning", False)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", record)
    parsed = reader.schema(StructType([*wanted.fields, StructField(record, StringType())])).csv(path)
    # The file is of use for rejects alone.
    file = F.when(F.col(record).isNotNull(), F.input_file_name())
    stored = scratch.write_table(parsed.select(F.struct(*wanted.names).alias("row"), F.col(record).alias("record"), file.alias("file")), "csv")
    rows = stored.where("record IS NULL").select("row.*")
    rejects = stored.where("record IS NOT NULL").select("file", "record")
    if rejects_path is not None:
        rejects.write.mode("overwrite").parquet(rejects_path)
        rejects = spark.read.schema(rejects.schema).parquet(rejects_path)
    return rows, rejects


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_baseline(df: DataFrame, path: str, existing: str = "error") -> None:
    """Store a drift baseline. A baseline that follows the data can never show drift, so by default
    an existing one is an error; ``keep`` leaves it alone, ``replace`` promotes the new one."""
    modes = {"error": "errorifexists", "keep": "ignore", "replace": "overwrite"}
    df.write.mode(modes[existing]).parquet(path)


def from_rows(spark: SparkSession, rows: Sequence[Mapping], schema: StructType | str) -> DataFrame:
    """A few request rows as a table; missing fields are null."""
    parsed = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    return spark.createDataFrame([tuple(r.get(n) for n in parsed.names) for r in rows], parsed)


def append_batch(batch: DataFrame, path: str, schema: StructType | None = None, batch_id: str | int | None = None) -> None:
    """Append a batch to a Parquet table by column name.

    ``schema`` is the table's; left out, it is read from the table. Columns are brought into the
    table's order and types, missing ones become null; unknown columns and values that don't fit are errors.

    With a ``batch_id`` the batch owns the partition of that name in the table, and a replay after a failure replaces it:
    files are first written aside, and only that partition is exchanged when all of them are there. ``read_appended`` reads
    such a table. Without one, a replay is a second copy.
    """
    target = schema or (batch.sparkSession.read.parquet(path) if batch_id is None else read_appended(batch.sparkSession, path)).schema
    aligned = align_to(batch, target)
    if batch_id is None:
        aligned.write.mode("append").parquet(path)
        return
    owned = aligned.withColumn(BATCH_COLUMN, F.lit(str(batch_id)))
    owned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN).parquet(path)


def read_appended(spark: SparkSession, path: str, schema: StructType | None = None, batch_id: str | int | None = None) -> DataFrame:
    """The rows of all batches (or of one) that were appended with an id, without the id."""
    reader = spark.read if schema is None else spark.read.schema(StructType([*schema.fields, StructField(BATCH_COLUMN, StringType())]))
    found = reader.parquet(path)
    if batch_id is not None:
        found = found.where(F.col(BATCH_COLUMN).cast("string") == str(batch_id))
    return found.drop(BATCH_COLUMN)

"""Schema alignment and tolerant cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tablewright.functions.columns import tolerant_double


def cast_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast the listed columns that exist to double; malformed text becomes null."""
    wanted = set(columns)
    return df.select(*[tolerant_double(c).alias(c) if c in wanted else F.col(c) for c in df.columns])


def union_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stack two tables by column name; a column missing on one side is null there."""
    return first.unionByName(second, allowMissingColumns=True)


def align_to(df: DataFrame, schema: StructType, misfits: str = "error") -> DataFrame:
    """Bring a batch to a table's columns by name: order, types, nulls for missing columns.

    A column the table does not know is an error, because dropping it would lose data. So is a value that does not fit
    its column's type, when the rows are computed; ``misfits="null"`` makes it null instead.
    """
    if misfits not in ("error", "null"):
        raise ValueError(f"unknown treatment of misfits {misfits!r}")
    unknown = set(df.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"columns not in the target table: {sorted(unknown)}")
    present = set(df.columns)

    def fitted(name: str, kind: DataType) -> Column:
        if name not in present:
            return F.lit(None).cast(kind)
        if df.schema[name].dataType == kind:
            return F.col(name)
        cast = F.col(name).try_cast(kind)
        if misfits == "null":
            return cast
        report = F.concat(F.lit(f"does not fit column {name}: "), F.col(name).cast("string"))
        return F.when(F.col(name).isNotNull() & cast.isNull(), F.raise_error(report)).otherwise(cast)

    return df.select(*[fitted(f.name, f.dataType).alias(f.name) for f in schema.fields])


def misfit_rows(df: DataFrame, schema: StructType, output: str = "misfits") -> DataFrame:
    """Rows with a value that does not fit the type of the table's column, with the names of these columns."""
    changed = [f for f in schema.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    bad = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)) for f in changed]
    names = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return df.withColumn(output, names).where(F.size(output) > 0)


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows with a label. A label that failed its cast is null and counts as unlabelled."""
    return df.where(F.col(label).isNotNull())


def unlabelled(df: DataFrame, label: str) -> DataFrame:
    """Rows without a label."""
    return df.where(F.col(label).isNull())

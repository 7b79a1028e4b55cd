"""Category indices and one-hot vectors for columns of any number of categories: the dictionary is a table, never a list.

``encode.indexer`` keeps all categories of a column on the driver and in the column's metadata. Here nothing per category
leaves the executors; the indices and vectors are the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tablewright import scratch
from tablewright.functions.columns import missing
from tablewright.operators.impute import BROADCAST_BYTES, TARGET_ROWS, join_group_stats
from tablewright.operators.order import ROWS_PER_PART, with_place


@dataclass(frozen=True)
class Dictionary:
    """The categories of ``column`` as a stored table (category, idx, n_rows) of ``size`` rows."""

    column: str
    table: DataFrame
    size: int


def build_dictionary(df: DataFrame, column: str, rows_per_part: int = ROWS_PER_PART) -> Dictionary:
    """Categories (as text) by falling number of rows, ties by name, numbered from 0. Nulls are no category.

    The counts are put in order by range (see ``with_place``); a category's index is its place.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("category"))
    stored = scratch.write_table(counts.agg(F.count(F.lit(1)).alias("n_rows")), "category-counts")
    size = stored.count()
    numbered = with_place(stored, [F.desc("n_rows"), F.asc("category")], size, "idx", rows_per_part)
    return Dictionary(column, scratch.write_table(numbered.select("category", "idx", "n_rows"), "dictionary"), size)


def with_index(
    df: DataFrame,
    dictionary: Dictionary,
    output: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Adds each row's index; null and unknown categories share the index after the last one.

    The dictionary is broadcast if it is small; else rows and dictionary meet by category, and hot categories and
    nulls by themselves (see ``join_group_stats``).
    """
    entries = dictionary.table.select(F.col("category").alias("_category"), F.col("idx").alias("_idx"), F.col("n_rows").alias("_rows"))
    keyed = df.withColumn("_category", F.col(dictionary.column).cast("string"))
    joined = join_group_stats(keyed, entries, "_category", ["_idx"], "_rows", broadcast_bytes, target_rows)
    index = F.coalesce(F.col("_idx"), F.lit(dictionary.size)).cast("double")
    return joined.withColumn(output, index).select(*[F.col(c) for c in df.columns if c != output], output)


def with_sparse_vector(
    df: DataFrame, numeric: Sequence[str], indexed: Sequence[tuple[str, Dictionary]], output: str = "features"
) -> DataFrame:
    """Adds one sparse vector: the numbers, then a slot per category of each (index column, dictionary).

    The table is stored, and read back with the vector's type. The index of null and unknown categories has no
    slot. Rows with a null or NaN number are skipped, as the assembler skips them. More slots than an integer counts are an error.
    """
    size = len(numeric) + sum(d.size for _, d in indexed)
    if size >= 1 << 31:
        raise ValueError(f"{size} slots are more than a vector can have")
    entries = [_entry(F.lit(float(i)), F.col(c).cast("double"), F.col(c).cast("double") != 0) for i, c in enumerate(numeric)]
    offset = len(numeric)
    for column, dictionary in indexed:
        entries.append(_entry(F.col(column) + F.lit(float(offset)), F.lit(1.0), F.col(column) < dictionary.size))
        offset += dictionary.size
    whole = F.lit(True)
    for column in numeric:
        whole = whole & ~missing(F.col(column).cast("double"), True)
    kept = F.filter(F.array(*entries), lambda e: e["kept"]) if entries else F.array().cast("array<struct<slot:int,value:double>>")
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(size).alias("size"),
        F.transform(kept, lambda e: e["slot"]).alias("indices"),
        F.transform(kept, lambda e: e["value"]).alias("values"),
    )
    path = scratch.new_path(df.sparkSession, "vectors")
    others = [c for c in df.columns if c != output]
    df.where(whole).select(*others, vector.alias(output)).write.parquet(path)
    schema = StructType([df.schema[c] for c in others] + [StructField(output, VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)


def _entry(slot: Column, value: Column, kept: Column) -> Column:
    return F.struct(slot.cast("int").alias("slot"), value.alias("value"), kept.alias("kept"))

"""Which rows a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_column: str, divisor: int) -> Column:
    """The CRC-32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % divisor


def bounded(rows: DataFrame, id_column: str, most: int) -> DataFrame:
    """About ``most`` of the rows, chosen by a hash of their id (all if there are no more): a model's bounded sample.

    Rows of one id are chosen together; that ids repeat so often as to break the bound is not expected of labels.
    """
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col(id_column), F.lit("sample")), F.lit(1 << 30)) < int(most / n * (1 << 30)))

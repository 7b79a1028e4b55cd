"""Column expressions for cleaning, deriving and decoding. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def tolerant_double(column: str | Column) -> Column:
    """Cast to double; text that is not a number becomes null instead of failing the job."""
    return _col(column).try_cast("double")


def regex_group_or(column: str | Column, pattern: str, default: str, group: int = 1) -> Column:
    """First match of ``pattern``; no match gives ``default`` and null text stays null."""
    found = F.regexp_extract(_col(column), pattern, group)
    return F.when(found != "", found).when(found.isNotNull(), F.lit(default))


def total_plus_one(columns: Sequence[str]) -> Column:
    """Sum of count columns plus one for the row itself (a family size, a basket size)."""
    total = F.lit(1)
    for name in columns:
        total = F.col(name) + total
    return total


def flag_equal(column: str | Column, value) -> Column:
    """1 where the column equals ``value``, else 0; null counts as 0."""
    return F.coalesce((_col(column) == value).cast("int"), F.lit(0))


def missing(column: str | Column, nan_is_missing: bool) -> Column:
    """Null test that can also count NaN as missing (only for float and double columns)."""
    c = _col(column)
    return (c.isNull() | F.isnan(c)) if nan_is_missing else c.isNull()


def without_negative_zero(column: str | Column) -> Column:
    """0.0 in place of -0.0, so that equal values always share a bucket."""
    c = _col(column)
    return F.when(c == 0.0, F.lit(0.0)).otherwise(c)


def positive_probability(column: str | Column = "probability") -> Column:
    """Probability of the positive class out of a model's probability vector."""
    return vector_to_array(_col(column))[1]


def decode_label(column: str | Column, positive: str, negative: str) -> Column:
    """Readable text for a 0/1 prediction."""
    return F.when(_col(column) == 1, F.lit(positive)).otherwise(F.lit(negative))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column

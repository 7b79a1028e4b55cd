"""Profiles of numeric and categorical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATISTICS = ("mean", "stddev", "min", "max")


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, sample standard deviation, minimum and maximum, one row per column.

    Only rows where every profiled column is present count. One pass; the single result row is
    then turned into rows.
    """
    makers = {"mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .dropna()
        .agg(*[makers[s](c).alias(f"{c}_{s}") for c in columns for s in STATISTICS])
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}_{s}").alias(s) for s in STATISTICS]) for c in columns]
    )
    return wide.select(F.inline(rows))


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; nulls are counted as a value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def write_profile(profile: DataFrame, path: str) -> None:
    """Store a profile as JSON rows."""
    profile.write.mode("overwrite").json(path)

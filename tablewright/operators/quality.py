"""Row rules: which rows break which constraint."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named condition that a row must meet. A null outcome breaks the rule."""

    name: str
    holds: Column

    @staticmethod
    def required(column: str) -> Rule:
        return Rule(f"{column}_required", F.col(column).isNotNull())

    @staticmethod
    def between(column: str, low, high) -> Rule:
        """Inside the closed range; NaN is outside, null is left to ``required``."""
        c = F.col(column)
        return Rule(f"{column}_range", c.isNull() | c.between(low, high))

    @staticmethod
    def one_of(column: str, values: Sequence) -> Rule:
        """One of the allowed values; null is left to ``required``."""
        c = F.col(column)
        return Rule(f"{column}_domain", c.isNull() | c.isin(*values))

    @property
    def broken(self) -> Column:
        return ~F.coalesce(self.holds, F.lit(False))


def with_violations(df: DataFrame, rules: Sequence[Rule], output: str = "violations") -> DataFrame:
    """Add the names of the broken rules as an array, empty for a valid row."""
    return df.withColumn(output, F.array_compact(F.array(*[F.when(r.broken, F.lit(r.name)) for r in rules])))


def valid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every rule."""
    kept = df
    for rule in rules:
        kept = kept.where(~rule.broken)
    return kept


def rejected_rows(df: DataFrame, rules: Sequence[Rule], output: str = "violations") -> DataFrame:
    """Rows that break a rule, with the names of the broken rules."""
    return with_violations(df, rules, output).where(F.size(output) > 0)


def violation_summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Checked and failed rows per rule. One pass over the data, no explode of rows."""
    wide = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(r.broken).alias(f"f{i}") for i, r in enumerate(rules)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.col("n_rows"), F.col(f"f{i}").alias("n_failed"))
            for i, r in enumerate(rules)
        ]
    )
    return wide.select(F.inline(rows))

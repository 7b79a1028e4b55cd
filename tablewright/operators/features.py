"""Derived feature columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tablewright.functions.columns import flag_equal, regex_group_or, total_plus_one

# A courtesy title inside a full name, and the text used where there is none.
TITLE_PATTERN = r" ([A-Za-z]+)\."
NO_TITLE = "Other"


def with_title(df: DataFrame, text: str, output: str = "Title", pattern: str = TITLE_PATTERN) -> DataFrame:
    """Add the title found in a name column."""
    return df.withColumn(output, regex_group_or(text, pattern, NO_TITLE))


def with_group_size(
    df: DataFrame, parts: Sequence[str], size: str = "FamilySize", single: str = "IsAlone"
) -> DataFrame:
    """Add the size of the row's group (sum of the parts plus one) and a flag for size one."""
    total = total_plus_one(parts)
    return df.withColumns({size: total, single: flag_equal(total, 1)})

"""Places of rows in a global order, without a task that sees them all."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright import scratch

# Rows that one task orders.
ROWS_PER_PART = 1_000_000


def with_place(df: DataFrame, order: Sequence[Column], n_rows: int, output: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Adds each row's place, from 0, in the given order; ``n_rows`` tells how many parts the rows need.

    The rows are dealt by range, so each part holds a stretch of the order; a row's place is that in its part plus the
    rows of the parts before. The parts are stored, so no place changes on a retry.
    """
    dealt = df.repartitionByRange(max(1, math.ceil(n_rows / rows_per_part)), *order).sortWithinPartitions(*order)
    # The id holds the number of the part above 33 bits of the place in it.
    placed = scratch.write_table(dealt.withColumn(output, F.monotonically_increasing_id()), "places")
    part, inside = F.shiftright(output, 33), F.col(output).bitwiseAND(F.lit((1 << 33) - 1))
    # One row per part of ``rows_per_part`` rows.
    below = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select("_part", below.alias("_below"))
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(output, F.col("_below") + inside).drop("_part", "_below")

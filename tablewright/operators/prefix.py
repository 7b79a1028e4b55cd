"""Running counts over values in global order, the base of the drift test and the curves.

A window without partitions would sort the whole table in one task. Here equal values are first
counted together, the counts are dealt by range into buckets, running counts are formed inside each
bucket as it is dealt, and each bucket starts from the total of the buckets below it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright import scratch
from tablewright.functions.columns import without_negative_zero

# Distinct values that one task orders.
ROWS_PER_BUCKET = 1_000_000
# More buckets than these have their totals joined by a shuffle.
BROADCAST_BUCKETS = 100_000


def prefix_counts(
    df: DataFrame,
    values: Sequence[str],
    weights: Mapping[str, Column],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Per value column and distinct value: the weights at the value, up to it, and in total.

    Returns ``feature, value`` and for each weight ``w`` the columns ``w``, ``w_upto`` (values up
    to and including this one) and ``w_total``. Null and NaN values are left out.
    """
    return running_counts(long_values(df, values, weights), list(weights), rows_per_bucket)


def long_values(df: DataFrame, values: Sequence[str], weights: Mapping[str, Column]) -> DataFrame:
    """One row ``feature, value, <weights>`` for each present value of each value column."""
    if not values:
        return df.sparkSession.createDataFrame([], f"feature string, value double, {', '.join(f'{n} long' for n in weights)}")
    entries = [
        F.struct(F.lit(c).alias("feature"), without_negative_zero(F.col(c).cast("double")).alias("value"))
        for c in values
    ]
    weighed = [w.cast("long").alias(n) for n, w in weights.items()]
    if len(entries) == 1:
        long = df.select(entries[0].alias("e"), *weighed).select("e.*", *weights)
    else:
        long = df.select(F.inline(F.array(*entries)), *weighed)
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def running_counts(long: DataFrame, weights: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``prefix_counts`` of rows that are already in the form of ``long_values``; they may be pre-counted.

    The input is read once. A bucket holds about ``rows_per_bucket`` distinct values, of however many features. After the
    counts, rows are shuffled once: sums run inside the range parts as they come.
    """
    sums = [F.sum(w).alias(w) for w in weights]
    counted = scratch.write_table(long.groupBy("feature", "value").agg(*sums), "value-counts")
    buckets = max(1, math.ceil(counted.count() / rows_per_bucket))
    parts = range_parts(counted, weights, buckets)
    if buckets > 1:
        # Stored, so that a value's bucket never changes when a task is retried.
        parts = scratch.write_table(parts, "value-buckets")
    offsets = part_offsets(parts, weights) if buckets > 1 else _totals(counted, weights)
    # One row per feature and bucket: broadcast while these are few.
    few = buckets <= BROADCAST_BUCKETS
    joined = parts.join(F.broadcast(offsets) if few else offsets.hint("merge"), ["feature", "bucket"])
    return joined.select(
        "feature",
        "value",
        *weights,
        *[(F.col(f"{w}_upto") + F.col(f"{w}_below")).alias(f"{w}_upto") for w in weights],
        *[f"{w}_total" for w in weights],
    )


def range_parts(counted: DataFrame, weights: Sequence[str], buckets: int) -> DataFrame:
    """Rows (feature, value, weights) dealt by range into ``buckets`` parts and ordered, with sums that run inside a part.

    Adds ``bucket``, the number of the part, ascending with feature and value, and ``<weight>_upto``.
    """
    dealt = counted.repartitionByRange(buckets, "feature", "value").sortWithinPartitions("feature", "value")
    fields = ", ".join(f"{w} long" for w in weights) + ", bucket int, " + ", ".join(f"{w}_upto long" for w in weights)
    ordered = dealt.select("feature", "value", *weights, F.spark_partition_id().alias("bucket"))
    return ordered.mapInArrow(lambda batches: _running(batches, weights), f"feature string, value double, {fields}")


def part_offsets(parts: DataFrame, weights: Sequence[str]) -> DataFrame:
    """Per feature and bucket of ``range_parts``: the weights below the bucket, and the feature's total."""
    below = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    of_feature = Window.partitionBy("feature")
    sums = parts.groupBy("feature", "bucket").agg(*[F.sum(w).alias(w) for w in weights])
    return sums.select(
        "feature",
        "bucket",
        *[F.coalesce(F.sum(w).over(below), F.lit(0)).alias(f"{w}_below") for w in weights],
        *[F.sum(w).over(of_feature).alias(f"{w}_total") for w in weights],
    )


def _totals(counted: DataFrame, weights: Sequence[str]) -> DataFrame:
    """``part_offsets`` of a single bucket."""
    totals = counted.groupBy("feature").agg(*[F.sum(w).alias(f"{w}_total") for w in weights])
    return totals.withColumns({"bucket": F.lit(0), **{f"{w}_below": F.lit(0).cast("long") for w in weights}})


def _running(batches: Iterator[pa.RecordBatch], weights: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Sums up to each row of its feature, over the ordered batches of one part."""
    last, sums = None, np.zeros(len(weights), dtype=np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column(0).dictionary_encode()
        numbers = codes.indices.to_numpy()
        first = np.flatnonzero(np.diff(numbers, prepend=-1))
        names = [codes.dictionary[int(numbers[i])].as_py() for i in first]
        sizes = np.diff(first, append=batch.num_rows)
        upto = []
        for i in range(len(weights)):
            run = np.cumsum(batch.column(2 + i).to_numpy())
            # Each feature starts at 0; the first one of the batch may go on from the batch before.
            start = np.concatenate(([0], run[first[1:] - 1]))
            start[0] -= sums[i] if names[0] == last else 0
            run = run - np.repeat(start, sizes)
            upto.append(run)
            sums[i] = run[-1]
        last = names[-1]
        columns = [*batch.columns, *(pa.array(u) for u in upto)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *(f"{w}_upto" for w in weights)])

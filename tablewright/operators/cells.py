"""Rows as counted cells: trees see a number only as the bin it falls in, so equal rows can be learnt from by their count."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablewright.operators.encode import FeatureSpec
from tablewright.operators.sampling import SAMPLE_SEED

# Spark's trees have so many bins per number, and take the bounds of the bins from so many rows.
MAX_BINS = 32
BOUND_ROWS = 10_000


def complete(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The rows that the assembler of features keeps: those without a missing number."""
    for name in spec.numeric:
        value = F.col(name).cast("double")
        df = df.where(value.isNotNull() & ~F.isnan(value))
    return df


def bin_bounds(df: DataFrame, spec: FeatureSpec, n_rows: int) -> dict[str, list[float]]:
    """Bounds of every number's bins, by the rule of Spark's trees.

    Spark looks at all rows of a table of up to ``BOUND_ROWS`` rows, and beyond at a sample of about as many; so
    does this. The sample follows from the rows' layout alone.
    """
    rows = complete(df, spec).select(*[F.col(c).cast("double") for c in spec.numeric])
    if n_rows > BOUND_ROWS:
        rows = rows.sample(False, BOUND_ROWS / n_rows, SAMPLE_SEED)
    found = rows.collect() if spec.numeric else []
    return {name: bounds_of(row[i] for row in found) for i, name in enumerate(spec.numeric)}


def bounds_of(values: Iterable[float], bins: int = MAX_BINS) -> list[float]:
    """Bounds of at most ``bins`` bins: between all values if these are few, else where running counts come closest to equal shares."""
    counts = sorted(Counter(values).items())
    middles = [(low + high) / 2.0 for (low, _), (high, _) in zip(counts, counts[1:])]
    if len(middles) < bins:
        return middles
    stride = sum(n for _, n in counts) / bins
    bounds, seen, target = [], counts[0][1], stride
    for middle, (_, n) in zip(middles, counts[1:]):
        if abs(seen - target) < abs(seen + n - target):
            bounds.append(middle)
            target += stride
        seen += n
    return bounds


def bin_number(name: str, bounds: Sequence[float]) -> Column:
    """How many bounds lie below a value; a value equal to a bound belongs to the bin under it."""
    value, number = F.col(name).cast("double"), F.lit(0)
    for bound in bounds:
        number = number + (value > F.lit(bound)).cast("int")
    return number.cast("double").alias(name)


def binned(df: DataFrame, spec: FeatureSpec, bounds: dict[str, list[float]], *others: str | Column) -> DataFrame:
    """Complete rows with bin numbers in place of numbers; categories stay."""
    return complete(df, spec).select(*[bin_number(c, bounds[c]) for c in spec.numeric], *spec.categorical, *others)


def with_bootstraps(cells: DataFrame, count: str, names: Sequence[str], seed: int) -> DataFrame:
    """Add one column per tree: how often a bootstrap draws rows of the cell.

    A forest draws each row a Poisson-distributed number of times, mean 1; for a cell of n rows these add up to
    a Poisson-distributed number of mean n.
    """
    schema = StructType([*cells.schema.fields, *[StructField(name, LongType()) for name in names]])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        generator = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            mean = batch.column(count).to_numpy(zero_copy_only=False)
            drawn = generator.poisson(mean[:, None], (batch.num_rows, len(names)))
            columns = [*batch.columns, *[pa.array(drawn[:, i]) for i in range(len(names))]]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    return cells.mapInArrow(draw, schema)

"""Reproducible samples, splits and folds, placed by hashed key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.hashing import key_hash, multiplicative_hash, unit_draw
from tablewright.operators.order import with_place

# One seed per purpose, so that a fold is independent of the split it lies in.
SAMPLE_SEED = 42
SPLIT_SEED = 43
FOLD_SEED = 44
# A range of hashes with so few rows is not split further.
FEW_ROWS = 10_000


def hash_sample(
    df: DataFrame, key: str, fraction: float, seed: int = SAMPLE_SEED, method: str = "xxhash64"
) -> DataFrame:
    """Bernoulli sample: each key is in or out for good. A filter at the scan, no shuffle."""
    return df.where(unit_draw(key, seed=seed, method=method) < fraction)


def hash_split(
    df: DataFrame, key: str, weights: Sequence[float], seed: int = SPLIT_SEED, method: str = "xxhash64"
) -> list[DataFrame]:
    """Split into disjoint parts that together hold every row, in proportion to the weights."""
    total = float(sum(weights))
    tagged = df.withColumn("_draw", unit_draw(key, seed=seed, method=method))
    parts, low = [], 0.0
    for n, weight in enumerate(weights, start=1):
        high = low + weight / total
        inside = F.col("_draw") >= low
        if n < len(weights):  # the last part is open, so rounding cannot lose a row
            inside = inside & (F.col("_draw") < high)
        parts.append(tagged.where(inside).drop("_draw"))
        low = high
    return parts


def sample_n(
    df: DataFrame,
    key: str,
    n: int,
    seed: int = SAMPLE_SEED,
    method: str = "xxhash64",
    order_by: Sequence[str] = (),
    few: int = FEW_ROWS,
) -> DataFrame:
    """Exactly ``n`` rows (all rows of a smaller table), whatever ``n``: those with the smallest hashes of their key.

    Rows of one hash are taken by key, then by ``order_by``, then by a hash of the whole row; equal rows are
    interchangeable. The hash that cuts the sample is found digit by digit: counts of the next 16 bits tell in which
    range it lies, until few rows share a range. All ranges below are taken by a filter where they lie; only the
    last range is put in order. No step gathers the sample in one task.
    """
    if method not in ("xxhash64", "multiplicative"):
        raise ValueError(f"unknown hash method {method!r}")
    if n <= 0:
        return df.where(F.lit(False))
    hashed = key_hash(key, seed=seed) if method == "xxhash64" else F.coalesce(multiplicative_hash(key, seed), F.lit(-1).cast("long"))
    inside, missing, n_inside = F.lit(True), n, 0
    low = None
    for shift in (48, 32, 16, 0) if method == "xxhash64" else (16, 0):
        digit = F.shiftright(hashed, shift)
        # At most 65,537 rows.
        counts = sorted((r["digit"], r["count"]) for r in df.where(inside).groupBy(digit.alias("digit")).count().collect())
        if low is None and sum(c for _, c in counts) <= n:
            return df
        for cut, n_inside in counts:
            if n_inside >= missing:
                break
            missing -= n_inside
        low, inside = cut << shift, digit == cut
        if n_inside == missing or n_inside <= few:
            break
    below = df.where(hashed < low)
    if n_inside == missing:
        return below.unionByName(df.where(inside))
    # Equal rows have no order of their own; a random last key keeps many of them from sharing a task.
    order = [hashed, F.col(key), *[F.col(c) for c in order_by], F.xxhash64(*[F.col(c) for c in df.columns]), F.rand(seed)]
    names = [f"order_{i}" for i in range(len(order))]
    keyed = df.where(inside).select(F.struct("*").alias("row"), *[c.alias(name) for c, name in zip(order, names)])
    last = with_place(keyed, [F.col(name) for name in names], n_inside, "place").where(F.col("place") < missing)
    return below.unionByName(last.select("row.*"))


def with_fold(
    df: DataFrame, key: str, folds: int, output: str = "fold", seed: int = FOLD_SEED, method: str = "xxhash64"
) -> DataFrame:
    """Add a fold number 0..folds-1, usable as the fold column of a cross validator."""
    return df.withColumn(output, F.floor(unit_draw(key, seed=seed, method=method) * folds).cast("int"))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """Spark's own sample, for tables without a key; its rows depend on the partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float], seed: int = SAMPLE_SEED) -> list[DataFrame]:
    """Spark's own split, for tables without a key; its rows depend on the partitioning."""
    return df.randomSplit(list(weights), seed=seed)

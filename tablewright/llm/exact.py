"""Whole-number vectors and sums of whole numbers that stay exact at any size."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LIMB = 30
LONG_MOST = (1 << 63) - 1


def usable(vector: str) -> Column:
    """Whether a vector is there and holds neither nulls nor non-finite numbers."""
    fine = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def whole_vectors(vectors: DataFrame, vector: str, scale: int, multiple: int, kept: dict[str, Column]) -> tuple[DataFrame, int]:
    """Columns ``kept`` and ``x`` = floor(scale * component) of all usable vectors, and the width of x.

    The width is that of the longest usable vector, rounded up to ``multiple``; shorter vectors end in zeros.
    Products beyond a long saturate.
    """
    rows = vectors.where(usable(vector))
    width = rows.agg(F.max(F.size(vector))).first()[0] or 0
    width += -width % multiple
    floors = F.transform(vector, lambda e: F.floor(e.cast("double") * F.lit(float(scale))).cast("long"))
    rest = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(vector))
    return rows.select(*[c.alias(n) for n, c in kept.items()], F.concat(floors, rest).alias("x")), width


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a column of lists of ``width`` longs."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


LIMBS = "name int, place int, limb int, value long"


def limbs(name: int, numbers: Iterable[int]) -> pa.RecordBatch:
    """Whole numbers as rows (name, place, limb, value) of 30 bits each, which add up as longs without overflow."""
    place, limb, value = [], [], []
    for at, number in enumerate(numbers):
        number, k = int(number), 0
        while not -(1 << _LIMB) < number < 1 << _LIMB:
            place.append(at)
            limb.append(k)
            value.append(number & ((1 << _LIMB) - 1))
            number >>= _LIMB
            k += 1
        if number:
            place.append(at)
            limb.append(k)
            value.append(number)
    columns = [pa.array([name] * len(place), pa.int32()), pa.array(place, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["name", "place", "limb", "value"])


def totals(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Sums per (name, place) of rows made by ``limbs``: as many as there are names and places, whatever the data."""
    out: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("name", "place", "limb").agg(F.sum("value").alias("value")).collect():
        key = (r["name"], r["place"])
        out[key] = out.get(key, 0) + (r["value"] << _LIMB * r["limb"])
    return out

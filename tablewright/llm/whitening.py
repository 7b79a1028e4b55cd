"""Whitening of embeddings: exact cross-products from bit planes, principal components, projected rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import exact
from tablewright.scratch import write_table

SLICE_ROWS = 8192


@dataclass(frozen=True)
class Whitening:
    """What is fitted: how many distinct vectors, their sums, and components (rows) with their variances.

    ``explained`` is each component's share of the whole variance; ``identity_error`` the largest absolute entry of the
    whitened fit list's covariance minus the identity (None if no component has any variance).
    """

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None


def whiten(vectors: DataFrame, scale: int = 256, components: int = 4, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    A component c of a vector becomes floor(scale * c). The model is fitted on each distinct whole-number vector once, so
    copies don't weigh. ``deviation`` is the sum over dimensions of (n * x - sums)^2, exact (null beyond a long).
    Null vectors and those with null or non-finite entries are left out. Rows with null or repeated ids keep a row each.
    Shorter vectors end in zeros; an empty table or one of empty vectors has no rows. Vectors of width d have at
    most d components. A component without variance has a null ``whitened``; without any variance, ``explained`` is null.
    Equal variances (ties) share a space of components, of which some basis is taken, the same for all rows.
    """
    rows, width = exact.whole_vectors(vectors, vector, scale, 1, {"vec_id": F.col(id_column).cast("long")})
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not width:
        return vectors.sparkSession.createDataFrame([], schema)
    distinct = write_table(rows.select("x").distinct(), "whitening")
    model = fit(distinct, width, components)
    return rows.mapInArrow(lambda batches: _rows(batches, model), schema)


def fit(distinct: DataFrame, width: int, components: int = 4) -> Whitening:
    """The model of a stored list of distinct vectors. Only sums of ``width`` squared numbers reach the driver."""
    found = exact.totals(distinct.mapInArrow(lambda b: _scatter(b, width), exact.LIMBS))
    n = found.get((0, 0), 0)
    sums = [found.get((1, i), 0) for i in range(width)]
    covariance = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            # Centred as whole numbers; the quotient of two integers is rounded once.
            covariance[i, j] = covariance[j, i] = (n * found.get((2, i * width + j), 0) - sums[i] * sums[j]) / (n * n)
    variances, axes = np.linalg.eigh(covariance)
    order = np.argsort(-variances, kind="stable")[:components]
    trace = float(np.trace(covariance))
    kept = np.where(variances[order] > trace * width * np.finfo(float).eps, variances[order], 0.0)
    model = Whitening(n, sums, axes.T[order], kept, kept / trace if trace else np.full(len(order), np.nan))
    alive = [k for k, v in enumerate(kept) if v > 0]
    if not alive:
        return model
    whitened = distinct.mapInArrow(lambda b: _projected(b, model), "w array<double>")
    pairs = [(i, j) for i in alive for j in alive if i <= j]
    row = whitened.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in pairs]).first()
    error = max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs))
    return Whitening(model.n, model.sums, model.components, model.variances, model.explained, float(error))


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of x and of x times x transposed, as Python integers.

    Each dimension is shifted to start at 0 and cut into bit planes, one bit per row, packed into words. Two planes of
    weights 2^a and 2^b give 2^(a+b) times the number of bits that both have set.
    """
    rows, width = x.shape
    low = x.min(axis=0)
    shifted = (x - low).view(np.uint64)  # a difference of two longs, right as an unsigned number
    bits = [max(int(m).bit_length(), 1) for m in shifted.max(axis=0)]
    first = np.concatenate(([0], np.cumsum(bits)))
    planes = np.zeros((first[-1], -(-rows // 64) * 8), dtype=np.uint8)
    for i in range(width):
        own = (shifted[:, i][None, :] >> np.arange(bits[i], dtype=np.uint64)[:, None]) & np.uint64(1)
        packed = np.packbits(own.astype(np.uint8), axis=1)
        planes[first[i] : first[i + 1], : packed.shape[1]] = packed
    words = planes.view(np.uint64)
    narrow = 2 * max(bits) + max(max(bits), rows.bit_length()) < 62
    kind = np.int64 if narrow else object
    weight = np.array([1 << a for n in bits for a in range(n)], dtype=kind)
    counts = np.zeros((len(words), len(words)), dtype=np.int64)
    for p in range(len(words)):
        counts[p, p:] = np.bitwise_count(words[p] & words[p:]).sum(axis=1)
        counts[p:, p] = counts[p, p:]
    single = np.add.reduceat(np.diag(counts).astype(kind) * weight, first[:-1]).astype(object)
    products = np.add.reduceat(np.add.reduceat(counts.astype(kind) * weight[:, None] * weight[None, :], first[:-1], axis=0), first[:-1], axis=1)
    low = low.astype(object)
    products = products.astype(object) + np.outer(low, single) + np.outer(single, low) + rows * np.outer(low, low)
    return single + rows * low, products


def _scatter(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    n, sums, products = 0, np.zeros(width, dtype=object), np.zeros((width, width), dtype=object)
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            x = exact.matrix(batch.column(0).slice(start, SLICE_ROWS), width)
            own_sums, own_products = cross_products(x)
            n, sums, products = n + len(x), sums + own_sums, products + own_products
    if n:
        yield exact.limbs(0, [n])
        yield exact.limbs(1, sums)
        yield exact.limbs(2, np.triu(products).ravel())


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - sums, exact."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0))) * model.n + max(map(abs, model.sums))
    if len(model.sums) * most * most <= exact.LONG_MOST:
        return x * model.n - np.array(model.sums, dtype=np.int64)
    return x.astype(object) * model.n - np.array(model.sums, dtype=object)


def _whitened(centred: np.ndarray, model: Whitening) -> np.ndarray:
    with np.errstate(invalid="ignore", divide="ignore"):
        out = (centred / model.n).astype(np.float64) @ model.components.T / np.sqrt(model.variances)
    out[:, model.variances == 0] = np.nan
    return out


def _projected(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        w = _whitened(_centred(exact.matrix(batch.column(0), len(model.sums)), model), model)
        bounds = np.arange(len(w) + 1, dtype=np.int32) * np.int32(w.shape[1])
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(bounds, w.ravel())], names=["w"])


def _rows(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        centred = _centred(exact.matrix(batch.column(1), len(model.sums)), model)
        squares = (centred * centred).sum(axis=1)
        if squares.dtype == object:
            squares = [v if v <= exact.LONG_MOST else None for v in squares]
        w = _whitened(centred, model)
        k, rows = w.shape[1], batch.num_rows
        columns = {
            "vec_id": batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
            "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
            "n": pa.array(np.full(rows * k, model.n, dtype=np.int64)),
            "deviation": pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
            "whitened": pa.array(w.ravel(), from_pandas=True),
            "explained": pa.array(np.tile(model.explained, rows), from_pandas=True),
            "identity_error": pa.array([model.identity_error] * (rows * k), pa.float64()),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

"""Compression of vectors to codes: one small codebook per part of the vector, learnt by ball k-means on whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablewright.llm import exact
from tablewright.operators.impute import join_group_stats
from tablewright.scratch import write_table

SLICE_ROWS = 8192


@dataclass(frozen=True)
class Codes:
    """Vectors are cut into ``parts`` equal parts, each with a codebook of ``entries`` entries, learnt in ``rounds`` rounds."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


@dataclass(frozen=True)
class Compressed:
    """``rows``: vec_id, label, codes (one byte per part), error. ``codebooks``: part by entry by position."""

    rows: DataFrame
    codebooks: np.ndarray


def compress(vectors: DataFrame, spec: Codes = Codes(), id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> Compressed:
    """The codes of all usable vectors, and the codebooks.

    A component c becomes floor(scale * c). A codebook starts as its part of the vectors with the smallest ids (equal ids:
    the smaller vector first; null ids never start an entry). In each round, parts go to the nearest entry
    (ties: the lower index) and entries become the floored means of their parts; entries without parts stay.
    Null vectors and those with null or non-finite entries are left out; rows with null or repeated ids are rows like others.
    Vectors whose length doesn't divide evenly end in zeros. Fewer vectors than entries make smaller codebooks.
    ``error`` is the sum of squared distances, exact (null beyond a long). Only codebooks and their sums reach the driver.
    """
    kept = {"vec_id": F.col(id_column).cast("long"), "label": F.col(label)}
    rows, width = exact.whole_vectors(vectors, vector, spec.scale, spec.parts, kept)
    rows = rows.select("vec_id", "label", "x", F.lit(None).cast("binary").alias("codes"))
    starts = rows.where("vec_id IS NOT NULL").select("vec_id", "x").orderBy("vec_id", "x").limit(spec.entries).collect()
    x = np.array([r.x for r in starts], dtype=np.int64).reshape(len(starts), spec.parts, width // spec.parts)
    books = x.transpose(1, 0, 2).copy()
    schema = StructType([*rows.schema.fields, StructField("error", LongType())])
    if not books.size:
        found = rows.select("*", F.lit(0).cast("long").alias("error"))
        return Compressed(found.select("vec_id", "label", F.lit(bytes(spec.parts)).alias("codes"), "error"), books)
    for _ in range(spec.rounds):
        rows = write_table(rows.mapInArrow(_assigner(books, None), rows.schema), "vector-codes")
        books = _moved(books, exact.totals(rows.select("x", "codes").mapInArrow(_summer(books.shape), exact.LIMBS)))
    final = rows.mapInArrow(_assigner(books, schema), schema).select("vec_id", "label", "codes", "error")
    return Compressed(write_table(final, "vector-codes"), books)


def with_group_error(rows: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``label_error``: the error summed over the rows of equal labels, null labels together (null beyond a long)."""
    sums = write_table(rows.groupBy(label).agg(F.try_sum("error").alias("label_error"), F.count("*").alias("n_rows")), "label-errors")
    nulls = sums.where(F.col(label).isNull()).first()
    joined = join_group_stats(rows, sums, label, ["label_error"], "n_rows")
    of_null = F.lit(nulls["label_error"] if nulls else None).cast("long")
    return joined.withColumn("label_error", F.when(F.col(label).isNull(), of_null).otherwise(F.col("label_error")))


def codebook_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def _squares(a: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=-1)


def nearest(x: np.ndarray, book: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every row of ``x`` and its squared distance, exact, when ``at`` were the entries before.

    Every entry is the centre of a ball around the rows it had; its radius is that of its farthest row. Only entries nearer
    to it than twice the radius are its neighbours. A row nearer to its entry than half the way to the nearest neighbour
    (the stable core) stays. Any other row lies in a ring: it is compared with the neighbours that are at most twice its own
    distance away, as all others are farther from it than its own entry. All of it in whole numbers, squared.
    """
    own = _squares(x - book[at])
    between = _squares(book[:, None, :] - book[None, :, :])
    radius = np.zeros(len(book), dtype=own.dtype)
    np.maximum.at(radius, at, own)
    neighbours = (between <= 4 * radius[:, None]).astype(bool) & ~np.eye(len(book), dtype=bool)
    # For each entry, how far its nearest neighbour is: its core ends half way there.
    far = int(between.max()) * 4 + 1 if between.dtype == object else np.iinfo(np.int64).max
    reach = np.where(neighbours, between, far).min(axis=1)
    ring = np.flatnonzero((4 * own >= reach[at]).astype(bool) & neighbours.any(axis=1)[at])
    out, distance = at.copy(), own.copy()
    if len(ring):
        candidates = neighbours[at[ring]] & (between[at[ring]] <= 4 * own[ring][:, None]).astype(bool)
        row, entry = np.nonzero(candidates)
        if len(row):
            d = _squares(x[ring[row]] - book[entry])
            first = np.flatnonzero(np.diff(row, prepend=-1))
            least = np.minimum.reduceat(d, first)
            hits = np.flatnonzero((d == np.repeat(least, np.diff(first, append=len(row)))).astype(bool))
            hits = hits[np.diff(row[hits], prepend=-1) > 0]  # of equal distances the lower index
            of, new = ring[row[hits]], entry[hits]
            better = (d[hits] < own[of]).astype(bool) | (d[hits] == own[of]).astype(bool) & (new < at[of])
            out[of[better]], distance[of[better]] = new[better], d[hits][better]
    return out, distance


def _parts(column: pa.Array, shape: tuple[int, int, int], books: np.ndarray | None = None) -> np.ndarray:
    """Row by part by position; as Python integers if squares could leave a long."""
    parts, _, size = shape
    x = exact.matrix(column, parts * size).reshape(len(column), parts, size)
    most = max(abs(int(v)) for a in (x, books) if a is not None for v in (a.max(initial=0), a.min(initial=0)))
    return x if 16 * parts * size * most * most < exact.LONG_MOST else x.astype(object)


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    """Row by part; all 0 before the first round."""
    if column.null_count:
        return np.zeros((len(column), parts), dtype=np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), parts).astype(np.int64)


def _assigner(books: np.ndarray, with_error):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                x = _parts(part.column(2), books.shape, books)
                own = books.astype(x.dtype)
                codes = _codes(part.column(3), len(books))
                error = np.zeros(len(x), dtype=x.dtype)
                for p in range(len(books)):
                    codes[:, p], distance = nearest(x[:, p], own[p], codes[:, p])
                    error = error + distance
                packed = pa.array([r.tobytes() for r in codes.astype(np.uint8)], pa.binary())
                columns, names = [*part.columns[:3], packed], ["vec_id", "label", "x", "codes"]
                if with_error is not None:
                    columns.append(pa.array([v if v <= exact.LONG_MOST else None for v in error.tolist()], pa.int64()))
                    names.append("error")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _summer(shape: tuple[int, int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, dtype=object), np.zeros(shape[:2], dtype=object)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                x, codes = _parts(part.column(0), shape), _codes(part.column(1), shape[0])
                for p in range(shape[0]):
                    own = np.zeros(shape[1:], dtype=x.dtype)
                    np.add.at(own, codes[:, p], x[:, p])
                    sums[p] += own.astype(object)
                    counts[p] += np.bincount(codes[:, p], minlength=shape[1])
        if counts.any():
            yield exact.limbs(0, sums.ravel())
            yield exact.limbs(1, counts.ravel())

    return run


def _moved(books: np.ndarray, found: dict[tuple[int, int], int]) -> np.ndarray:
    """Entries as the floored means of their parts."""
    out = books.copy()
    parts, entries, size = books.shape
    for at in range(parts * entries):
        n = found.get((1, at), 0)
        if n:
            p, e = divmod(at, entries)
            out[p, e] = [found.get((0, at * size + i), 0) // n for i in range(size)]
    return out

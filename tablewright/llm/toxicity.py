"""Toxicity of texts: a linear classifier over character n-grams scaled by their naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text as tx
from tablewright.llm.labelled import bounded
from tablewright.scratch import write_table


SLICE = 1 << 20
#: A task that counts n-grams hands them on when it holds so many.
HELD = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _lower(character: str) -> int:
    """Lower case, if it is one character. ASCII digits and signs but the apostrophe are spaces: signs that stand next to a
    word must not hide it, and without labels that tell otherwise they only add n-grams that fit by chance."""
    own = character.lower()
    if character.isspace() or character.isascii() and not character.isalpha() and character != "'":
        own = " "
    return ord(own if len(own) == 1 else character)


#: Lower case of the first 65,536 characters.
_LOWER = np.array([c if 0xD800 <= c < 0xE000 else _lower(chr(c)) for c in range(1 << 16)], dtype=np.uint32)


@dataclass(frozen=True)
class Toxicity:
    """Settings, and after :func:`fit` the model.

    ``sizes``: lengths in characters of the n-grams of the lower-cased text, spaces included. Of the n-grams that at least
    ``least`` training texts hold, the ``features`` with the largest difference of rates times log-count ratio are used.
    ``train_rows`` bounds the labelled rows read to fit.
    """

    sizes: tuple[int, ...] = (4, 5, 6, 7)
    features: int = 2048
    least: int = 3
    smooth: float = 1.0
    penalty: float = 1e-4
    steps: int = 300
    train_rows: int = 12_000
    codes: np.ndarray | None = field(default=None, repr=False)
    weights: np.ndarray | None = field(default=None, repr=False)
    bias: float = 0.0


def _codes(characters: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the n-grams of one size, and the first character of each. None crosses a text's end."""
    n = len(characters) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        codes *= _STEP
        codes += characters[i : i + n]
    inside = np.ones(n, dtype=bool)
    for i in range(1, size):
        ends = offsets[1:] - i
        inside[ends[(ends >= 0) & (ends < n)]] = False
    at = np.flatnonzero(inside)
    return tx.mix(codes[at], 73), at


def _prepared(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts as numbers, in lower case and with spaces for white space, and each text's bounds."""
    raw, offsets = tx.buffer(column)
    characters = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    # A character's first byte is any that doesn't continue another.
    before = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return np.where(characters < len(_LOWER), _LOWER[np.minimum(characters, len(_LOWER) - 1)], characters), before[offsets]


def _present(column: pa.Array, codes: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted ``codes`` each text holds: pairs of text and code numbers, each once."""
    raw, offsets = _prepared(column)
    gate = np.zeros(1 << 16, dtype=bool)
    gate[(tx.mix(codes, 71) & np.uint64(0xFFFF)).astype(np.int64)] = True
    pairs = []
    for size in sizes:
        own, at = _codes(raw, offsets, size)
        maybe = np.flatnonzero(gate[(tx.mix(own, 71) & np.uint64(0xFFFF)).astype(np.int64)])
        own, at = own[maybe], at[maybe]
        place = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        hit = codes[place] == own
        text = np.searchsorted(offsets, at[hit], side="right") - 1
        pairs.append(text.astype(np.int64) * len(codes) + place[hit])
    both = np.unique(np.concatenate(pairs))
    return both // len(codes), both % len(codes)


def _counted(characters: np.ndarray, offsets: np.ndarray, labels: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-grams with the numbers of texts of either label that hold them."""
    codes, at = _codes(characters, offsets, size)
    owner = (np.searchsorted(offsets, at, side="right") - 1).astype(np.int32)
    del at
    order = np.lexsort((owner, codes))
    codes, owner = codes[order], owner[order]
    once = np.ones(len(codes), dtype=bool)
    once[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    marks = labels[owner[once]].astype(np.int32)
    return _summed(codes[once], marks, 1 - marks)


def _summed(codes: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(codes):
        return codes, p, q
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[starts], np.add.reduceat(p[order], starts), np.add.reduceat(q[order], starts)


def _counts(codes: np.ndarray, p: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(codes.view(np.int64)), pa.array(p.astype(np.int64)), pa.array(q.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["code", "p", "q"])


def fit(labelled: DataFrame, spec: Toxicity = Toxicity(), label: str = "label", text: str = "text", id_column: str = "doc_id") -> Toxicity:
    """The classifier of rows whose label is 0 or 1; other labels, null texts and null ids are not learnt from.

    Without rows of both labels the model gives the label's share (0.5 without any) to every text. N-grams of equal gain at
    the end of the list of features are taken by their hashes. Whole texts are read, very long ones as slices of their own.
    """
    rows = labelled.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    # The bounded sample is stored, as four passes read it.
    rows = write_table(bounded(rows.where("label IN (0, 1) AND text IS NOT NULL AND id IS NOT NULL"), "id", spec.train_rows), "toxicity")
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    neg, pos = totals.get(0, 0), totals.get(1, 0)
    if not neg or not pos:
        share = pos / (neg + pos) if neg + pos else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Toxicity(**{**spec.__dict__, "codes": np.zeros(1, np.uint64), "weights": np.zeros(1), "bias": float(np.log(share / (1 - share)))})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))
        for batch in tx.slices(batches, "text", SLICE):
            characters, offsets = _prepared(batch.column(1))
            labels = batch.column(2).to_numpy()
            for size in spec.sizes:
                held = _summed(*(np.concatenate(x) for x in zip(held, _counted(characters, offsets, labels, size))))
                if len(held[0]) > HELD:
                    yield _counts(*held)
                    held = tuple(x[:0] for x in held)
        yield _counts(*held)

    counts = rows.mapInArrow(count, "code long, p long, q long").groupBy("code").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    counts = counts.where(f"p + q >= {spec.least}")
    # Presence counts are compared with the numbers of texts, so the ratio is one of document rates.
    p_rate, q_rate = (F.col("p") + spec.smooth) / (pos + 2 * spec.smooth), (F.col("q") + spec.smooth) / (neg + 2 * spec.smooth)
    rated = counts.select("code", F.log(p_rate / q_rate).alias("ratio"), F.abs((p_rate - q_rate) * F.log(p_rate / q_rate)).alias("gain"))
    chosen = rated.orderBy(F.desc("gain"), "code").limit(spec.features).toPandas()
    if chosen.empty:
        chosen = pd.DataFrame({"code": [0], "ratio": [0.0]})
    order = np.argsort(chosen["code"].to_numpy().view(np.uint64))
    codes, ratio = chosen["code"].to_numpy().view(np.uint64)[order], chosen["ratio"].to_numpy()[order]

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text", SLICE):
            texts, features = _present(batch.column(1), codes, spec.sizes)
            bounds = np.searchsorted(texts, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column(2), tx.lists(pa.array(features.astype(np.int32)), bounds)], names=["label", "held"])

    # Bounded by train_rows * features.
    table = rows.mapInArrow(hold, "label int, held array<int>").toArrow()
    held = table["held"].combine_chunks()
    held = held.combine_chunks() if isinstance(held, pa.ChunkedArray) else held
    y = table["label"].to_numpy().astype(float)
    column = held.flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(y)), pa.compute.list_value_length(held).to_numpy())
    x = ratio[column]
    w, b = np.zeros(len(codes)), float(np.log(pos / neg))
    m_w, v_w, m_b, v_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, spec.steps + 1):
        z = np.bincount(row, weights=x * w[column], minlength=len(y)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g_w, g_b = np.bincount(column, weights=x * error[row], minlength=len(w)) + spec.penalty * w, error.sum()
        m_w, v_w, m_b, v_b = 0.9 * m_w + 0.1 * g_w, 0.999 * v_w + 0.001 * g_w**2, 0.9 * m_b + 0.1 * g_b, 0.999 * v_b + 0.001 * g_b**2
        rate = 0.05 / (1 - 0.9**step)
        w -= rate * m_w / (np.sqrt(v_w / (1 - 0.999**step)) + 1e-8)
        b -= rate * m_b / (np.sqrt(v_b / (1 - 0.999**step)) + 1e-8)
    return Toxicity(**{**spec.__dict__, "codes": codes, "weights": w * ratio, "bias": float(b)})


def score(documents: DataFrame, model: Toxicity, text: str = "text", column: str = "score") -> DataFrame:
    """The rows with the probability of label 1 in ``column`` (replaced if there); null texts score as empty ones.

    Equal texts have equal scores, however long, and a score on the caller's threshold is the caller's to place.
    """
    codes, weights, bias, sizes = model.codes, model.weights, model.bias, model.sizes

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for batch in tx.slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string(), from_pandas=True)], names=["text"])], "text", SLICE):
            row, feature = _present(batch.column(0), codes, sizes)
            z = np.bincount(row, weights=weights[feature], minlength=batch.num_rows) + bias
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return documents.withColumn(column, of(F.col(text).cast("string")))

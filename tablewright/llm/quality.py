"""Quality of documents by attention-based multiple-instance learning over their passages."""

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

#: Classes of bytes for the shape of a text: lower case, upper case, digit, line end, other space, high byte, and one for each of ten groups of signs.
_SHAPE = np.array([4 if b in (9, 11, 12, 13, 32) else 3 if b == 10 else 1 if 65 <= b <= 90 else 0 if 97 <= b <= 122 else 2 if 48 <= b <= 57 else 5 if b >= 128 else 6 + b % 10 for b in range(256)], np.int64)


@dataclass(frozen=True)
class Quality:
    """Settings, and after :func:`fit` the model.

    A passage is ``passage`` words. It is encoded by the rates of its byte-shape trigrams in ``buckets`` hashed places,
    and by five measures of repetition and case. ``attention`` is the width of the gated attention. ``train_rows`` bounds
    the labelled rows read to fit, ``steps`` the passes over their passages.
    """

    passage: int = 64
    buckets: int = 96
    attention: int = 16
    train_rows: int = 5_000
    steps: int = 150
    rate: float = 0.02
    penalty: float = 1e-4
    weights: dict[str, np.ndarray] | None = field(default=None, repr=False)

    @property
    def width(self) -> int:
        return self.buckets + 5


def encode(column: pa.Array, spec: Quality) -> tuple[np.ndarray, np.ndarray]:
    """Encoded passages of all texts, and each text's bounds in them. A text without words has one passage of zeros."""
    raw, offsets = tx.buffer(column)
    starts, ends, bounds = tx.words(raw, offsets, tx.NON_SPACE)
    hashes = tx.word_hashes(raw, starts, ends)
    n_words = np.diff(bounds)
    n = np.maximum(-(-n_words // spec.passage), 1)
    out_bounds = np.concatenate(([0], np.cumsum(n)))
    total = int(out_bounds[-1])
    features = np.zeros((total, spec.width), dtype=np.float32)
    if not len(starts):
        return features, out_bounds
    owner = np.repeat(out_bounds[:-1], n_words) + (np.arange(len(starts)) - np.repeat(bounds[:-1], n_words)) // spec.passage
    size = np.bincount(owner, minlength=total)
    # A byte belongs to the passage of the word it stands in or after.
    of_byte = np.repeat(owner, np.diff(starts, append=len(raw)))
    shape = _SHAPE[raw[starts[0] :]]
    if len(shape) >= 3:
        code = shape[:-2] | shape[1:-1] << 4 | shape[2:] << 8
        place = (tx.mix(np.arange(1 << 12), 81) % np.uint64(spec.buckets)).astype(np.int64)[code]
        counts = np.bincount(of_byte[:-2] * spec.buckets + place, minlength=total * spec.buckets)
        features[:, : spec.buckets] = counts.reshape(total, spec.buckets)
    n_bytes = np.maximum(np.bincount(of_byte, minlength=total), 1)
    features[:, : spec.buckets] = np.sqrt(features[:, : spec.buckets] / n_bytes[:, None])
    words = np.maximum(size, 1)
    same = np.zeros(len(starts))
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    first = np.ones(len(starts))
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    upper = np.bincount(of_byte, weights=shape == 1, minlength=total)
    features[:, spec.buckets] = np.bincount(owner, weights=same, minlength=total) / words
    features[:, spec.buckets + 1] = np.bincount(owner[order], weights=first, minlength=total) / words
    features[:, spec.buckets + 2] = upper / n_bytes
    features[:, spec.buckets + 3] = np.bincount(of_byte, weights=shape >= 6, minlength=total) / n_bytes
    features[:, spec.buckets + 4] = np.minimum(np.bincount(owner, weights=ends - starts, minlength=total) / words / 20, 2)
    return features, out_bounds


def _forward(x: np.ndarray, bounds: np.ndarray, w: dict[str, np.ndarray]) -> tuple:
    v, u = np.tanh(x @ w["v"]), 1 / (1 + np.exp(-np.clip(x @ w["u"], -30, 30)))
    scores = (v * u) @ w["a"]
    starts, n = bounds[:-1], np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    e = np.exp(scores - np.maximum.reduceat(scores, starts)[owner])
    share = e / np.add.reduceat(e, starts)[owner]
    bag = np.add.reduceat(x * share[:, None], starts, axis=0)
    z = bag @ w["c"] + w["b"]
    return v, u, share, bag, owner, 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(labelled: DataFrame, spec: Quality = Quality(), label: str = "label", text: str = "text", id_column: str = "doc_id") -> Quality:
    """The model of rows whose label is 0 or 1; other labels, null texts and null ids are not learnt from.

    Passages are encoded by Spark tasks; the attention's and the classifier's weights are learnt together by gradient
    descent from the labels of the (boundedly many) documents. Without rows every text scores 0.5.
    """
    rows = labelled.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    rows = bounded(rows.where("label IN (0, 1) AND text IS NOT NULL AND id IS NOT NULL"), "id", spec.train_rows)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            x, bounds = encode(batch.column(1), spec)
            packed = [x[a:b].astype("<f4").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0).cast(pa.int64()), pa.array(packed, pa.binary())], names=["label", "id", "x"])

    # Sorted, so that the fit doesn't depend on the order of tasks.
    table = rows.mapInArrow(of, "label int, id long, x binary").sort("id", F.length("x"), "x", "label").toArrow()
    y = table["label"].to_numpy().astype(np.float32)
    parts = [np.frombuffer(p, "<f4").reshape(-1, spec.width) for p in table["x"].to_pylist()]
    if not parts:
        parts, y = [np.zeros((1, spec.width), np.float32)], np.full(1, 0.5, np.float32)
    x = np.concatenate(parts)
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    mean, std = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / std
    rng = np.random.default_rng(82)
    w = {"v": rng.normal(0, 0.1, (spec.width, spec.attention)), "u": rng.normal(0, 0.1, (spec.width, spec.attention)), "a": rng.normal(0, 0.1, spec.attention), "c": np.zeros(spec.width), "b": np.zeros(1)}
    w = {k: p.astype(np.float32) for k, p in w.items()}
    share_1 = float(np.clip(y.mean(), 0.01, 0.99))
    w["b"][0] = np.log(share_1 / (1 - share_1))
    first, second = ({k: np.zeros_like(p) for k, p in w.items()} for _ in range(2))
    for step in range(1, spec.steps + 1):
        v, u, share, bag, owner, p = _forward(x, bounds, w)
        error = ((p - y) / len(y)).astype(np.float32)
        # The gradient of the attention scores: how far each passage is from its document's weighted one.
        pull = share * error[owner] * (x @ w["c"] - (bag @ w["c"])[owner])
        gate = pull[:, None] * w["a"]
        g = {
            "c": bag.T @ error, "b": error.sum(keepdims=True), "a": (v * u).T @ pull,
            "v": x.T @ (gate * u * (1 - v**2)), "u": x.T @ (gate * v * u * (1 - u)),
        }
        for k in w:
            grad = g[k] + (spec.penalty * w[k] if k != "b" else 0)
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            w[k] -= (spec.rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Quality(**{**spec.__dict__, "weights": {**w, "mean": mean, "std": std}})


def score(documents: DataFrame, model: Quality, text: str = "text", column: str = "score") -> DataFrame:
    """The rows with the probability of label 1 in ``column`` (replaced if there); null texts score as empty ones."""
    w, spec = model.weights, Quality(passage=model.passage, buckets=model.buckets, attention=model.attention)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for batch in tx.slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string(), from_pandas=True)], names=["text"])], "text", 2 << 20):
            x, bounds = encode(batch.column(0), spec)
            out.append(_forward((x - w["mean"]) / w["std"], bounds, w)[-1].astype(float))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return documents.withColumn(column, of(F.col(text).cast("string")))

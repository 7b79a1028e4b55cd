"""Language of texts from n-gram filters that answer for all languages at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text as tx
from tablewright.llm.labelled import bounded

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageFilters:
    """Settings, and after :func:`fit` the languages and the filters.

    Runs of four bytes of the lower-cased text, with all but letters as spaces, are the n-grams. ``slots`` (a power of
    two) and ``hashes`` size the Bloom filters; the filters of all languages lie side by side, one bit each in the
    numbers of a slot (64 languages a number, as many numbers as it takes). An n-gram enters a language's filter if its rate there is at least ``share`` of its highest rate in
    any language, so that quotations don't make another language's words its own. At most about ``train_rows`` labelled
    rows are read to fit.
    """

    slots: int = 1 << 20
    hashes: int = 3
    share: float = 0.2
    least: int = 2
    train_rows: int = 30_000
    languages: tuple[str, ...] = ()
    common: float = 0.0
    masks: np.ndarray | None = field(default=None, repr=False)


_LETTERS = np.full(256, 32, dtype=np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def _grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the column's texts as 32-bit numbers, and each text's bounds. Runs of spaces count as one."""
    space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    padded = pc.binary_join_element_wise(space, pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")), space, nothing)
    raw, offsets = tx.buffer(padded)
    letters = _LETTERS[raw]
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = (letters[1:] != 32) | (letters[:-1] != 32)
    heads = offsets[:-1][np.diff(offsets) > 0]
    keep[heads] = True
    at = np.concatenate(([0], np.cumsum(keep)))[offsets]
    letters = letters[keep].astype(np.uint32)
    n = np.maximum(np.diff(at) - 3, 0)
    bounds = np.concatenate(([0], np.cumsum(n)))
    if len(letters) < 4:
        return np.zeros(0, np.uint32), bounds
    codes = letters[:-3] | letters[1:-2] << np.uint32(8) | letters[2:-1] << np.uint32(16) | letters[3:] << np.uint32(24)
    inside = np.ones(len(codes), dtype=bool)
    for i in range(1, 4):
        ends = at[1:] - i
        inside[ends[(ends >= 0) & (ends < len(codes))]] = False
    return codes[inside], bounds


def _slots(codes: np.ndarray, spec: LanguageFilters, i: int) -> np.ndarray:
    mixed = tx.mix(codes, 61)
    # Two halves of one hash give all the slots.
    return ((mixed + np.uint64(i) * (mixed >> np.uint64(32) | np.uint64(1))) & np.uint64(spec.slots - 1)).astype(np.int64)


def fit(documents: DataFrame, spec: LanguageFilters = LanguageFilters(), text: str = "text", lang: str = "lang", id_column: str = "doc_id") -> LanguageFilters:
    """The filters of the languages of ``documents``; rows without text, language or id are not learnt from."""
    rows = documents.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = bounded(rows.where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL"), "id", spec.train_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            codes, bounds = _grams(batch.column(1))
            names, which = np.unique(np.array(batch.column(2).to_pylist(), dtype=object).astype(str), return_inverse=True)
            owner = np.repeat(which, np.diff(bounds)).astype(np.uint64)
            both, n = np.unique(owner << np.uint64(32) | codes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[(both >> np.uint64(32)).astype(np.int64)].tolist(), pa.string()), pa.array((both & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], names=["lang", "code", "n"]
            )

    counts = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).sort("lang").collect()}
    if not totals:
        return spec
    languages = tuple(sorted(totals))
    # The commonest language first, for it wins ties.
    common = languages.index(max(languages, key=lambda k: totals[k]))
    languages = languages[common:] + languages[:common]
    words = [f"mask_{w}" for w in range(-(-len(languages) // 64))]

    def bits(word: int):
        def held(mask, x):
            here = (x.rate >= spec.share * F.col("top")) & (F.floor(x.i / 64) == word)
            return mask.bitwiseOR(F.when(here, F.call_function("shiftleft", F.lit(1).cast("long"), x.i - 64 * word)).otherwise(F.lit(0).cast("long")))

        return F.aggregate("all", F.lit(0).cast("long"), held)

    number = F.create_map(*[x for i, k in enumerate(languages) for x in (F.lit(k), F.lit(i))])
    total = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(float(totals[k])))])
    rated = counts.where(f"n >= {spec.least}").select("code", number[F.col("lang")].alias("i"), (F.col("n") / total[F.col("lang")]).alias("rate"))
    masks = (
        rated.groupBy("code")
        .agg(F.max("rate").alias("top"), F.collect_list(F.struct("i", "rate")).alias("all"))
        .select("code", *[bits(w).alias(name) for w, name in enumerate(words)])
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(0).to_numpy().astype(np.uint32)
            for i in range(spec.hashes):
                yield pa.RecordBatch.from_arrays([pa.array(_slots(codes, spec, i)), *batch.columns[1:]], names=["slot", *words])

    # At most one row per slot.
    schema = "slot long, " + ", ".join(f"{w} long" for w in words)
    found = masks.mapInArrow(place, schema).groupBy("slot").agg(*[F.bit_or(w).alias(w) for w in words]).toArrow()
    filters = np.zeros((len(words), spec.slots), dtype=np.uint64)
    for w, name in enumerate(words):
        filters[w, found["slot"].to_numpy()] = found[name].to_numpy().view(np.uint64)
    share = totals[languages[0]] / sum(totals.values())
    return LanguageFilters(spec.slots, spec.hashes, spec.share, spec.least, spec.train_rows, languages, share, filters)


def detect(documents: DataFrame, filters: LanguageFilters, text: str = "text") -> DataFrame:
    """The rows with lang_pred and score (0 to 1); columns of these names are replaced.

    All filters are asked at once for each n-gram of the whole text. A language's share of hits is corrected for the false
    positives that its filter's fill gives; the largest share wins and is the score. A null text, or one without a letter,
    is ``und`` with score 0. A text too short for an n-gram is the commonest language, with that language's share of the
    training text as score. Without any language learnt, all texts are ``und``.
    """
    spark = documents.sparkSession
    masks = filters.masks
    n = len(filters.languages)
    shared = spark.sparkContext.broadcast(masks)
    fill = [_bit(masks, i).mean() for i in range(n)]
    false_rate = np.minimum(np.array(fill) ** filters.hashes, 0.99)
    names = np.array([*filters.languages, UNKNOWN], dtype=object)
    common = filters.common

    @F.pandas_udf("lang_pred string, score double")
    def of(texts):
        import pandas as pd

        preds, scores = [], []
        for batch in tx.slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string(), from_pandas=True)], names=["text"])], "text"):
            pred, score = _decide(batch.column(0), filters, shared.value, false_rate, common) if n else (np.zeros(batch.num_rows, int), np.zeros(batch.num_rows))
            preds.append(names[pred])
            scores.append(score)
        return pd.DataFrame({"lang_pred": np.concatenate(preds) if preds else [], "score": np.concatenate(scores) if scores else []})

    out = documents.withColumn("_language", of(F.col(text).cast("string")))
    return out.withColumns({"lang_pred": F.col("_language.lang_pred"), "score": F.col("_language.score")}).drop("_language")


def _bit(masks: np.ndarray, language: int) -> np.ndarray:
    """One language's bits out of the numbers of all slots asked for."""
    return masks[language // 64] >> np.uint64(language % 64) & np.uint64(1)


def _decide(column: pa.Array, spec: LanguageFilters, masks: np.ndarray, false_rate: np.ndarray, common: float) -> tuple[np.ndarray, np.ndarray]:
    codes, bounds = _grams(column)
    slots = [_slots(codes, spec, i) for i in range(spec.hashes)]
    found = [np.bitwise_and.reduce([word[s] for s in slots]) for word in masks]
    n = np.diff(bounds)
    shares = np.zeros((len(spec.languages), len(n)))
    for i in range(len(spec.languages)):
        hits = np.concatenate(([0], np.cumsum(_bit(found, i).astype(np.int32), dtype=np.int64)))
        hits = hits[bounds[1:]] - hits[bounds[:-1]]
        shares[i] = np.clip((hits / np.maximum(n, 1) - false_rate[i]) / (1 - false_rate[i]), 0, 1)
    pred = shares.argmax(axis=0)
    score = shares.max(axis=0)
    score[n == 0] = common
    raw, offsets = tx.buffer(column)
    ascii_letter = (raw >= 65) & (raw <= 90) | (raw >= 97) & (raw <= 122)
    letters = np.concatenate(([0], np.cumsum(ascii_letter)))
    for i in np.flatnonzero(letters[offsets[1:]] == letters[offsets[:-1]]):
        if not any(c.isalpha() for c in column[int(i)].as_py() or ""):
            pred[i], score[i] = len(spec.languages), 0.0
    return pred, score

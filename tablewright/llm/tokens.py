"""Token counts of documents: every distinct pre-token is counted once, documents only hold pre-token frequencies."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text as tx
from tablewright.llm import tokenizer

BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 60_000
#: Pre-tokens that most documents share are counted before all others: so many, of at most so many bytes each.
COMMON, COMMON_BYTES = 1 << 17, 64
#: Documents read to find them. Which pre-tokens these are changes no count, only where it is made.
COMMON_DOCUMENTS = 20_000
#: A bucket of the other pre-tokens stands for so many bytes of text.
BUCKET_BYTES = 32 << 20

_PARTS = "bucket long, block long, words string, sizes binary, rows binary, freq binary, doc_ids binary, n_bytes binary"
_SUMS = "block long, rows binary, sums binary, doc_ids binary, n_bytes binary"


def token_counts(documents: DataFrame, path: str | None = None, limit: int = 2048, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Documents are taken in blocks. In each, every distinct pre-token has the rows that hold it, and how often. A bounded
    table of common pre-tokens with their counts goes to the tasks, which sum these at once. All others meet by bucket of
    their hash, are counted once each by the tokenizer's model, and come back to their block as sums per row. So a
    pre-token of every document moves nowhere, and what moves grows with the texts. No ids are made.
    A null or empty text has 0 bytes and tokens; a null doc_id is returned as null; repeated rows have a row each; a very
    long text is a block of its own.
    """
    path = path or tokenizer.default_path()
    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    common, buckets = _common(source, path)
    parts = source.mapInArrow(lambda b: _blocks(b, path, common, buckets), _PARTS)
    met = parts.repartition(F.coalesce("bucket", "block"), F.col("bucket").isNull()).sortWithinPartitions("bucket")
    sums = met.mapInArrow(lambda b: _sums(b, path), _SUMS)
    totals = sums.groupBy("block").applyInArrow(_totals, "doc_id long, n_bytes long, n_tokens long")
    return totals.withColumn("over_limit", F.col("n_tokens") > limit)


def _common(source: DataFrame, path: str) -> tuple[dict[str, int], int]:
    """Pre-tokens of the most documents of a bounded sample, with their counts; how many buckets the others need."""
    n = source.count()
    sample = source.where(F.rand(11) < COMMON_DOCUMENTS / max(n, 1)) if n > COMMON_DOCUMENTS else source
    found = sample.select("text").mapInArrow(lambda b: _holders(b, path), "word string, n long")
    row = found.where("word IS NULL").agg(F.sum("n")).first()
    text_bytes = (row[0] or 0) * max(1.0, n / COMMON_DOCUMENTS)
    words = found.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(COMMON)
    counted = words.select("word").mapInArrow(lambda b: _counted(b, path), "word string, n long").collect()
    return {r["word"]: r["n"] for r in counted}, max(1, math.ceil(text_bytes / BUCKET_BYTES))


def _holders(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """How many texts hold each short pre-token; under a null, how many bytes the texts have."""
    tok, names = tokenizer.load(path), ["word", "n"]
    for batch in tx.slices(batches, "text", 4 << 20):
        held = Counter()
        for value in batch.column(0).to_pylist():
            held.update({w for part in tok.pretokens(value) for w in part} if value else ())
        size = int(tx.buffer(batch.column(0))[1][-1])
        # A word of one text of the slice and of no other is not common.
        words = [w for w, n in held.items() if w and (n > 1 or batch.num_rows == 1) and len(w.encode()) <= COMMON_BYTES]
        counts = [held[w] for w in words]
        yield pa.RecordBatch.from_arrays([pa.array([*words, None], pa.string()), pa.array([*counts, size], pa.int64())], names=names)


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tok = tokenizer.load(path)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tok.counts(batch.column(0).to_pylist()), pa.int64())], names=["word", "n"])


def _blocks(batches: Iterator[pa.RecordBatch], path: str, common: dict[str, int], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per block one row with its documents and the sums of common pre-tokens, and one per bucket of the others."""
    tok = tokenizer.load(path)
    block = TaskContext.get().partitionId() << 32
    for big in tx.slices(batches, "text", BLOCK_BYTES):
        for start in range(0, big.num_rows, BLOCK_ROWS):
            batch = big.slice(start, BLOCK_ROWS)
            known: dict[str, int] = defaultdict()
            known.default_factory = known.__len__
            held = []
            for row, value in enumerate(batch.column(1).to_pylist()):
                for part in tok.pretokens(value) if value else ():
                    if part:
                        held.append(np.fromiter(map(known.__getitem__, part), np.int64, len(part)) << 16 | row)
            pairs, freq = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            del held
            words, rows = list(known), pairs & 0xFFFF
            pieces = np.fromiter((common.get(w, -1) for w in words), np.int64, len(words))
            own = pieces[pairs >> 16]
            here = own >= 0
            sums = np.bincount(rows[here], weights=(own * freq)[here], minlength=batch.num_rows).astype("<i8")
            n_bytes = np.diff(tx.buffer(batch.column(1))[1]).astype("<i8").tobytes()
            out = [(None, block, None, None, None, sums.tobytes(), _ids(batch.column(0)), n_bytes)]
            # The others, by bucket.
            first = np.searchsorted(pairs >> 16, np.arange(len(words) + 1))
            others = np.flatnonzero(pieces < 0)
            bucket = np.fromiter((zlib.crc32(words[i].encode()) % buckets for i in others), np.int64, len(others))
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
            for a, b in zip(edges, edges[1:]):
                chosen = others[order[a:b]]
                sizes = first[chosen + 1] - first[chosen]
                at = np.repeat(first[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                text = "\n".join([words[i] for i in chosen])  # pre-tokens hold no white space
                packed = (sizes.astype("<u4"), rows[at].astype("<u2"), freq[at].astype("<u4"))
                out.append((int(bucket[order[a]]), block, text, *(x.tobytes() for x in packed), None, None))
            yield _batch(out, _PARTS)
            block += 1


def _ids(column: pa.Array) -> bytes:
    """Which ids are null, a byte each, and the ids."""
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    return nulls.astype("u1").tobytes() + pa.compute.fill_null(column, 0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def _sums(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Sums per block and row of each bucket's pre-tokens; a block's own row passes through."""
    tok = tokenizer.load(path)

    def finished(parts: list[dict]) -> list[tuple]:
        words = [p["words"].split("\n") for p in parts]
        distinct = list(set().union(*words))
        counts = dict(zip(distinct, tok.counts(distinct)))
        out = []
        for own, p in zip(words, parts):
            times = np.repeat(np.fromiter(map(counts.__getitem__, own), np.int64, len(own)), np.frombuffer(p["sizes"], "<u4"))
            rows, at = np.unique(np.frombuffer(p["rows"], "<u2"), return_inverse=True)
            sums = np.bincount(at, weights=times * np.frombuffer(p["freq"], "<u4"))
            out.append((p["block"], rows.astype("<u2").tobytes(), sums.astype("<u4").tobytes(), None, None))
        return out

    bucket, parts = None, []
    for batch in batches:
        out = []
        for one in batch.to_pylist():
            if one["bucket"] is None:
                out.append((one["block"], None, one["freq"], one["doc_ids"], one["n_bytes"]))
                continue
            if one["bucket"] != bucket:
                out += finished(parts)
                bucket, parts = one["bucket"], []
            parts.append(one)
        yield _batch(out, _SUMS)
    yield _batch(finished(parts), _SUMS)


def _totals(table: pa.Table) -> pa.Table:
    """One block's documents. The rows of its sums are as many as it has buckets of rare pre-tokens."""
    found = table.to_pylist()
    own = next(r for r in found if r["doc_ids"] is not None)
    sums = np.frombuffer(own["sums"], "<i8").copy()
    for r in found:
        if r["rows"] is not None:
            sums[np.frombuffer(r["rows"], "<u2")] += np.frombuffer(r["sums"], "<u4")
    n = len(sums)
    nulls, doc_ids = np.frombuffer(own["doc_ids"][:n], "u1") == 1, np.frombuffer(own["doc_ids"][n:], "<i8")
    return pa.table({"doc_id": pa.array(doc_ids, mask=nulls), "n_bytes": np.frombuffer(own["n_bytes"], "<i8"), "n_tokens": sums})

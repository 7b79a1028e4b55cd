"""Packing of documents into fixed-length sequences, in the order of a space-filling curve through their content."""

from __future__ import annotations

import array
import gc
import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text as tx
from tablewright.llm import tokenizer
from tablewright.scratch import write_table

#: White-space separated words, and pre-tokens, whose ids a Python worker remembers; at most twice as many of each.
REMEMBERED_WORDS, REMEMBERED_PRETOKENS = 400_000, 400_000
#: Words whose ids are copied at a time; so few that the places stay in the cache of a core.
GATHERED_WORDS = 1 << 14


@dataclass(frozen=True)
class Packing:
    """Sequences of ``length`` ids; every document ends with ``end_id``.

    A document's ids are hashed into ``buckets`` counts, which a random matrix projects to ``dimensions`` numbers of
    ``bits`` bits, at most 62 together. ``task_tokens`` is about how many ids one task packs.
    The table of all ids is stored with ``codec`` (null: that of the session).
    """

    length: int = 4096
    end_id: int = 2
    buckets: int = 1024
    dimensions: int = 3
    bits: int = 16
    task_tokens: int = 4_000_000
    codec: str | None = None


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of whole points (rows of numbers below ``2**bits``), in any number of dimensions."""
    x = points.T.astype(np.uint64).copy()
    n = len(x)
    one = np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:
        p = q - one
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p).astype(np.uint64)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > one:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - one), t)
        q >>= one
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << one | (x[i] >> np.uint64(bit)) & one
    return key.astype(np.int64)


class _Words:
    """Words numbered as they come, with all their ids in one array: those of word i are ``ids[starts[i]:starts[i + 1]]``."""

    def __init__(self, kind: str):
        self.numbers: dict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids, self.starts = np.zeros(0, kind), np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of the next words."""
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])


def _ids_of(ids: np.ndarray, starts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of numbered words, one after the other, and how many each word has."""
    sizes = np.diff(starts)[words]
    out = [ids[:0]]
    for i in range(0, len(words), GATHERED_WORDS):
        n = sizes[i : i + GATHERED_WORDS]
        out.append(ids[np.repeat(starts[words[i : i + GATHERED_WORDS]] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
    return np.concatenate(out), sizes


class _Ids:
    """Ids of texts. The ids of words and of the pre-tokens in them are kept for the next texts."""

    def __init__(self, path: str):
        self.tok = tokenizer.load(path)
        self.narrow = self.tok.whole.get_vocab_size() <= 1 << 16
        self.kind = "<u2" if self.narrow else "<u4"
        self.words, self.old_words = _Words(self.kind), _Words(self.kind)
        self.pretokens, self.old_pretokens = {}, {}

    def __call__(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with ``end_id`` behind it, and how many every text has."""
        gc.disable()  # nothing here makes cycles, and each pass would walk all that is remembered
        try:
            return self._of(texts, end_id)
        finally:
            gc.enable()

    def _of(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        rows, number = [], self.words.numbers.__getitem__
        for text in texts:
            words = text.lower().split() if self.tok.plain(text) else None
            rows.append(words if words is None else np.fromiter(map(number, words), np.int32, len(words)))
        self._learn()
        known = self.words
        # The end id, and texts that are not plain, stand behind the words.
        extra = [np.array([end_id], self.kind)]
        end = np.array([len(known.numbers)], np.int32)
        for i, row in enumerate(rows):
            if row is None:
                rows[i] = end + len(extra)
                extra.append(np.frombuffer(self._whole(texts[i]), self.kind))
        starts = np.concatenate([known.starts, known.starts[-1] + np.cumsum([len(x) for x in extra])])
        out, sizes = _ids_of(np.concatenate([known.ids, *extra]), starts, np.concatenate([x for row in rows for x in (row, end)]))
        first = np.cumsum([0] + [len(row) + 1 for row in rows[:-1]])
        counts = np.add.reduceat(sizes, first)
        if len(known.numbers) > REMEMBERED_WORDS:
            self.words, self.old_words = _Words(self.kind), known
        if len(self.pretokens) > REMEMBERED_PRETOKENS:
            self.pretokens, self.old_pretokens = {}, self.pretokens
        return out, counts

    def _learn(self) -> None:
        """The ids of words that have a number and no ids yet."""
        known, old = self.words, self.old_words
        words = list(itertools.islice(known.numbers, len(known.starts) - 1, None))
        held = np.fromiter(map(old.numbers.get, words, itertools.repeat(-1)), np.int64, len(words))
        fresh = np.flatnonzero(held < 0)
        # A plain word of letters is one pre-token.
        parts = [(w,) if w.isalpha() else self.tok.pieces(w) for w in map(words.__getitem__, fresh.tolist())]
        missing = []
        for pretoken in set(itertools.chain.from_iterable(parts)).difference(self.pretokens):
            own = self.old_pretokens.get(pretoken)
            if own is None:
                missing.append(pretoken)
            else:
                self.pretokens[pretoken] = own
        for i in range(0, len(missing), 4096):
            part = missing[i : i + 4096]
            for pretoken, found in zip(part, self.tok.model.encode_batch_fast(part, add_special_tokens=False)):
                self.pretokens[pretoken] = self._packed(found.ids)
        get = self.pretokens.__getitem__
        new = [get(own[0]) if len(own) == 1 else b"".join(map(get, own)) for own in parts]
        sizes = np.fromiter(map(len, new), np.int64, len(new)) // np.dtype(self.kind).itemsize
        held[fresh] = len(old.starts) - 1 + np.arange(len(fresh))
        starts = np.concatenate([old.starts, old.starts[-1] + np.cumsum(sizes)])
        known.add(*_ids_of(np.concatenate([old.ids, np.frombuffer(b"".join(new), self.kind)]), starts, held))

    def _packed(self, ids: list[int]) -> bytes:
        return array.array("H" if self.narrow else "I", ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tok.whole.encode(text, add_special_tokens=False).ids)


_IDS: dict[str, _Ids] = {}


def placed(documents: DataFrame, spec: Packing, path: str, id_column: str, text: str) -> DataFrame:
    """Rows (doc_id, place, n_tokens, ids): a document's place on the curve and its ids, packed into bytes."""
    fields = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _IDS.setdefault(path, _Ids(path))
        vocabulary = ids_of.tok.whole.get_vocab_size()
        bucket = (tx.mix(np.arange(vocabulary), 51) % np.uint64(spec.buckets)).astype(np.int64)
        project = np.random.default_rng(52).standard_normal((spec.buckets, spec.dimensions)).astype(np.float32)[bucket]
        for batch in tx.slices(batches, "text", 2 << 20):
            values, n = ids_of([t or "" for t in batch.column(1).to_pylist()], spec.end_id)
            edges = pa.array(np.concatenate(([0], np.cumsum(n))) * values.itemsize, pa.int32())
            packed = pa.Array.from_buffers(pa.binary(), len(n), [None, edges.buffers()[1], pa.py_buffer(values.tobytes())])
            mean = np.add.reduceat(project[values], np.concatenate(([0], np.cumsum(n)[:-1])), axis=0) / n[:, None]
            cells = ((np.tanh(3 * mean) + 1) / 2 * (2**spec.bits - 1)).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hilbert_keys(cells, spec.bits)), pa.array(n), packed], schema=fields)

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(of, "doc_id long, place long, n_tokens long, ids binary")


def pack(documents: DataFrame, spec: Packing = Packing(), path: str | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) that fill sequences without gaps.

    Documents are ordered by their place on a Hilbert curve (then by id, so that copies don't crowd one task), dealt to
    tasks by ranges of that order, and laid end to end within a task; a document is cut where a sequence is full. What
    remains at a task's end is cut into sequences whose lengths are powers of two, which need no padding.
    A null or empty text has its end id alone; null doc_ids and repeated rows are packed like any others. ``ids`` holds
    the piece's ids as little-endian 32-bit numbers.
    """
    path = path or tokenizer.default_path()
    stored = write_table(placed(documents, spec, path, id_column, text), "placed", spec.codec)
    total = stored.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, -(-total // spec.task_tokens))
    # The seed of the order among equal places is the document itself, so a retried task deals alike.
    order = ["place", "doc_id", "n_tokens", "tie"]
    dealt = stored.withColumn("tie", F.xxhash64("ids")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kind = "<u2" if tokenizer.load(path).whole.get_vocab_size() <= 1 << 16 else "<u4"
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return dealt.select("doc_id", "ids").mapInArrow(lambda batches: _pieces(batches, spec.length, kind), schema)


def _pieces(batches: Iterator[pa.RecordBatch], length: int, kind: str) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    sequence, filled = TaskContext.get().partitionId() << 32, 0
    open_pieces: list[tuple] = []
    for batch in batches:
        done: list[tuple] = []
        for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.frombuffer(packed, kind)
            start = 0
            while start < len(ids):
                take = min(length - filled, len(ids) - start)
                open_pieces.append((doc_id, start, ids[start : start + take], len(ids), sequence, filled))
                start, filled = start + take, filled + take
                if filled == length:
                    done += open_pieces
                    open_pieces, filled, sequence = [], 0, sequence + 1
        if done:
            yield _rows(done, names, types)
    # The rest: sequences of falling powers of two.
    done, filled = [], 0
    left = sum(len(p[2]) for p in open_pieces)
    room = 1 << max(0, left.bit_length() - 1)
    for doc_id, start, ids, doc_tokens, _, _ in open_pieces:
        while len(ids):
            take = min(room - filled, len(ids))
            done.append((doc_id, start, ids[:take], doc_tokens, sequence, filled))
            ids, start, filled = ids[take:], start + take, filled + take
            if filled == room:
                left, filled, sequence = left - room, 0, sequence + 1
                room = 1 << max(0, left.bit_length() - 1)
    if done:
        yield _rows(done, names, types)


def _rows(pieces: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = [(d, s, len(i), i.astype("<u4").tobytes(), n, q, o) for d, s, i, n, q, o in pieces]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*columns), types)], names=names)


def piece_checksum(ids: str = "ids") -> F.Column:
    """The CRC-32 of a piece's ids as an unsigned number."""
    return F.crc32(F.col(ids))



"""Byte-pair encoding of texts by batched merge rounds, and decoding."""

from __future__ import annotations

import functools
import gc
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablewright.llm import text as tx
from tablewright.llm import tokenizer

#: A worker remembers the ids of so many words; then it starts anew and takes over what is used again.
REMEMBERED = 150_000
#: Pre-tokens are merged in lots of about so many symbols.
LOT_SYMBOLS = 1 << 17


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for themselves, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - len(shown)))
    return [out[b] for b in range(256)]


class Merges:
    """The merge table of a BPE file as sorted pair keys."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("ignore_merges") or spec.get("decoder"):
            raise ValueError(f"{path} doesn't encode or decode as this operator does")
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, product = (np.array(c, dtype=np.int64) for c in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs)))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        # Of a pair that is listed twice the last rank holds.
        ranks = dict(zip((left * self.size + right).tolist(), range(len(left))))
        self.keys = np.array(sorted(ranks), dtype=np.int64)
        self.ranks = np.array([ranks[k] for k in self.keys.tolist()], dtype=np.int64)
        self.products = product[self.ranks]
        suffix = model.get("end_of_word_suffix") or ""
        self.inner = np.array([vocab.get(c, -1) for c in byte_characters()], dtype=np.int64)
        self.last = np.array([vocab.get(c + suffix, -1) for c in byte_characters()], dtype=np.int64)
        if min(self.inner.min(), self.last.min()) < 0:
            raise ValueError(f"{path} lacks a symbol for some byte")
        # If a merge can only use products of earlier ones, all places of a word's lowest pair merge in one round.
        made = np.full(self.size, -1, dtype=np.int64)
        np.maximum.at(made, product, np.arange(len(product)))
        self.ordered = bool((np.maximum(made[left], made[right]) < np.arange(len(left))).all())

    def encode(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens in one flat array, and each pre-token's bounds in it."""
        ids, counts, lot, symbols = [], [], [], 0
        for word in map(str.encode, pretokens):
            lot.append(word)
            symbols += len(word)
            if symbols > LOT_SYMBOLS:
                own, n = self._merged(lot)
                ids.append(own)
                counts.append(n)
                lot, symbols = [], 0
        own, n = self._merged(lot)
        return np.concatenate([*ids, own]), np.concatenate(([0], np.cumsum(np.concatenate([*counts, n])))).astype(np.int64)

    def _merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbol, owner = self.inner[raw], np.repeat(np.arange(len(words)), lengths)
        ends = (np.cumsum(lengths) - 1)[lengths > 0]
        symbol[ends] = self.last[raw[ends]]
        done_symbols, done_owners = [], []
        while len(symbol):
            # The rank of each symbol with the next one of its word.
            key = symbol[:-1] * self.size + symbol[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.full(len(symbol), len(self.ranks), dtype=np.int64)
            rank[:-1] = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.ranks[at], rank[:-1])
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(first, append=len(owner))
            lowest = np.minimum.reduceat(rank, first)
            active = np.repeat(lowest < len(self.ranks), sizes)
            done_symbols.append(symbol[~active])
            done_owners.append(owner[~active])
            chosen = np.flatnonzero(active & (rank == np.repeat(lowest, sizes)))
            if self.ordered:
                # In a run of overlapping places every other one, from the left.
                run = np.flatnonzero(np.diff(chosen, prepend=-2) != 1)
                place = np.arange(len(chosen)) - np.repeat(run, np.diff(run, append=len(chosen)))
                chosen = chosen[place % 2 == 0]
            else:
                chosen = chosen[np.diff(owner[chosen], prepend=-1) > 0]
            symbol[chosen] = self.products[at[chosen]]
            active[chosen + 1] = False
            symbol, owner = symbol[active], owner[active]
        if not done_symbols:
            return np.zeros(0, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        symbols, owners = np.concatenate(done_symbols), np.concatenate(done_owners)
        return symbols[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))


class Encoder:
    """Ids of texts, as little-endian 32-bit numbers. Ids of words are kept for the next texts."""

    def __init__(self, path: str):
        self.split, self.merges = tokenizer.load(path), Merges(path)
        self.words, self.old = {}, {}
        self.special = {s: np.array([i], "<u4").tobytes() for s, i in self.merges.special.items()}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        gc.disable()  # nothing here makes cycles, and each pass would walk all that is remembered
        try:
            return self._of(texts)
        finally:
            gc.enable()

    def _of(self, texts: list[str | None]) -> list[bytes]:
        # Plain texts by white-space words, of which most are known as they stand; others by pre-tokens.
        plain = [not t or self.split.plain(t) for t in texts]
        words = [(t or "").lower().split() if p else [w for part in self.split.pretokens(t) for w in part] for t, p in zip(texts, plain)]
        self._learn({w for own, p in zip(words, plain) if p for w in own}, True)
        self._learn({w for own, p in zip(words, plain) if not p for w in own}, False)
        out = [b"".join(map(self.words.__getitem__, zip(own, (p,) * len(own)) if not p else own)) for own, p in zip(words, plain)]
        if len(self.words) > REMEMBERED:
            self.words, self.old = {}, self.words
        return out

    def _learn(self, words: set[str], cut: bool) -> None:
        """Ids of new words: cut into pre-tokens, or pre-tokens themselves (kept under another key, as they mean another cut)."""
        parts: dict = {}
        for word in words:
            key = word if cut else (word, False)
            if key not in self.words:
                if (own := self.old.get(key)) is not None:
                    self.words[key] = own
                elif not cut and word in self.special:
                    self.words[key] = self.special[word]
                else:
                    parts[key] = self.split.pieces(word) if cut else [word]
        new = list(dict.fromkeys(p for own in parts.values() for p in own))
        ids, bounds = self.merges.encode(new)
        packed, ends = ids.astype("<u4").tobytes(), (bounds * 4).tolist()
        known = {p: packed[a:b] for p, a, b in zip(new, ends, ends[1:])}
        for key, own in parts.items():
            self.words[key] = known[own[0]] if len(own) == 1 else b"".join(map(known.__getitem__, own))


@functools.lru_cache(maxsize=2)
def strings_of(path: str) -> list[bytes]:
    """The text of each id, special tokens included. All that decoding needs, so its workers hold nothing else."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    if spec.get("decoder"):
        raise ValueError(f"{path} doesn't decode as this operator does")
    known = {i: s for s, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [known.get(i, "").encode() for i in range(max(known) + 1)]


@functools.lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    return Encoder(path)


def encode(documents: DataFrame, path: str | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, and ids (little-endian unsigned 32-bit numbers in one binary).

    The ids are those of the tokenizer's library without added special tokens; special strings inside a text are special ids.
    Words are cut from whole texts; the pre-tokens of many texts that a worker doesn't know yet lie in one flat array, and
    in each round every pre-token's lowest-ranked pair, found by binary search over the sorted keys of all pairs, is merged at
    all its places. A null or empty text has no ids; null and repeated doc_ids have a row each. A very long text is a
    batch of its own; a very long run of one kind of character is one pre-token, as for the library, and takes as
    many rounds as it has different merges.
    """
    path = path or tokenizer.default_path()
    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        for part in tx.slices(batches, "text", 2 << 20):
            ids = encoder(part.column(1).to_pylist())
            columns = [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

    return source.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds ``decoded`` to rows with packed ``ids``: their text, special tokens included. No ids give an empty text."""
    path = path or tokenizer.default_path()
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = strings_of(path).__getitem__
        for batch in batches:
            for part in _slices(batch):
                # A file without a decoder has the ids' texts with a space between.
                texts = [b" ".join(map(text_of, np.frombuffer(i, "<u4").tolist())) if i is not None else None for i in part.column("ids").to_pylist()]
                decoded = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``limit`` bytes of ids, or of one row."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end

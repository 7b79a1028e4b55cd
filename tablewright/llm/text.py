"""Words, hashes and n-grams of whole Arrow columns of text, with numpy and without a loop over words.

A text column is one byte buffer with offsets. A word is a maximal run of bytes of one class inside one text; bytes above
0x7F always belong to words, so no character is cut. Hashes are 64-bit, equal on every machine and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = np.asarray(x, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_CODES = mix(np.arange(256), 101)[LOWER]
_BYTE_CODES_CASED = mix(np.arange(256), 101)
_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64), dtype=np.uint64)
_HIGH_POWERS = mix(np.arange(4096), 103) | np.uint64(1)
_HIGH_POWERS[0] = 1  # short words hash alike beside very long ones

#: Byte classes of words: letters and digits; anything but white space.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its texts; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of text, or of one row, so that scratch memory stays small."""
    for batch in batches:
        _, offsets = buffer(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def words(raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the bounds of each text in these arrays (one more entry than texts)."""
    inside = kind[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    at = edges[edges < len(raw)]
    first[at] = inside[at]
    at = edges[edges > 0] - 1
    last[at] = inside[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, cased: bool = False) -> np.ndarray:
    """A hash of each word's bytes, with A-Z as a-z unless ``cased``. Runs over chunks of whole words."""
    out = np.empty(len(starts), dtype=np.uint64)
    codes = _BYTE_CODES_CASED if cased else _BYTE_CODES
    begin = 0
    while begin < len(starts):
        end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + CHUNK)))
        base, stop = starts[begin], ends[end - 1]
        own = starts[begin:end] - base
        lengths = np.diff(own, append=stop - base)
        place = np.arange(stop - base) - np.repeat(own, lengths)
        weights = _POWERS[place & 4095]
        if place.max(initial=0) >= 4096:
            weights = weights * _HIGH_POWERS[(place >> 12) & 4095]
        values = codes[raw[base:stop]] * weights
        # What stands between words counts for nothing.
        values[place >= np.repeat(ends[begin:end] - starts[begin:end], lengths)] = 0
        out[begin:end] = np.add.reduceat(values, own)
        begin = end
    return mix(out + (ends - starts).astype(np.uint64), 7)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and the text's bounds in them.

    A text with fewer words has one shingle, of all its words; one without words has none.
    """
    counts = np.diff(bounds)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate(([0], np.cumsum(n)))
    first = np.repeat(bounds[:-1] - out_bounds[:-1], n) + np.arange(out_bounds[-1])
    length = np.repeat(np.minimum(counts, size), n)
    out = mix(length.astype(np.uint64), 11)
    for i in range(size):
        more = length > i
        step = mix(out ^ hashes[np.where(more, first + i, 0)], 13) if len(hashes) else out
        out = np.where(more, step, out)
    return out, out_bounds


def binary_keys(high: np.ndarray, low: np.ndarray) -> pa.Array:
    """Pairs of 64-bit numbers as 16-byte keys."""
    both = np.empty((len(high), 2), dtype=">u8")
    both[:, 0], both[:, 1] = high, low
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(high), [None, pa.py_buffer(both.tobytes())]).cast(pa.binary())


def lists(values: pa.Array, bounds: np.ndarray, large: bool = False) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), pa.int32()), values)

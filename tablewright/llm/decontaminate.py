"""Benchmark decontamination by latent semantic retrieval, with checks of common subsequences and answers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text as tx
from tablewright.scratch import write_table

#: A benchmark is a stated query set that every task holds; a larger one has to be given in parts.
MOST_ITEM_BYTES = 256 << 20


@dataclass(frozen=True)
class Decontamination:
    """Passages are windows of ``windows`` blocks of ``block`` words, one starting at every block.

    Longer items get windows of twice as many blocks, and twice again, up to the longest item; one starts at every quarter
    of these, is widened by a quarter, and is compared with items of more than a quarter of its words.

    A passage is a candidate for an item if the cosine of their TF-IDF vectors, both projected to the latent space of
    ``rank`` dimensions, reaches ``cosine``. The projection can't tell words that no item has; they count for nothing, however
    many there are. The passage, widened by a block on each side, is a leak if the longest common subsequence of words
    is at least ``common`` of the item, and at least ``answer`` of the item's answer: its last sentence, or its last
    quarter if it has one sentence. A verbatim copy of an item is a leak wherever it stands, whatever its cosine; items
    under ``least`` words are searched for in this way only.
    """

    block: int = 16
    windows: tuple[int, ...] = (1, 2, 4)
    rank: int = 128
    cosine: float = 0.5
    common: float = 0.6
    answer: float = 0.5
    least: int = 5


@dataclass(frozen=True)
class _Items:
    """The items' words as numbers of a vocabulary of sorted word hashes; answers are the words from ``answer_from`` on."""

    ids: list
    tokens: list[list[int]]
    answer_from: list[int]
    vocabulary: np.ndarray


def _items(benchmark: DataFrame, spec: Decontamination, id_column: str, text: str) -> _Items:
    rows = benchmark.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MOST_ITEM_BYTES:
        raise ValueError(f"the benchmark has {size} bytes; give it in parts of at most {MOST_ITEM_BYTES}")
    table = rows.distinct().sort("id", "text").toPandas()
    raw, offsets = tx.buffer(pa.array(table["text"].tolist(), pa.string()))
    starts, ends, bounds = tx.words(raw, offsets, tx.ALNUM)
    hashes = tx.word_hashes(raw, starts, ends)
    vocabulary = np.unique(hashes)
    numbers = np.searchsorted(vocabulary, hashes)
    ids, tokens, answers = [], [], []
    for i, name in enumerate(table["id"].tolist()):
        own = numbers[bounds[i] : bounds[i + 1]].tolist()
        if not own:
            continue
        content = table["text"][i].encode().rstrip(b" .!?\n")
        cut = max(content.rfind(b". "), content.rfind(b"? "), content.rfind(b"! "), content.rfind(b"\n"))
        before = int(np.searchsorted(starts[bounds[i] : bounds[i + 1]], offsets[i] + cut + 1)) if cut >= 0 else 0
        ids.append(name)
        tokens.append(own)
        answers.append(before if 0 < before < len(own) else len(own) - max(1, len(own) // 4))
    return _Items(ids, tokens, answers, vocabulary)


def _numbers(column: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The column's words as numbers of the vocabulary (-1 for others), and each text's bounds in them."""
    raw, offsets = tx.buffer(column)
    starts, ends, bounds = tx.words(raw, offsets, tx.ALNUM)
    hashes = tx.word_hashes(raw, starts, ends)
    gate = np.zeros(1 << 18, dtype=bool)
    gate[(vocabulary & np.uint64(0x3FFFF)).astype(np.int64)] = True
    out = np.full(len(hashes), -1, dtype=np.int32)
    if len(vocabulary):
        maybe = np.flatnonzero(gate[(hashes & np.uint64(0x3FFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(vocabulary, hashes[maybe]), len(vocabulary) - 1)
        hit = vocabulary[place] == hashes[maybe]
        out[maybe[hit]] = place[hit]
    return out, bounds


def _kind(items: _Items) -> str:
    """How word numbers are packed."""
    return "<i2" if len(items.vocabulary) < 1 << 15 else "<i4"


def numbered(source: DataFrame, items: _Items) -> DataFrame:
    """Rows (doc_id, words): every word of a text as its number in the vocabulary, packed; -1 for words that no item has.

    Stored, as all later passes read it and none has to cut and hash the words again.
    """
    kind = _kind(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            numbers, bounds = _numbers(batch.column(1), items.vocabulary)
            packed, edges = numbers.astype(kind).tobytes(), (bounds * np.dtype(kind).itemsize).tolist()
            words = pa.array([packed[a:b] for a, b in zip(edges, edges[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), words], names=["doc_id", "words"])

    return write_table(source.mapInArrow(run, "doc_id long, words binary"), "numbered")


def _read(batches: Iterator[pa.RecordBatch], kind: str, limit: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, word numbers and each text's bounds in them, for slices of at most ``limit`` words or of one text."""
    size = np.dtype(kind).itemsize
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(1)).to_numpy(zero_copy_only=False) // size
        bounds, start = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))), 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + limit, side="right")) - 1)
            words = b"".join(batch.column(1).slice(start, end - start).to_pylist())
            yield batch.column(0).slice(start, end - start), np.frombuffer(words, kind).astype(np.int32), bounds[start : end + 1] - bounds[start]
            start = end


def _blocks(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all blocks of ``size`` words, none across texts, and each text's bounds in the blocks."""
    n = -(-np.diff(bounds) // size)
    block_bounds = np.concatenate(([0], np.cumsum(n)))
    first = np.repeat(bounds[:-1], n) + (np.arange(block_bounds[-1]) - np.repeat(block_bounds[:-1], n)) * size
    return first, block_bounds


def _packed(values: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in values]


def _sum_rows(partials: DataFrame, width: int) -> np.ndarray:
    """The sum of packed matrices (rows: n, x) by row number; each row has ``width`` doubles."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<f8") for x in table["x"].to_pylist())
        return pa.table({"n": table["n"][:1], "x": pa.array([total.tobytes()], pa.binary())})

    # In two steps, so that no task gets the matrices of all tasks.
    few = partials.withColumn("part", F.pmod(F.xxhash64("x"), F.lit(64)).cast("int")).groupBy("n", "part").applyInArrow(add, "n int, x binary")
    table = few.groupBy("n").applyInArrow(add, "n int, x binary").toArrow()
    out = np.zeros((max(table["n"].to_pylist(), default=-1) + 1, width))
    for n, x in zip(table["n"].to_pylist(), table["x"].to_pylist()):
        out[n] = np.frombuffer(x, "<f8")
    return out


#: Words that are worked on at a time, and pairs of words that a task adds up before it multiplies them.
_WORDS_TOGETHER, _MOST_PAIRS = 1 << 18, 1 << 21


def _word_pairs(numbers: np.ndarray, bounds: np.ndarray, size: int, weights: np.ndarray, other: float, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the passages' Gram matrix, without the factors that only depend on their row or column.

    For all pairs of known words in a block of ``block`` words, the smaller one first, and for each word with itself: the
    number of the pair, and one over the block's squared length. Equal words at two places count twice, for both orders.
    """
    first, _ = _blocks(bounds, block)
    owner = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(first, append=len(numbers)))
    known = np.flatnonzero(numbers >= 0)
    squares = np.bincount(owner, weights=np.append(weights, other)[numbers], minlength=len(first))
    word, owner = numbers[known].astype(np.int64), owner[known]
    share = 1 / squares[owner]
    pairs, shares = [word * size + word], [share]
    for step in range(1, block):
        together = np.flatnonzero(owner[step:] == owner[:-step])
        if not len(together):
            break
        a, b = word[together], word[together + step]
        pairs.append(np.minimum(a, b) * size + np.maximum(a, b))
        shares.append(share[together] * np.where(a == b, 2.0, 1.0))
    return np.concatenate(pairs), np.concatenate(shares)


def _order(keys: np.ndarray) -> np.ndarray:
    """An order of whole numbers, by 16 bits at a time (numpy sorts these by counting)."""
    order, top = None, int(keys.max(initial=0))
    for shift in range(0, max(top.bit_length(), 1), 16):
        digit = (keys >> shift & 0xFFFF).astype(np.uint16)
        order = np.argsort(digit, kind="stable") if order is None else order[np.argsort(digit[order], kind="stable")]
    return order


def _added(pairs: list[np.ndarray], shares: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums by pair, in order of the pairs."""
    keys, values = np.concatenate(pairs), np.concatenate(shares)
    order = _order(keys)
    keys = keys[order]
    begin = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[begin], np.add.reduceat(values[order], begin) if len(begin) else values


def _multiply(pairs: np.ndarray, sums: np.ndarray, start: np.ndarray, out: np.ndarray) -> None:
    """Adds the product of the symmetric matrix of sums and ``start`` to ``out``."""
    low, high = np.divmod(pairs, len(start))
    apart = np.flatnonzero(low != high)
    mirrored = apart[_order(high[apart])]
    for row, column, share in ((low, high, sums), (high[mirrored], low[mirrored], sums[mirrored])):
        for at in range(0, len(row), 1 << 14):
            part = slice(at, at + (1 << 14))
            begin = np.flatnonzero(np.diff(row[part], prepend=-1))
            out[row[part][begin]] += np.add.reduceat(start[column[part]] * share[part, None].astype(np.float32), begin, axis=0)


#: Rows of the vocabulary that travel together when the tasks' matrices are added.
_ROWS_TOGETHER = 64


def latent_space(rows: DataFrame, items: _Items, spec: Decontamination) -> tuple[np.ndarray, np.ndarray]:
    """IDF weights of the vocabulary, and the leading right singular vectors of all passages.

    The passages are all blocks of the corpus, as TF-IDF vectors of length one over the items' words. One pass counts the
    texts that hold each word. A second one multiplies the passages' Gram matrix by a random matrix: each task adds up the
    entries of its own part of that matrix, by pairs of words that share a block, and multiplies them in bounded lots; rows of
    the products are added by Spark. From that sketch the Nystroem formula gives the singular vectors and
    values, so the corpus is read only once for them. What travels is vocabulary times rank per task, whatever the task reads.
    """
    size = len(items.vocabulary)

    kind = _kind(items)

    def texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(size, dtype=np.int64), 0
        for ids, numbers, bounds in _read(batches, kind, _WORDS_TOGETHER):
            owner = np.repeat(np.arange(len(ids)), np.diff(bounds))
            known = numbers >= 0
            once = np.unique(owner[known] * size + numbers[known]) % size
            held += np.bincount(once, minlength=size)
            n += len(ids)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([*some.tolist(), -1], pa.int32()), pa.array([*held[some].tolist(), n], pa.int64())], names=["n", "texts"])

    counts = rows.mapInArrow(texts_with, "n int, texts long").groupBy("n").agg(F.sum("texts").alias("texts")).toArrow()
    found = dict(zip(counts["n"].to_pylist(), counts["texts"].to_pylist()))
    total = found.pop(-1, 0)
    texts = np.zeros(size)
    texts[list(found)] = list(found.values())
    idf = np.log((1 + total) / (1 + texts)) + 0.1
    other = float(np.log(1 + total) + 0.1)
    rank = min(spec.rank, size)
    random = np.random.default_rng(41).standard_normal((size, rank))
    start, weights = (idf[:, None] * random).astype(np.float32), idf**2

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, pairs, shares, waiting = np.zeros((size, rank)), [], [], 0

        def summed(whole: bool) -> None:
            """Adds up what waits, and multiplies it if it is much, or at the end."""
            nonlocal pairs, shares, waiting
            keys, sums = _added(pairs, shares)
            if whole or len(keys) > _MOST_PAIRS // 2:
                _multiply(keys, sums, start, out)
                keys, sums = keys[:0], sums[:0]
            pairs, shares, waiting = [keys], [sums], len(keys)

        for _, numbers, bounds in _read(batches, kind, _WORDS_TOGETHER):
            more, own = _word_pairs(numbers, bounds, size, weights, other**2, spec.block)
            pairs.append(more)
            shares.append(own)
            waiting += len(more)
            if waiting > _MOST_PAIRS:
                summed(False)
        if waiting:
            summed(True)
        out *= idf[:, None]
        some = [i for i in range(0, size, _ROWS_TOGETHER) if out[i : i + _ROWS_TOGETHER].any()]
        parts = [np.pad(out[i : i + _ROWS_TOGETHER], ((0, max(0, i + _ROWS_TOGETHER - size)), (0, 0))) for i in some]
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([i // _ROWS_TOGETHER for i in some], pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["n", "x"])

    summed = _sum_rows(rows.mapInArrow(product, "n int, x binary"), _ROWS_TOGETHER * rank).reshape(-1, rank)
    sketch = np.zeros((size, rank))
    sketch[: min(size, len(summed))] = summed[:size]
    core = random.T @ sketch
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(initial=0), 1e-12) * 1e-9
    left, _, _ = np.linalg.svd(sketch @ vectors[:, good] / np.sqrt(values[good]), full_matrices=False)
    return idf, left


def _subsequence(item: list[int], passage: list[int], least: float = 0) -> list[bool]:
    """Which words of the item stand in a longest common subsequence with the passage (bit-parallel rows, then a walk back).

    No word if there are fewer than ``least``. Only some rows are kept; the walk makes those between them again.
    """
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1

    def after(row: int, word: int) -> int:
        match = row & places.get(word, 0)
        return ((row + match) | (row - match)) & full

    step = isqrt(len(passage)) + 1
    row, kept = full, [full]
    for j, word in enumerate(passage, 1):
        row = after(row, word)
        if j % step == 0:
            kept.append(row)
    used = [False] * len(item)
    if len(item) - row.bit_count() < least:
        return used
    # A zero bit i of a row means that item[:i + 1] has a longer common part with what was read than item[:i].
    i, j = len(item), len(passage)
    start, rows = j + 1, []
    while i and j:
        if j <= start:
            start = (j - 1) // step * step
            rows = [kept[start // step]]
            for word in passage[start : min(start + step, len(passage))]:
                rows.append(after(rows[-1], word))
        if rows[j - start] >> i - 1 & 1:
            i -= 1
        elif not rows[j - start - 1] >> i - 1 & 1:
            j -= 1
        elif item[i - 1] == passage[j - 1]:
            used[i - 1] = True
            i, j = i - 1, j - 1
        else:
            j -= 1
    return used


#: Blocks whose windows are compared at a time, and about how many cells their table of words may have.
_BLOCKS_TOGETHER, _MOST_CELLS = 4096, 1 << 25


@dataclass(frozen=True)
class _Filter:
    """Bounds for the search that lose no leak, at any counts of texts.

    ``words`` and ``times`` are each item's distinct words and their counts, the rarest first. ``rare`` are its rarest words
    (each as often as the item has it), one item after the other from ``starts`` on: more than a leak may lack, so that a
    passage needs at least ``needed`` of them. ``windows`` reach to the longest item. Copies of item ``anchored[k]`` hold the
    words of number ``anchors[k]`` (two of its words, the rarest that stand together) at its word ``places[k]``.
    """

    lengths: np.ndarray
    words: list[np.ndarray]
    times: list[np.ndarray]
    rare: np.ndarray
    starts: np.ndarray
    needed: list[int]
    windows: list[int]
    anchors: np.ndarray
    anchored: np.ndarray
    places: np.ndarray


def _filter(items: _Items, idf: np.ndarray, spec: Decontamination) -> _Filter:
    words, times, rare, needed = [], [], [], []
    for tokens in items.tokens:
        own, n = np.unique(tokens, return_counts=True)
        order = np.argsort(-idf[own], kind="stable")
        own, n = own[order], n[order]
        lacks = int(len(tokens) - spec.common * len(tokens) + 1e-9)
        rare.append(np.repeat(own, n)[: lacks + 1 + len(tokens) // 5])
        needed.append(len(rare[-1]) - lacks)
        words.append(own)
        times.append(n)
    starts = np.concatenate(([0], np.cumsum([len(r) for r in rare])))
    lengths = np.array([len(t) for t in items.tokens])
    windows = sorted(spec.windows)
    while windows[-1] * spec.block < lengths.max():
        windows.append(windows[-1] * 2)
    anchors, places = [], []
    for tokens in items.tokens:
        weight = idf[tokens]
        at = int(np.argmax(weight[:-1] + weight[1:])) if len(tokens) > 1 else 0
        places.append(at)
        anchors.append(_pair(tokens[at], tokens[at + 1] if len(tokens) > 1 else -1, len(idf)))
    order = np.argsort(anchors, kind="stable")
    return _Filter(lengths, words, times, np.concatenate(rare), starts, needed, windows, np.array(anchors)[order], order, np.array(places)[order])


def _pair(word, following, size: int):
    """A number for two words; -1 as the second one stands for any."""
    return word * (size + 1) + following + 1


def _copies(numbers: np.ndarray, bounds: np.ndarray, items: _Items, keep: _Filter) -> set[tuple[int, int]]:
    """The rows and numbers of all items that stand verbatim in a row's words."""
    size = len(items.vocabulary)
    starting = np.zeros(size + 1, dtype=bool)
    starting[keep.anchors // (size + 1)] = True
    at = np.flatnonzero(starting[numbers])
    word, following = numbers[at].astype(np.int64), np.append(numbers, -1)[at + 1]
    out = set()
    for second in (following, np.full(len(at), -1)):
        # Where no known word follows, both looks are the same.
        pair = _pair(word, second, size)
        low, high = np.searchsorted(keep.anchors, pair), np.searchsorted(keep.anchors, pair, side="right")
        for i in np.flatnonzero(high > low).tolist():
            row = int(np.searchsorted(bounds, at[i], side="right")) - 1
            for k in range(low[i], high[i]):
                item = int(keep.anchored[k])
                start, length = int(at[i]) - int(keep.places[k]), int(keep.lengths[item])
                if (row, item) not in out and start >= bounds[row] and start + length <= bounds[row + 1]:
                    if numbers[start : start + length].tolist() == items.tokens[item]:
                        out.add((row, item))
    return out


def _search(numbers: np.ndarray, bounds: np.ndarray, items: _Items, project: np.ndarray, queries: np.ndarray, keep: _Filter, spec: Decontamination) -> dict[tuple[int, int], tuple]:
    """The leaks in texts of numbered words: of a row and an item's number the best (common, answer, cosine)."""
    first, block_bounds = _blocks(bounds, spec.block)
    best: dict[tuple[int, int], tuple] = {key: (1.0, 1.0, float(queries[key[1]].any())) for key in _copies(numbers, bounds, items, keep)}
    searched = keep.lengths >= spec.least
    most = max(1, keep.windows[-1] // 4)
    known = np.concatenate(([0], np.cumsum(numbers >= 0)))
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(block_bounds))
    edges = np.append(first, len(numbers))
    together = max(256, min(_BLOCKS_TOGETHER, _MOST_CELLS // len(items.vocabulary)))
    for base in range(0, len(first), together):
        stop = min(base + together, len(first))
        low, high = max(0, base - most), min(stop + keep.windows[-1] + most, len(first))
        word = numbers[edges[low] : edges[high]]
        block = np.repeat(np.arange(high - low), np.diff(edges[low : high + 1]))[word >= 0]
        held, word = np.unique(word[word >= 0], return_inverse=True)
        # A table of the words that the blocks hold, with an empty line for all others.
        table = np.zeros((len(held) + 1, high - low), dtype=bool)
        table[word, block] = True
        line = np.full(len(items.vocabulary), len(held))
        line[held] = np.arange(len(held))
        alive = np.flatnonzero(searched & np.logical_or.reduceat(line[keep.rare] < len(held), keep.starts[:-1]))
        windows = []
        for n in keep.windows:
            own, step = np.arange(base, stop), max(1, n // 4)
            if n > max(spec.windows):
                own = own[(own - block_bounds[owner[own]]) % step == 0]
            begin, last = block_bounds[owner[own]], block_bounds[owner[own] + 1]
            end = np.minimum(own + n, last)
            wide_from, wide_to = np.maximum(own - step, begin), np.minimum(end + step, last)
            # No common subsequence is longer than the known words around. A rest of a text of half as many blocks is a window
            # of these already.
            room = np.where(end - own > n // 2, known[edges[wide_to]] - known[edges[wide_from]], 0)
            windows.append((0 if n <= max(spec.windows) else n * spec.block // 4, own, end, wide_from, wide_to, room))
        # The windows of every block share their starts: around all of them stands what any one of them can hold.
        shared = [w for w in windows if w[0] == 0]
        around_from, around_to = np.minimum.reduce([w[3] for w in shared]) - low, np.maximum.reduce([w[4] for w in shared]) - low
        for item in alive.tolist():
            lines = line[keep.words[item]]
            rare = line[keep.rare[keep.starts[item] : keep.starts[item + 1]]]
            rare = rare[rare < len(held)]
            if len(rare) < keep.needed[item]:
                continue
            met = np.concatenate(([0], np.cumsum(table[rare].sum(axis=0, dtype=np.int32))))
            near = np.flatnonzero(met[around_to] - met[around_from] >= keep.needed[item])
            for shortest, at, end, wide_from, wide_to, room in windows:
                if keep.lengths[item] <= shortest:
                    break
                rows = near if shortest == 0 else np.arange(len(at))
                rows = rows[(met[wide_to[rows] - low] - met[wide_from[rows] - low] >= keep.needed[item]) & (room[rows] >= spec.common * keep.lengths[item])]
                if len(rows):
                    rows = rows[_shared(table, lines, wide_from[rows] - low, wide_to[rows] - low, keep.times[item]) >= spec.common * keep.lengths[item]]
                for i in rows.tolist():
                    inner = numbers[edges[at[i]] : edges[end[i]]]
                    vector = project[inner[inner >= 0]].sum(axis=0)
                    cosine = float(vector @ queries[item] / max(np.linalg.norm(vector), 1e-12))
                    if cosine < spec.cosine:
                        continue
                    used = _subsequence(items.tokens[item], numbers[edges[wide_from[i]] : edges[wide_to[i]]].tolist(), spec.common * keep.lengths[item])
                    common = sum(used) / len(used)
                    cut = items.answer_from[item]
                    answer = sum(used[cut:]) / (len(used) - cut)
                    if common >= spec.common and answer >= spec.answer:
                        key = int(owner[at[i]]), item
                        best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (common, answer, cosine))
    return best


def _shared(table: np.ndarray, lines: np.ndarray, begin: np.ndarray, end: np.ndarray, times: np.ndarray) -> np.ndarray:
    """How many of an item's words (lines of the table, each so many times) the blocks from ``begin`` to ``end`` hold."""
    held = table[lines[:, None], begin]
    for k in range(1, int((end - begin).max())):
        held |= table[lines[:, None], np.minimum(begin + k, end - 1)]
    return times.astype(np.float32) @ held.astype(np.float32)


def leaks(
    documents: DataFrame, benchmark: DataFrame, spec: Decontamination = Decontamination(), id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per document and item that leaked into it: doc_id, item_id, cosine, common, answer (the best of its passages).

    Words are runs of letters, digits and non-ASCII characters, A-Z as a-z. Every passage of every whole text is compared
    with every item; only passages with too few of an item's words for any common subsequence that counts are left out
    first, which loses none. Null and empty texts, items without words or id, and rows without a doc_id match nothing;
    rows that share a doc_id give the best of their rows; other columns are ignored.
    """
    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    source = source.where("doc_id IS NOT NULL AND text IS NOT NULL")
    schema = "doc_id long, item_id long, cosine double, common double, answer double"
    items = _items(benchmark, spec, item_id, item_text)
    if not items.ids:
        return source.sparkSession.createDataFrame([], schema)
    rows, kind = numbered(source, items), _kind(items)
    idf, space = latent_space(rows, items, spec)
    project = (idf[:, None] * space).astype(np.float32)
    queries = np.stack([project[t].sum(axis=0) for t in items.tokens])
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-12)
    own = source.sparkSession.sparkContext.broadcast((items, project, queries.astype(np.float32), _filter(items, idf, spec)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, project, queries, keep = own.value
        for ids, numbers, bounds in _read(batches, kind, _WORDS_TOGETHER):
            best = _search(numbers, bounds, items, project, queries, keep, spec)
            if best:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[r].as_py() for r, _ in best], pa.int64()), pa.array([items.ids[i] for _, i in best], pa.int64()),
                        pa.array([x[2] for x in best.values()]), pa.array([x[0] for x in best.values()]), pa.array([x[1] for x in best.values()]),
                    ],
                    names=["doc_id", "item_id", "cosine", "common", "answer"],
                )

    found = rows.mapInArrow(search, schema)
    best = F.max(F.struct("common", "answer", "cosine")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.cosine", "best.common", "best.answer")

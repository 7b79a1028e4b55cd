"""Near-duplicate documents by SuperMinHash signatures, banding, verification on full sets, and connected groups."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text as tx
from tablewright.llm.graph import components
from tablewright.scratch import write_table


@dataclass(frozen=True)
class NearDuplicates:
    """``shingle`` words a shingle; documents link at ``percent`` % Jaccard similarity or more.

    A signature has ``bands * rows`` slots. With the defaults a pair at exactly 80 % shares no band with probability 5e-5.
    Every pair that shares a band is verified, unless its groups are joined already. ``tile`` bounds the documents that one
    task compares at a time.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 25
    rows: int = 5
    tile: int = 1024

    @property
    def slots(self) -> int:
        return self.bands * self.rows


def super_minhash(hashes: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """Signatures of the sets ``hashes[bounds[i]:bounds[i+1]]``, one row each; an empty set's row is all ones.

    Round j gives every element a random number in [j, j+1) and the j-th place of its own random permutation of the slots,
    which keeps the least number it meets. A set whose slots are all filled stops: later rounds have only larger numbers.
    Only elements of unfinished sets carry their permutation on.
    """
    n = len(bounds) - 1
    signature = np.full(n * slots, np.iinfo(np.uint64).max, dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    places = None
    for j in range(slots):
        if not len(hashes):
            break
        drawn = tx.mix(hashes, 1000 + j)
        value = np.uint64(j << 40) | (drawn >> np.uint64(24))
        other = j + (((drawn & np.uint64(0xFFFFFF)) * np.uint64(slots - j)) >> np.uint64(24)).astype(np.int64)
        if places is None:
            place = other
        else:
            index = np.arange(len(hashes))
            place = places[index, other].astype(np.int64)
            places[index, other] = places[:, j]
            places[:, j] = place
        np.minimum.at(signature, owner * slots + place, value)
        open_sets = (signature.reshape(n, slots) == np.iinfo(np.uint64).max).any(axis=1)
        stay = open_sets[owner]
        if places is None:
            if stay.any():
                hashes, owner, other = hashes[stay], owner[stay], other[stay]
                places = np.tile(np.arange(slots, dtype=np.uint16), (len(hashes), 1))
                index = np.arange(len(hashes))
                places[index, other] = 0
                places[:, 0] = other
            else:
                break
        elif not stay.all():
            hashes, owner, places = hashes[stay], owner[stay], places[stay]
    return signature.reshape(n, slots)


def _sets(batch: pa.RecordBatch, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the batch's column ``text``, and the bounds of each row in them."""
    raw, offsets = tx.buffer(batch.column(batch.schema.get_field_index("text")))
    starts, ends, bounds = tx.words(raw, offsets, tx.NON_SPACE)
    hashes, bounds = tx.shingles(tx.word_hashes(raw, starts, ends), bounds, shingle)
    found = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return (np.concatenate(found) if found else hashes), np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int64)


def _set_keys(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A 128-bit key of each set, whatever its order; null for an empty one."""
    sums = []
    for seed in (21, 22):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tx.mix(hashes, seed), dtype=np.uint64)))
        sums.append(tx.mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64), seed))
    keys = tx.binary_keys(*sums)
    return pa.array([k.as_py() if n else None for k, n in zip(keys, np.diff(bounds))], pa.binary())


def fingerprints(documents: DataFrame, spec: NearDuplicates, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, key, signature): the set's size, its 128-bit key and its signature of 8-byte slots."""
    fields = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            hashes, bounds = _sets(batch, spec.shingle)
            signature = super_minhash(hashes, bounds, spec.slots)
            full = np.diff(bounds) > 0
            band = tx.mix(np.broadcast_to(np.arange(spec.bands, dtype=np.uint64), (len(full), spec.bands)), 31)
            for i in range(spec.rows):
                band = tx.mix(band ^ signature[:, i :: spec.rows][:, : spec.bands], 32)
            band_bounds = np.concatenate(([0], np.cumsum(full * spec.bands)))
            # The low 16 bits of a slot tell equal slots from others but for 1 in 65,536.
            short = np.ascontiguousarray(signature.astype("<u2"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64()),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    _set_keys(hashes, bounds),
                    tx.lists(pa.array(band[full].reshape(-1).view(np.int64)), band_bounds),
                    pa.array([s.tobytes() if f else None for s, f in zip(short, full)], pa.binary()),
                ],
                schema=fields,
            )

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(of, "doc_id long, n_shingles long, key binary, bands array<long>, signature binary")


def near_duplicates(documents: DataFrame, spec: NearDuplicates = NearDuplicates(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, key, component_id, kept.

    Equal sets are one class, so copies cost one row of counting each. Classes that share a band meet in that band's
    bucket. In every bucket each class is compared with two leaders: the class met most often over all buckets (the source
    of a family of copies), and the smallest. Buckets whose classes are then still in different groups have all their
    pairs across groups compared inside tasks, in tiles of bounded size. A link counts only if the full sets reach the threshold.

    A null text is empty. An empty set links with nothing: component_id is its own doc_id. A null doc_id takes no part:
    component_id null, kept true. Rows that share a doc_id are compared each with its own text. Other columns are ignored.
    """
    prints = write_table(fingerprints(documents, spec, id_column, text), "fingerprints")
    whole = prints.where("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = whole.groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature")
    )
    classes = write_table(classes, "classes")
    links = write_table(_links(documents, classes, spec, id_column, text), "near-links")
    groups = components(links)
    ids = classes.select("key", "first_id")
    in_groups = groups.join(ids, groups.node == ids.key)
    roots = in_groups.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = in_groups.join(roots, "root").select("key", "component_id")
    ids = ids.join(members, "key", "left").select("key", F.coalesce("component_id", "first_id").alias("component_id"))
    found = prints.select("doc_id", "n_shingles", "key").join(ids, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", "key", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _links(documents: DataFrame, classes: DataFrame, spec: NearDuplicates, id_column: str, text: str) -> DataFrame:
    met = classes.select("key", "n", F.posexplode("bands").alias("band", "bucket"))
    sizes = met.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    met = write_table(met.join(sizes, "bucket"), "buckets")
    ranks = met.groupBy("key").agg(F.sum("members").alias("degree"))
    ranked = met.join(ranks, "key")
    leaders = ranked.groupBy("bucket").agg(
        F.max_by(F.struct("key", "n"), F.struct("degree", "key")).alias("x"), F.min_by(F.struct("key", "n"), "key").alias("y")
    )
    pairs = (
        met.join(leaders, "bucket")
        .select("key", "n", F.explode(F.array("x", "y")).alias("other"))
        .select(F.least("key", "other.key").alias("a"), F.greatest("key", "other.key").alias("b"), F.col("n").alias("p"), F.col("other.n").alias("q"))
        .where(f"a <> b AND 100 * least(p, q) >= {spec.percent} * greatest(p, q)")
        .select("a", "b")
        .distinct()
    )
    first = write_table(_verified(documents, classes, write_table(pairs, "star-pairs"), spec, id_column, text), "star-links")
    groups = components(first)
    grouped = met.join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    divided = grouped.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    rest = write_table(grouped.join(divided, "bucket"), "divided")
    sets = _full_sets(documents, classes, rest.select("key").distinct(), spec, id_column, text).drop("n")
    more = _across(rest.join(classes.select("key", "signature"), "key").join(sets, "key"), spec)
    return first.unionByName(more).distinct()


def _across(rest: DataFrame, spec: NearDuplicates) -> DataFrame:
    """Links (a, b) between classes of one bucket but different groups.

    Every bucket is cut into tiles of about ``spec.tile`` classes; each pair of tiles is one group of rows for one task.
    Only pairs across groups are looked at, and not again once their groups are joined; a pair that meets in several buckets
    is looked at in its first band alone. Every such pair is verified on full sets at once, so that only links leave the task.
    """
    tiles = F.ceil(F.col("members") / spec.tile).cast("int")
    own = F.pmod(F.xxhash64("key"), tiles).cast("int")
    columns = ["bucket", "band", "key", "n", "root", "signature", "elements"]
    placed = rest.select(*columns, own.alias("tile"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("facing"))
    placed = placed.withColumns({"x": F.least("tile", "facing"), "y": F.greatest("tile", "facing")}).drop("facing")

    def compare(table: pa.Table) -> pa.Table:
        keys, sides, n = table["key"].to_pylist(), table["tile"].to_numpy(), table["n"].to_numpy()
        elements = table["elements"].combine_chunks()
        bounds, values = elements.offsets.to_numpy(), elements.values.to_numpy()
        _, group = np.unique(np.array(table["root"].to_pylist(), dtype=object), return_inverse=True)
        signatures = np.stack([np.frombuffer(s, dtype="<u2") for s in table["signature"].to_pylist()])
        x, y, band = (table[c][0].as_py() for c in ("x", "y", "band"))
        right = np.flatnonzero(sides != x) if x != y else np.arange(len(keys))

        out_a, out_b = [], []
        for i in np.flatnonzero(sides == x):
            near = right[right > i] if x == y else right
            near = near[group[near] != group[i]]
            near = near[100 * np.minimum(n[near], n[i]) >= spec.percent * np.maximum(n[near], n[i])]
            if not len(near):
                continue
            equal = (signatures[near] == signatures[i]).reshape(len(near), spec.bands, spec.rows).all(axis=2)
            near = near[equal.argmax(axis=1) == band]
            mine = values[bounds[i] : bounds[i + 1]]
            for j in near:
                if group[i] == group[j]:
                    continue
                theirs = values[bounds[j] : bounds[j + 1]]
                common = len(np.intersect1d(mine, theirs, assume_unique=True))
                if 100 * common >= spec.percent * (n[i] + n[j] - common):
                    group[group == group[j]] = group[i]
                    out_a.append(min(keys[i], keys[j]))
                    out_b.append(max(keys[i], keys[j]))
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})

    return placed.groupBy("bucket", "x", "y").applyInArrow(compare, "a binary, b binary")


def _full_sets(documents: DataFrame, classes: DataFrame, keys: DataFrame, spec: NearDuplicates, id_column: str, text: str) -> DataFrame:
    """Rows (key, n, elements): the full sets of some classes, built again from the texts of their first documents."""
    needed = classes.select("key", F.col("first_id").alias("id")).join(keys, "key")
    source = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    fields = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("elements", pa.list_(pa.int64()))])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            hashes, bounds = _sets(batch, spec.shingle)
            own, expected = _set_keys(hashes, bounds), batch.column(batch.schema.get_field_index("key"))
            # A repeated doc_id may stand for several texts; only the class's own text counts.
            same = pa.compute.fill_null(pa.compute.equal(own, expected.cast(pa.binary())), False)
            out = pa.RecordBatch.from_arrays([own, pa.array(np.diff(bounds).astype(np.int64)), tx.lists(pa.array(hashes.view(np.int64)), bounds)], schema=fields)
            yield out.filter(same)

    found = source.join(needed, "id").select("key", "text").mapInArrow(of, "key binary, n long, elements array<long>")
    return write_table(found, "sets")


def _verified(documents: DataFrame, classes: DataFrame, pairs: DataFrame, spec: NearDuplicates, id_column: str, text: str) -> DataFrame:
    """The pairs whose full sets reach the threshold. Only documents that stand in a pair have their sets built again."""
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    sets = _full_sets(documents, classes, keys, spec, id_column, text)
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("p"), F.col("elements").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("q"), F.col("elements").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    both = pairs.join(right, "b").join(left, "a").withColumn("common", common)
    return both.where(100 * F.col("common") >= spec.percent * (F.col("p") + F.col("q") - F.col("common"))).select("a", "b").distinct()

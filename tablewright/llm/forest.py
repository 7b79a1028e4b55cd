"""Near-duplicate vectors from a forest of random-projection trees with overlapping leaves."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text as tx
from tablewright.llm.graph import components
from tablewright.llm.labelled import bounded
from tablewright.scratch import write_table


@dataclass(frozen=True)
class Forest:
    """``trees`` trees, split at the median of random projections until ``leaf`` vectors of the sample are left.

    A vector within ``spill`` of a split goes to both sides. The trees are fitted on about ``sample`` vectors and hold all.
    ``tile`` bounds the vectors that one task compares at a time.
    """

    threshold: float = 0.93
    trees: int = 10
    leaf: int = 96
    spill: float = 0.02
    sample: int = 32_768
    tile: int = 1024


def _unit(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, and which rows have one: not null, not zero, all components finite."""
    flat = column.flatten()
    lengths = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), 0))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    width = width or (int(lengths.max()) if len(lengths) else 0)
    out, good = np.zeros((len(lengths), width)), np.zeros(len(lengths), dtype=bool)
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        part = values[bounds[rows][:, None] + np.arange(n)]
        # Scaled first, so that very large or small components neither overflow nor vanish.
        with np.errstate(all="ignore"):
            top = np.abs(part).max(axis=1)
            fine = np.isfinite(part).all(axis=1) & (top > 0)
            part = part / np.where(fine, top, 1)[:, None]
            part /= np.linalg.norm(part, axis=1)[:, None]
        good[rows] = fine
        out[rows[fine], :n] = part[fine]
    return out, good


def _grow(sample: np.ndarray, spec: Forest) -> list[dict]:
    """Trees as arrays: of every inner node the direction, the threshold and the two children (leaves: -1 - leaf)."""
    rng = np.random.default_rng(91)
    forest, leaves = [], 0
    for _ in range(spec.trees):
        directions, cuts, children, todo = [], [], [], [(np.arange(len(sample)), None)]
        root = 0
        while todo:
            rows, parent = todo.pop()
            me = None
            if len(rows) > spec.leaf:
                direction = rng.standard_normal(sample.shape[1])
                direction /= np.linalg.norm(direction)
                along = sample[rows] @ direction
                cut = float(np.median(along))
                left = along < cut
                # Equal vectors can't be split.
                if 0 < left.sum() < len(rows):
                    me = len(directions)
                    directions.append(direction)
                    cuts.append(cut)
                    children.append([0, 0])
                    todo += [(rows[left], (me, 0)), (rows[~left], (me, 1))]
            if me is None:
                me, leaves = -1 - leaves, leaves + 1
            if parent is None:
                root = me
            else:
                children[parent[0]][parent[1]] = me
        forest.append({"w": np.array(directions).reshape(len(directions), sample.shape[1]), "cut": np.array(cuts), "to": np.array(children, dtype=np.int64).reshape(-1, 2), "root": root})
    return forest


def _route(x: np.ndarray, forest: list[dict], spill: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of row and leaf, sorted; leaves of earlier trees have smaller numbers."""
    rows, leaves = [], []
    for tree in forest:
        at = np.arange(len(x))
        node = np.full(len(x), tree["root"])
        while len(at):
            done = node < 0
            rows.append(at[done])
            leaves.append(-1 - node[done])
            at, node = at[~done], node[~done]
            side = np.einsum("ij,ij->i", x[at], tree["w"][node]) - tree["cut"][node]
            left, right = side < spill, side >= -spill
            at, node = np.concatenate((at[left], at[right])), np.concatenate((tree["to"][node[left], 0], tree["to"][node[right], 1]))
    rows, leaves = np.concatenate(rows), np.concatenate(leaves)
    order = np.lexsort((leaves, rows))
    return rows[order], leaves[order]


def near_vectors(vectors: DataFrame, spec: Forest = Forest(), id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors of equal, non-null labels link at a cosine of ``threshold`` or more, in double precision. Equal vectors are one
    class. Every class goes through all trees to its leaves; inside a leaf all pairs are compared, large leaves in pairs
    of tiles. A pair that shares several leaves is counted in the first of them alone, so counts need no list of pairs, and a
    task hands on only a spanning forest of the links it found.

    A null label, or a vector that is null, empty, zero or holds a null or non-finite component, links with nothing:
    n_links 0, component_id its own vec_id, kept. A null vec_id takes no part: component_id null, kept. Rows that share a
    vec_id count as one vector where their vectors are equal. Vectors of other lengths are compared as if zero-filled.
    """
    source = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).cast("string").alias("label"))
    fields = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("key", pa.binary()), ("v", pa.list_(pa.float64()))])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, good = _unit(batch.column(1))
            # 128 bits of the components; -0.0 is 0.0.
            hashes = [np.zeros(len(good), np.uint64), np.zeros(len(good), np.uint64)]
            for j in range(unit.shape[1]):
                part = np.ascontiguousarray(unit[:, j] + 0.0).view(np.uint64)
                used = part != 0
                hashes = [np.where(used, tx.mix(h ^ tx.mix(part, 92 + j), 93 + i), h) for i, h in enumerate(hashes)]
            names = [x.as_py() if x.is_valid else "" for x in batch.column(2)]
            raw, offsets = tx.buffer(pa.array(names, pa.string()))
            starts = offsets[:-1]
            by_label = np.zeros(len(good), np.uint64)
            some = np.diff(offsets) > 0
            if some.any():
                by_label[some] = tx.word_hashes(raw, starts[some], offsets[1:][some], cased=True)
            keys = tx.binary_keys(*[tx.mix(h ^ by_label, 95 + i) for i, h in enumerate(hashes)])
            use = good & np.asarray(pa.compute.is_valid(batch.column(2))) & np.asarray(pa.compute.is_valid(batch.column(0)))
            keys = pa.compute.if_else(pa.array(use), keys, pa.scalar(None, pa.binary()))
            kept = unit[use]
            v = tx.lists(pa.array(kept.reshape(-1)), np.concatenate(([0], np.cumsum(use * unit.shape[1]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), keys, v], schema=fields)

    rows = write_table(source.mapInArrow(keyed, "vec_id long, label string, key binary, v array<double>"), "vectors")
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count_distinct("vec_id").alias("members"), F.min("vec_id").alias("first_id")
    )
    classes = write_table(classes, "vector-classes")
    width = classes.agg(F.max(F.size("v"))).first()[0] or 1
    # The bounded sample that the trees are fitted on.
    sample = bounded(classes.select("key", "v"), "key", spec.sample).sort("key").select("v").toArrow()["v"].combine_chunks()
    sample = sample.combine_chunks() if isinstance(sample, pa.ChunkedArray) else sample
    forest = rows.sparkSession.sparkContext.broadcast(_grow(_unit(sample, width)[0], spec))
    spill, tile = spec.spill, spec.tile

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                at, leaves = _route(_unit(batch.column(2), width)[0], forest.value, spill)
                bounds = np.searchsorted(at, np.arange(batch.num_rows + 1))
                own = tx.lists(pa.array(leaves.astype(np.int32)), bounds)
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), own], names=["key", "label", "v", "members", "leaves"])

    placed = classes.select("key", "label", "v", "members").mapInArrow(place, "key binary, label string, v array<double>, members long, leaves array<int>")
    placed = write_table(placed, "placed-vectors")
    each = placed.select("key", "label", "members", "leaves", "v", F.explode("leaves").alias("leaf"))
    sizes = placed.select("label", F.explode("leaves").alias("leaf")).groupBy("label", "leaf").agg(F.count("*").alias("size")).where("size > 1")
    tiles = F.ceil(F.col("size") / tile).cast("int")
    dealt = each.join(sizes, ["label", "leaf"]).withColumns({"tile": F.pmod(F.xxhash64("key"), tiles).cast("int"), "facing": F.explode(F.sequence(F.lit(0), tiles - 1))})
    dealt = dealt.withColumns({"x": F.least("tile", "facing"), "y": F.greatest("tile", "facing")}).drop("size", "facing")
    threshold = spec.threshold

    def compare(table: pa.Table) -> pa.Table:
        keys, members = table["key"].to_pylist(), table["members"].to_numpy()
        unit = _unit(table["v"].combine_chunks(), width)[0]
        x, y, leaf = (table[c][0].as_py() for c in ("x", "y", "leaf"))
        held = table["leaves"].to_pylist()
        leaves = np.full((len(keys), max(map(len, held))), -1, dtype=np.int64)
        for i, own in enumerate(held):
            leaves[i, : len(own)] = own
        sides = table["tile"].to_numpy()
        left = np.flatnonzero(sides == x)
        right = left if x == y else np.flatnonzero(sides != x)
        links = np.zeros(len(keys), dtype=np.int64)
        root = np.arange(len(keys))
        out_a, out_b = [], []

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        for start in range(0, len(left), 256):
            part = left[start : start + 256]
            i, j = np.nonzero(unit[part] @ unit[right].T >= threshold)
            a, b = part[i], right[j]
            if x == y:
                a, b = a[b > a], b[b > a]
            # Only pairs whose first common leaf is this one.
            open_pairs, mine = np.arange(len(a)), np.zeros(len(a), dtype=bool)
            for k in range(leaves.shape[1]):
                first = leaves[a[open_pairs], k]
                common = (first >= 0) & (leaves[b[open_pairs]] == first[:, None]).any(axis=1)
                mine[open_pairs[common]] = first[common] == leaf
                open_pairs = open_pairs[~common]
                if not len(open_pairs):
                    break
            a, b = a[mine], b[mine]
            np.add.at(links, a, members[b])
            np.add.at(links, b, members[a])
            for p, q in zip(a.tolist(), b.tolist()):
                p_root, q_root = find(p), find(q)
                if p_root != q_root:
                    root[max(p_root, q_root)] = min(p_root, q_root)
                    out_a.append(keys[p])
                    out_b.append(keys[q])
        linked = np.flatnonzero(links)
        return pa.table(
            {
                "a": pa.array([keys[i] for i in linked] + out_a, pa.binary()),
                "b": pa.array([None] * len(linked) + out_b, pa.binary()),
                "n": pa.array([*links[linked].tolist(), *[0] * len(out_a)], pa.int64()),
            }
        )

    found = write_table(dealt.groupBy("label", "leaf", "x", "y").applyInArrow(compare, "a binary, b binary, n long"), "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    groups = components(found.where("b IS NOT NULL").select("a", "b")).join(classes.select(F.col("key").alias("node"), "first_id"), "node")
    roots = groups.groupBy("root").agg(F.min("first_id").alias("component"))
    members = groups.join(roots, "root").select(F.col("node").alias("key"), "component")
    known = classes.select("key", "members", "first_id").join(counts, "key", "left").join(members, "key", "left")
    known = known.select("key", (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("links"), F.coalesce("component", "first_id").alias("component"))
    out = rows.select("vec_id", "key").join(known, "key", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

"""Fitted trees as a table of nodes: importances, and the predictions of smaller models that lie inside a larger one."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tablewright import scratch


def tree_nodes(spark: SparkSession, model: Model) -> DataFrame:
    """One row per node of a fitted tree, forest or boosted classifier, from its stored form.

    ``tree`` counts from 0 in order of fitting and has a ``weight``; node 0 is its root. An inner node has children
    ``left`` and ``right`` and sends rows left whose slot ``feature`` is at most ``threshold`` or among ``categories``;
    ``gain`` is its gain in purity, and ``rows`` the weighted number of training rows that reached it; ``statistics`` has
    a classifier's rows per class.
    """
    path = scratch.new_path(spark, "trees")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    if "nodeData" in stored.columns:
        # One row per tree: a bounded broadcast.
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "settings", "weight").drop("settings")
        stored = stored.select(F.col("treeID").alias("tree"), "nodeData.*").join(F.broadcast(weights), "tree")
    else:
        stored = stored.withColumns({"tree": F.lit(0), "weight": F.lit(1.0)})
    return _nodes(stored, isinstance(model, GBTClassificationModel))


def store_tree(spark: SparkSession, model: Model, tree: int) -> str:
    """Store a forest of a single tree as number ``tree`` of a forest, for ``stored_tree_nodes``."""
    path = scratch.new_path(spark, f"tree-{tree}")
    model.write().save(path)
    return path


def stored_tree_nodes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The nodes of a forest whose trees were stored one by one, as ``tree_nodes`` gives them; all are read at once."""
    stored = spark.read.parquet(*[f"{path}/data" for path in paths])
    number = F.regexp_extract("_metadata.file_path", "/tree-([0-9]+)-[0-9a-f]+/data/[^/]*$", 1).cast("int")
    return _nodes(stored.select(number.alias("tree"), F.lit(1.0).alias("weight"), "nodeData.*"), False)


def _nodes(stored: DataFrame, boosted: bool) -> DataFrame:
    # A classifier's statistics are rows per class; those of boosted (regression) trees begin with the number of rows.
    statistics = F.col("impurityStats")
    rows = statistics[0] if boosted else F.aggregate(statistics, F.lit(0.0), lambda total, n: total + n)
    inner, by_threshold = F.col("leftChild") >= 0, F.col("split.numCategories") == -1
    values = F.col("split.leftCategoriesOrThreshold")
    return stored.select(
        "tree",
        "weight",
        F.col("id").alias("node"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & by_threshold, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & ~by_threshold, values).alias("categories"),
        F.when(inner, F.col("gain")).alias("gain"),
        rows.alias("rows"),
        statistics.alias("statistics"),
        "prediction",
    )


def slot_importance(nodes: DataFrame, each_tree_alike: bool) -> DataFrame:
    """Importance per feature slot that any node splits by: gains weighted by rows, shares of 1 in all.

    ``each_tree_alike`` gives every tree the same say, as forests have it; boosted trees count by their gains.
    """
    gains = nodes.where(F.col("left").isNotNull()).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    # Models have few trees and slots: both totals are small tables.
    if each_tree_alike:
        whole = gains.groupBy("tree").agg(F.sum("gain").alias("whole"))
        gains = gains.join(F.broadcast(whole), "tree").select("feature", (F.col("gain") / F.col("whole")).alias("gain"))
    by_slot = gains.groupBy("feature").agg(F.sum("gain").alias("gain"))
    total = by_slot.agg(F.sum("gain").alias("total"))
    return by_slot.crossJoin(F.broadcast(total)).select(F.col("feature").alias("idx"), (F.col("gain") / F.col("total")).alias("importance"))


def cut_prediction(nodes: Sequence[Row], features: str, depth: int) -> Column:
    """What a single tree fitted to ``depth`` levels predicts, from one of more levels.

    A tree is grown level by level, and its splits don't depend on how deep it may grow; so the
    shallower tree is the upper part of the deeper one.
    """
    return F.expr(_case(_by_node(nodes)[0], 0, features, depth)).cast("double")


def first_rounds_prediction(nodes: Sequence[Row], features: str, rounds: int) -> Column:
    """What a boosted classifier of ``rounds`` rounds predicts, from one of more rounds (its first trees are the same)."""
    trees = _by_node(nodes)
    weights = {r["tree"]: r["weight"] for r in nodes}
    terms = [f"{weights[t]!r}D * ({_case(trees[t], 0, features, None)})" for t in sorted(trees)[:rounds]]
    return (F.expr(" + ".join(terms)) > 0).cast("double")


def forest_predictions(df: DataFrame, features: str, nodes: Sequence[Row], depths: Mapping[str, int]) -> DataFrame:
    """Add what a forest cut at some depths predicts, one column per depth.

    As Spark's forests do, each tree votes with the shares of the classes in a row's leaf, and the first class with the
    most votes wins. ``features`` is an array of slots, each a number or one category's 0 or 1.
    """
    trees = [tree for _, tree in sorted(_by_node(nodes).items())]
    cut = {name: [_cut_arrays(tree, depth) for tree in trees] for name, depth in depths.items()}
    schema = StructType([*df.schema.fields, *[StructField(name, DoubleType()) for name in cut]])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            rows = batch.column(features).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            found = [pa.array(sum(_votes(tree, rows) for tree in of).argmax(1).astype(float)) for of in cut.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *cut])

    return df.mapInArrow(predict, schema)


def slots(vector: str) -> Column:
    """A feature vector as the array that predictions made here read."""
    return vector_to_array(vector)


def _by_node(nodes: Sequence[Row]) -> dict[int, dict[int, Row]]:
    out: dict[int, dict[int, Row]] = {}
    for row in nodes:
        out.setdefault(row["tree"], {})[row["node"]] = row
    return out


def _case(tree: dict[int, Row], node: int, features: str, depth: int | None) -> str:
    """A tree, or its upper ``depth`` levels, as nested CASE expressions over an array of slots."""
    row = tree[node]
    if row["left"] is None or depth == 0:
        return f"{row['prediction']!r}D"
    slot = f"`{features}`[{row['feature']}]"
    if row["threshold"] is not None:
        test = f"{slot} <= {row['threshold']!r}D"
    else:
        test = f"{slot} IN ({', '.join(f'{c!r}D' for c in row['categories'])})"
    below = None if depth is None else depth - 1
    left, right = (_case(tree, row[side], features, below) for side in ("left", "right"))
    return f"CASE WHEN {test} THEN {left} ELSE {right} END"


def _cut_arrays(tree: Mapping[int, Row], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The upper ``depth`` levels of a tree as arrays over its nodes: slot, threshold, children, shares of classes; and its levels.

    Leaves are their own children. Leaves of one parent that predict the same are merged, as Spark does.
    """
    size = max(tree) + 1
    slot, threshold, children = np.zeros(size, int), np.zeros(size), np.repeat(np.arange(size)[:, None], 2, 1)
    shares = np.zeros((size, len(tree[0]["statistics"])))
    level, leaves = {0: 0}, {}
    for node, row in sorted(tree.items()):  # parents have smaller numbers than their children
        if row["left"] is not None:
            level[row["left"]] = level[row["right"]] = level[node] + 1
    for node, row in sorted(tree.items(), reverse=True):
        counts = np.array(row["statistics"])
        shares[node] = counts / (counts.sum() or 1.0)
        below = (row["left"], row["right"])
        if row["left"] is None or level[node] >= depth or leaves.get(below[0], -1) == leaves.get(below[1], -2):
            leaves[node] = row["prediction"]
            continue
        # A slot of one category holds 0 or 1.
        by_threshold = row["threshold"] is not None
        slot[node], threshold[node] = row["feature"], row["threshold"] if by_threshold else 0.5
        children[node] = below if by_threshold or row["categories"] == [0.0] else below[::-1]
    return slot, threshold, children, shares, min(depth, max(level.values()))


def _votes(tree: tuple, rows: np.ndarray) -> np.ndarray:
    """Shares of the classes in the leaf of each row."""
    slot, threshold, children, shares, levels = tree
    place, node = np.arange(len(rows)), np.zeros(len(rows), int)
    for _ in range(levels):
        node = children[node, (rows[place, slot[node]] > threshold[node]).astype(int)]
    return shares[node]

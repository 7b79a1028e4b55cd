"""Classifier families, their grids, cross-validation and selection of the best model."""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tablewright import scratch
from tablewright.operators.cells import MAX_BINS, bin_bounds, binned, complete, with_bootstraps
from tablewright.operators.encode import FeatureSpec, feature_stages, fit_features
from tablewright.operators.sampling import SAMPLE_SEED, with_fold
from tablewright.operators.trees import (
    cut_prediction,
    first_rounds_prediction,
    forest_predictions,
    slots,
    store_tree,
    stored_tree_nodes,
    tree_nodes,
)

CLASSIFIERS = {
    "GBTClassifier": GBTClassifier,
    "RandomForest": RandomForestClassifier,
    "DecisionTree": DecisionTreeClassifier,
    "LogisticRegression": LogisticRegression,
}

# The families in order of preference on a tie, the grid of each, and the folds.
GRIDS: dict[str, dict[str, list]] = {
    "GBTClassifier": {"maxDepth": [3, 5], "maxIter": [10, 20]},
    "RandomForest": {"numTrees": [20, 50], "maxDepth": [5, 7, 10]},
    "DecisionTree": {"maxDepth": [5, 7, 10]},
    "LogisticRegression": {"regParam": [0.01, 0.1]},
}
FOLDS = 3

# Training rows in one partition.
ROWS_PER_PART = 50_000
# Rows beyond which equal ones are counted for trees, and how many must share a cell on average.
COUNT_BEYOND = 200_000
ROWS_PER_CELL = 4
BOOSTED, FOREST = "GBTClassifier", "RandomForest"
# Of these parameters, models with smaller values lie inside the one with the largest.
NESTED = {BOOSTED: "maxIter", FOREST: "maxDepth", "DecisionTree": "maxDepth"}
# Parameters that weigh rows by their weight alone; others look at single rows or choose the bins.
BY_WEIGHT = {"maxDepth", "maxIter", "numTrees", "stepSize", "impurity", "minInfoGain"}
WEIGHT, TREE = "_weight", "_tree"

TUNING_SCHEMA = "family string, family_rank int, point int, params string, fold int, f1 double"


@dataclass(frozen=True)
class TrainingSpec:
    """What to learn from: features, label, and the row key that places rows in folds and partitions.

    ``parallelism`` models are fitted at a time; a partition holds about ``rows_per_part`` rows. In tables of more than
    ``count_beyond`` rows, trees are tuned on counts of equal rows where there are many.
    """

    features: FeatureSpec
    label: str
    key: str
    folds: int = FOLDS
    grids: Mapping[str, Mapping[str, Sequence]] = field(default_factory=lambda: GRIDS)
    parallelism: int = 8
    rows_per_part: int = ROWS_PER_PART
    count_beyond: int = COUNT_BEYOND

    @property
    def columns(self) -> list[str]:
        """What training reads."""
        return list(dict.fromkeys([self.key, self.label, *self.features.numeric, *self.features.categorical]))


def classifier(family: str, label: str, features: str = "features", **params) -> Estimator:
    return CLASSIFIERS[family](labelCol=label, featuresCol=features, **params)


def param_maps(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of a grid, as parameter maps of the estimator."""
    builder = ParamGridBuilder()
    for name, options in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def fit_family(df: DataFrame, spec: TrainingSpec, family: str, **params) -> PipelineModel:
    """Fit the feature stages and one classifier as one saved-together model."""
    stages = [*feature_stages(spec.features), classifier(family, spec.label, spec.features.output, **params)]
    return Pipeline(stages=stages).fit(spread(df.select(*spec.columns), spec.key, spec.rows_per_part))


def parts_of(n_rows: int, rows_per_part: int = ROWS_PER_PART) -> int:
    """How many partitions a training table gets: by its rows alone, not by cores, files or settings."""
    return max(1, math.ceil(n_rows / rows_per_part))


def spread(df: DataFrame, key: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The rows laid out in partitions of about ``rows_per_part`` rows, by hashes of the rows, ordered by key inside each.

    A forest draws its samples by row position, so the layout must depend on neither the machine nor the input's files:
    the number of partitions follows from a count of the rows, and a row's place from its key and a second hash over all
    its columns. So rows of one hot key, or of none, are spread over all partitions; only rows that are equal
    in every column stay together. Fitting passes over the rows many times, so the one shuffle pays off.
    """
    salt = F.xxhash64(*[F.col(c) for c in df.columns])
    parts = parts_of(df.count(), rows_per_part)
    return df.withColumn("_salt", salt).repartition(parts, key, "_salt").sortWithinPartitions(key, "_salt").drop("_salt")


@dataclass(frozen=True)
class _Fold:
    """A fold's rows to fit and to score, as (label, features, ``WEIGHT``), and the same as counted cells, if there are few."""

    number: int
    rows: tuple[DataFrame, DataFrame]
    cells: tuple[DataFrame, DataFrame] | None
    n_cells: int


def cross_validate(df: DataFrame, spec: TrainingSpec) -> DataFrame:
    """F1 of every family, grid point and fold, as a table.

    Per fold the feature stages are fitted once, on the fold's training rows, and shared by all
    grid points; a cross validator around the whole pipeline would fit them again for each point.
    The rows are laid out once; what a fold's models read is made before they are fitted, several at a
    time over all folds and points. Points whose model lies inside another one's are not fitted: the first rounds of a
    boosted model, and the upper levels of a tree or of a forest's trees, are read from the larger model's nodes.

    Trees see a number only as the bin it falls in. In a table of more than ``count_beyond`` rows, where many rows share
    bins, categories and label, they are fitted and scored on one row per such cell, weighted by its count: the cells
    don't grow in number with the table. A forest's trees are fitted one by one there, each on its own bootstrap.
    """
    spark, fits = df.sparkSession, _fits(spec)
    folded = with_fold(spread(df.select(*spec.columns), spec.key, spec.rows_per_part), spec.key, spec.folds).persist()
    held = [folded]

    def stored(part: DataFrame) -> DataFrame:
        held.append(part.persist())
        part.count()
        return part

    def prepare(number: int) -> _Fold:
        training = folded.where(F.col("fold") != number)
        encode = fit_features(training, spec.features)
        columns = [spec.label, spec.features.output]
        parts = [encode.transform(part).select(*columns, F.lit(1).alias(WEIGHT)) for part in (training, folded.where(F.col("fold") == number))]
        cells = _cells(folded, number, n_rows, encode, spec) if sum(n_rows.values()) > spec.count_beyond else None
        if cells is None:
            return _Fold(number, (stored(parts[0]), stored(parts[1])), None, 0)
        cells = stored(cells)
        trees = [c for c in cells.columns if c.startswith(f"{TREE}_")]
        inside = cells.where("inside > 0").select(*columns, F.col("inside").alias(WEIGHT), *trees)
        outside = cells.where("outside > 0").select(*columns, F.col("outside").alias(WEIGHT))
        # Only logistic regression reads the rows then; it stores blocks of its own.
        return _Fold(number, (parts[0], parts[1]), (inside, outside), cells.count())

    def f1(scored: DataFrame) -> float:
        evaluator = MulticlassClassificationEvaluator(labelCol=spec.label, predictionCol="prediction", weightCol=WEIGHT, metricName="f1")
        return float(evaluator.evaluate(scored))

    def fitted(family: str, inside: DataFrame, n_cells: int, weight: str = WEIGHT, **params) -> Model:
        if n_cells:
            # Spark looks at no more than maxBins squared rows for the bins; it has to find the bins of all cells.
            params["maxBins"] = max(MAX_BINS, math.ceil(math.sqrt(n_cells)))
        return classifier(family, spec.label, spec.features.output, weightCol=weight, **params).fit(inside)

    def score(points: list[tuple], fold: _Fold) -> list[float]:
        (_, family, _, largest), *smaller = points
        inside, outside = fold.cells if _counted(points, fold) else fold.rows
        model = fitted(family, inside, fold.n_cells if _counted(points, fold) else 0, **largest)
        if smaller and family == FOREST:
            return forest_scores(points, outside, tree_nodes(spark, model).collect())
        found = [f1(model.transform(outside))]
        if smaller:
            nodes = tree_nodes(spark, model).collect()
            name, predict = NESTED[family], first_rounds_prediction if NESTED[family] == "maxIter" else cut_prediction
            rows = outside.select(spec.label, slots(spec.features.output).alias("slots"), WEIGHT)
            found += [f1(rows.withColumn("prediction", predict(nodes, "slots", chosen[name]))) for *_, chosen in smaller]
        return found

    def grow(points: list[tuple], fold: _Fold, tree: int) -> str:
        """One tree of the forest of these points, stored."""
        chosen, drawn = points[0][3], _tree_column(points, tree)
        # A tree by itself would look at all features in each node, and as one of several at some.
        subset = "sqrt" if _trees_of(points) > 1 else "all"
        alone = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": subset, "seed": zlib.crc32(f"{fold.number} {drawn}".encode())}
        model = fitted(FOREST, fold.cells[0].where(F.col(drawn) > 0), fold.n_cells, drawn, **chosen | alone)
        return store_tree(spark, model, tree)

    def forest_scores(points: list[tuple], outside: DataFrame, nodes: list[Row]) -> list[float]:
        rows = outside.select(spec.label, WEIGHT, slots(spec.features.output).alias("slots"))
        depths = {f"point_{p[2]}": classifier(*p[1:2], spec.label, **p[3]).getMaxDepth() for p in points}
        counts = forest_predictions(rows, "slots", nodes, depths).groupBy(spec.label, *depths).agg(F.sum(WEIGHT).alias(WEIGHT))
        counts = stored(counts)  # at most one row per label and predictions
        return [f1(counts.withColumnRenamed(name, "prediction")) for name in depths]

    try:
        n_rows = {r["fold"]: r["count"] for r in complete(folded, spec.features).groupBy("fold").count().collect()}
        with ThreadPool(spec.parallelism) as pool:
            folds = pool.map(prepare, range(spec.folds), chunksize=1)
            # The longest chains of jobs first, then fold by fold, so that few models that read rows run at the same time.
            order = sorted(((points, fold) for fold in folds for points in fits), key=lambda task: task[0][0][1] != BOOSTED)
            running = [
                (points, fold, [pool.apply_async(grow, (points, fold, tree)) for tree in range(_trees_of(points))])
                if _counted(points, fold) and points[0][1] == FOREST
                else (points, fold, pool.apply_async(score, (points, fold)))
                for points, fold in order
            ]
            rows = []
            for points, fold, result in running:
                if isinstance(result, list):
                    nodes = stored_tree_nodes(spark, [tree.get() for tree in result])
                    scores = forest_scores(points, fold.cells[1], nodes.collect())
                else:
                    scores = result.get()
                rows += [(family, rank, point, json.dumps(chosen), fold.number, f) for (rank, family, point, chosen), f in zip(points, scores, strict=True)]
    finally:
        for part in held:
            part.unpersist()
    return spark.createDataFrame(rows, TUNING_SCHEMA)


def tuning_table(scores: DataFrame) -> DataFrame:
    """Mean F1 over the folds per family and grid point."""
    return scores.groupBy("family", "family_rank", "point", "params").agg(F.avg("f1").alias("f1"))


def best_per_family(tuned: DataFrame) -> DataFrame:
    """The best grid point of each family; a tie takes the earlier point."""
    order = Window.partitionBy("family").orderBy(F.desc("f1"), "point")
    return tuned.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == 1).drop("_n")


def best_model(tuned: DataFrame) -> DataFrame:
    """The best grid point of all; a tie takes the earlier family, then the earlier point."""
    rank = F.struct("f1", -F.col("family_rank"), -F.col("point"))
    return tuned.agg(F.max_by(F.struct("family", "params", "f1"), rank).alias("best")).select("best.*")


def best_params(best: DataFrame) -> DataFrame:
    """Parameters of the best model as ``param, value`` rows."""
    return best.select(F.explode(F.from_json("params", "map<string,double>")).alias("param", "value"))


def fit_best(df: DataFrame, spec: TrainingSpec, best: DataFrame) -> PipelineModel:
    """Fit the winning family and parameters on all training rows."""
    row = best.first()
    return fit_family(df, spec, row["family"], **json.loads(row["params"]))


def _grid_points(spec: TrainingSpec) -> list[tuple]:
    """(family rank, family, point, parameters), the slowest families first."""
    points = []
    for rank, (family, grid) in enumerate(spec.grids.items()):
        estimator = classifier(family, spec.label)
        for point, chosen in enumerate(param_maps(estimator, grid)):
            points.append((rank, family, point, {p.name: v for p, v in chosen.items()}))
    return points


def _fits(spec: TrainingSpec) -> list[list[tuple]]:
    """Grid points by the model that gives them: the point that is fitted, then those that lie inside it."""
    groups: dict[tuple, list[tuple]] = {}
    for rank, family, point, chosen in _grid_points(spec):
        name = NESTED.get(family)
        others = tuple(sorted((k, v) for k, v in chosen.items() if k != name))
        alone = None if name in chosen else point
        groups.setdefault((rank, others, alone), []).append((rank, family, point, chosen))
    return [sorted(own, key=lambda p: -p[3].get(NESTED.get(p[1]), 0)) for own in groups.values()]


def _counted(points: list[tuple], fold: _Fold) -> bool:
    """Whether the model of these points is fitted on the fold's cells."""
    family, chosen = points[0][1], points[0][3]
    return fold.cells is not None and family in NESTED and set(chosen) <= BY_WEIGHT


def _trees_of(points: list[tuple]) -> int:
    return classifier(FOREST, "", **points[0][3]).getNumTrees()


def _tree_column(points: list[tuple], tree: int) -> str:
    return f"{TREE}_{points[0][2]}_{tree}"


def _cells(folded: DataFrame, number: int, n_rows: Mapping[int, int], encode: PipelineModel, spec: TrainingSpec) -> DataFrame | None:
    """One row per bins, categories and label, with its rows ``inside`` and ``outside`` of training and each tree's bootstrap.

    None if the cells are too many for counting to pay.
    """
    in_training = F.col("fold") != number
    bounds = bin_bounds(folded.where(in_training), spec.features, sum(n for fold, n in n_rows.items() if fold != number))
    keys = [*spec.features.numeric, *spec.features.categorical, spec.label]
    rows = binned(folded, spec.features, bounds, spec.label, "fold")
    if rows.agg(F.approx_count_distinct(F.xxhash64(*keys))).first()[0] * ROWS_PER_CELL > sum(n_rows.values()):
        return None
    counts = [F.count_if(in_training).alias("inside"), F.count_if(~in_training).alias("outside")]
    cells = spread(scratch.write_table(rows.groupBy(*keys).agg(*counts), "cells"), spec.label, spec.rows_per_part)
    forests = [points for points in _fits(spec) if points[0][1] == FOREST]
    trees = [_tree_column(points, tree) for points in forests for tree in range(_trees_of(points))]
    drawn = encode.transform(with_bootstraps(cells, "inside", trees, SAMPLE_SEED + number))
    return scratch.write_table(drawn.select(spec.label, spec.features.output, "inside", "outside", *trees), "drawn-cells")

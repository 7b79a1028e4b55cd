import dataclasses

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tablewright.operators import cells, encode, trees, tuning
from tablewright.operators.sampling import with_fold

SPEC = encode.FeatureSpec(numeric=("x", "z"), categorical=("c",))
GRIDS = {
    "GBTClassifier": {"maxDepth": [2], "maxIter": [2, 4]},
    "RandomForest": {"numTrees": [3], "maxDepth": [2, 4]},
    "DecisionTree": {"maxDepth": [1, 5]},
    "LogisticRegression": {"regParam": [0.01]},
}


@pytest.fixture(scope="module")
def many(spark):
    """6,000 rows of a number with many values, one with few, some of them 0 or missing, and a gappy category."""
    rows = spark.range(6000).select(
        "id",
        F.expr("CASE WHEN id % 50 = 0 THEN NULL WHEN id % 51 = 0 THEN DOUBLE('NaN') ELSE pmod(hash(id), 4001) / 400D - 5 END").alias("x"),
        F.expr("CAST(pmod(hash(id, 3), 3) AS INT)").alias("z"),
        F.expr("CASE pmod(hash(id, 7), 4) WHEN 0 THEN 'u' WHEN 1 THEN 'v' WHEN 2 THEN 'w' END").alias("c"),
    )
    return rows.withColumn("y", F.expr("CAST(coalesce(nanvl(x, 0), 0) + z + CASE WHEN c = 'u' THEN 1.5 ELSE 0 END + pmod(hash(id, 9), 100) / 40 > 2 AS DOUBLE)")).cache()


@pytest.fixture(scope="module")
def spec():
    return tuning.TrainingSpec(features=SPEC, label="y", key="id", grids=GRIDS, count_beyond=0)


def built_in(df, family, points):
    model = tuning.classifier(family, "y")
    validator = CrossValidator(
        estimator=Pipeline(stages=[*encode.feature_stages(SPEC), model]), estimatorParamMaps=tuning.param_maps(model, points),
        evaluator=MulticlassClassificationEvaluator(labelCol="y", metricName="f1"), numFolds=3, foldCol="fold", parallelism=8,
    )
    return validator.fit(with_fold(df, "id", 3)).avgMetrics


def test_trees_on_counted_rows_score_as_the_built_in_cross_validator(many, spec, monkeypatch):
    sizes, plain = {}, tuning.classifier

    def watched(family, *args, **params):
        estimator = plain(family, *args, **params)
        fit = estimator.fit

        def counting(df, *rest):
            sizes.setdefault(family, []).append(df.count())
            return fit(df, *rest)

        estimator.fit = counting
        return estimator

    monkeypatch.setattr(tuning, "classifier", watched)
    found = tuning.tuning_table(tuning.cross_validate(many, spec)).collect()
    monkeypatch.undo()
    ours = {f: [r["f1"] for r in sorted(found, key=lambda r: r["point"]) if r["family"] == f] for f in GRIDS}
    for family in ("GBTClassifier", "DecisionTree", "LogisticRegression"):
        assert ours[family] == pytest.approx(built_in(many, family, GRIDS[family]))
    # 32 bins, 3 numbers, 4 categories with the missing one, 2 labels; no tree is fitted on single rows.
    assert max(n for f, all_sizes in sizes.items() if f != "LogisticRegression" for n in all_sizes) <= 32 * 3 * 4 * 2
    assert len(sizes["RandomForest"]) == 9 and len(sizes["DecisionTree"]) == 3
    # A forest has draws of its own.
    assert ours["RandomForest"] == pytest.approx(built_in(many, "RandomForest", GRIDS["RandomForest"]), abs=0.06)


def test_parameters_that_look_at_single_rows_are_fitted_on_rows(many, spec):
    points = {"DecisionTree": {"minInstancesPerNode": [40], "maxDepth": [3]}, "RandomForest": {"maxBins": [8], "numTrees": [3], "maxDepth": [2, 3]}}
    found = tuning.tuning_table(tuning.cross_validate(many, dataclasses.replace(spec, grids={"DecisionTree": points["DecisionTree"]}))).collect()
    assert [r["f1"] for r in found] == pytest.approx(built_in(many, "DecisionTree", points["DecisionTree"]))
    assert len(tuning.tuning_table(tuning.cross_validate(many, dataclasses.replace(spec, grids={"RandomForest": points["RandomForest"]}))).collect()) == 2


def test_tables_with_few_equal_rows_are_not_counted(spark, spec):
    few = spark.range(300).select("id", F.rand(1).alias("x"), F.rand(2).alias("z"), F.lit("u").alias("c"), (F.col("id") % 2).cast("double").alias("y"))
    own = dataclasses.replace(spec, grids={"DecisionTree": {"maxDepth": [2]}})
    folded = with_fold(few, "id", 3)
    assert tuning._cells(folded, 0, {0: 100, 1: 100, 2: 100}, encode.fit_features(few, SPEC), own) is None


def test_shallower_forests_are_the_upper_levels(spark, many):
    """The same predictions as forests that Spark fits less deep, of which it merges other leaves."""
    df = encode.fit_features(many, SPEC).transform(many).cache()
    forest = RandomForestClassifier(labelCol="y", numTrees=7, seed=5)
    deepest = forest.copy({forest.maxDepth: 8}).fit(df)
    rows = df.select("id", trees.slots("features").alias("slots"))
    found = trees.forest_predictions(rows, "slots", trees.tree_nodes(spark, deepest).collect(), {f"d{d}": d for d in (0, 1, 3, 5, 8)})
    for depth in (0, 1, 3, 5, 8):
        theirs = forest.copy({forest.maxDepth: depth}).fit(df).transform(df)
        assert found.join(theirs, "id").where(f"d{depth} <> prediction").isEmpty()


def test_bounds_follow_the_values(spark):
    assert cells.bounds_of([]) == [] and cells.bounds_of([2.0, 2.0]) == []
    assert cells.bounds_of([0.0, 1.0, -0.0, 4.0]) == [0.5, 2.5]
    assert cells.bounds_of([0.0] * 90 + list(range(1, 11)), bins=4) == [0.5, 1.5, 2.5]
    df = spark.createDataFrame([(0.5, 1, "a"), (0.6, 2, None), (float("inf"), 3, "a"), (None, 1, "a"), (float("nan"), 1, "a")], "x double, z int, c string")
    assert [tuple(r) for r in cells.binned(df, SPEC, {"x": [0.1, 0.5, 7.0], "z": []}).collect()] == [(1.0, 0.0, "a"), (2.0, 0.0, None), (3.0, 0.0, "a")]


def test_a_cells_draws_have_the_mean_and_spread_of_its_rows(spark):
    df = spark.range(4000, numPartitions=4).select(F.lit(25).cast("long").alias("n"))
    found = cells.with_bootstraps(df, "n", ["a", "b"], 3)
    means = found.agg(*[f(c) for c in "ab" for f in (F.avg, F.var_samp)], F.corr("a", "b")).first()
    assert list(means)[:4] == [pytest.approx(25, abs=0.5), pytest.approx(25, abs=2.5)] * 2 and abs(means[4]) < 0.06
    assert found.select("a", "b").collect() == cells.with_bootstraps(df, "n", ["a", "b"], 3).select("a", "b").collect()


def test_trees_stored_one_by_one_are_read_by_number(spark, many):
    df = encode.fit_features(many, SPEC).transform(many).cache()
    alone = RandomForestClassifier(labelCol="y", numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt", maxDepth=2)
    models = {n: alone.copy({alone.seed: n}).fit(df) for n in (11, 2)}
    found = trees.stored_tree_nodes(spark, [trees.store_tree(spark, model, n) for n, model in models.items()])
    for n, model in models.items():
        assert sorted(found.where(F.col("tree") == n).drop("tree").collect()) == sorted(trees.tree_nodes(spark, model).drop("tree").collect())
    assert found.select("tree").distinct().count() == 2

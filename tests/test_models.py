import dataclasses
import json

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tablewright.operators import encode, linear, trees, tuning
from tablewright.operators.sampling import with_fold
from tablewright.operators.score import incomplete_rows, score
from tablewright.sources.models import load_model, model_exists, save_model

SPEC = encode.FeatureSpec(numeric=("x",), categorical=("c",))


def test_unseen_and_null_categories_share_an_index_without_slot(spark):
    fit_on = spark.createDataFrame([(1.0, "b"), (1.0, "b"), (1.0, "a"), (1.0, "c")], "x double, c string")
    df = spark.createDataFrame([(1.0, "b"), (1.0, "a"), (1.0, "c"), (1.0, "z"), (1.0, None)], "x double, c string")
    out = encode.fit_features(fit_on, SPEC).transform(df).select("c_index", vector_to_array("c_vec").alias("v")).collect()
    assert [r["c_index"] for r in out] == [0.0, 1.0, 2.0, 3.0, 3.0]
    assert [r["v"] for r in out] == [[1, 0, 0], [0, 1, 0], [0, 0, 1], [0, 0, 0], [0, 0, 0]]


def test_rows_with_a_missing_number_are_skipped_and_reported(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "a"), (3, float("nan"), "a"), (4, 2.0, None)], "id int, x double, c string")
    kept = encode.fit_features(df, SPEC).transform(df)
    assert sorted(r["id"] for r in kept.collect()) == [1, 4]
    assert sorted(r["id"] for r in incomplete_rows(df, SPEC).collect()) == [2, 3]


def test_feature_names_follow_the_slots(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    spec = encode.FeatureSpec(numeric=("x",), categorical=("c",))
    stages = encode.feature_stages(spec)
    stages[-1].setInputCols(["c_vec", "x"])  # categories first
    out = Pipeline(stages=stages).fit(df).transform(df)
    assert encode.feature_names(out) == ["c_vec_a", "c_vec_b", "x"]


def test_feature_info(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, c string")
    info = encode.feature_info(encode.fit_features(df, SPEC), SPEC, df)
    assert [tuple(r) for r in info.collect()] == [(0, "x", "numerical", 1), (1, "c_vec", "categorical", 2)]


@pytest.fixture(scope="module")
def learnable(spark):
    return spark.range(1200).select(
        "id",
        F.expr("CAST(pmod(hash(id), 1000) AS DOUBLE) / 1000").alias("x"),
        F.expr("CASE WHEN pmod(hash(id, 7), 3) = 0 THEN 'u' ELSE 'v' END").alias("c"),
    ).withColumn("y", F.expr("CAST(x + CASE WHEN c = 'u' THEN 0.3 ELSE 0 END + pmod(hash(id, 9), 100) / 400 > 0.7 AS DOUBLE)"))


SMALL_GRIDS = {"DecisionTree": {"maxDepth": [1, 4]}, "LogisticRegression": {"regParam": [0.01, 0.1]}}


@pytest.fixture(scope="module")
def spec():
    return tuning.TrainingSpec(features=SPEC, label="y", key="id", grids=SMALL_GRIDS)


def test_scores_equal_the_built_in_cross_validator(learnable, spec):
    ours = {(r["family"], json.loads(r["params"])["maxDepth"]): r["f1"]
            for r in tuning.tuning_table(tuning.cross_validate(learnable, spec)).where("family = 'DecisionTree'").collect()}
    tree = tuning.classifier("DecisionTree", "y")
    grid = tuning.param_maps(tree, SMALL_GRIDS["DecisionTree"])
    validator = CrossValidator(
        estimator=Pipeline(stages=[*encode.feature_stages(SPEC), tree]),
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol="y", metricName="f1"),
        numFolds=3,
        foldCol="fold",
        parallelism=4,
    )
    theirs = validator.fit(with_fold(learnable, "id", 3)).avgMetrics
    assert [ours["DecisionTree", d] for d in (1, 4)] == pytest.approx(theirs)


def test_fixed_grids_have_fifteen_points():
    from math import prod

    assert [prod(len(v) for v in g.values()) for g in tuning.GRIDS.values()] == [4, 6, 3, 2]
    assert list(tuning.GRIDS)[0] == "GBTClassifier"


def test_best_model_prefers_the_earlier_family_on_a_tie(spark):
    tuned = spark.createDataFrame(
        [("A", 0, 0, "{}", 0.5), ("A", 0, 1, '{"p": 1}', 0.8), ("B", 1, 0, "{}", 0.8), ("A", 0, 2, "{}", 0.8)],
        "family string, family_rank int, point int, params string, f1 double",
    )
    assert tuple(tuning.best_model(tuned).first()) == ("A", '{"p": 1}', 0.8)
    assert {(r["family"], r["point"]) for r in tuning.best_per_family(tuned).collect()} == {("A", 1), ("B", 0)}
    assert [tuple(r) for r in tuning.best_params(tuning.best_model(tuned)).collect()] == [("p", 1.0)]


@pytest.mark.parametrize("family", list(tuning.CLASSIFIERS))
def test_every_family_fits_scores_and_is_saved(spark, learnable, spec, family, tmp_path):
    model = tuning.fit_family(learnable, spec, family)
    path = str(tmp_path / "model")
    assert not model_exists(spark, path)
    save_model(model, path)
    assert model_exists(spark, path)
    before = score(model, learnable, "yes", "no")
    after = score(load_model(path), learnable, "yes", "no")
    assert before.exceptAll(after).isEmpty()
    assert before.where("(prediction = 1) <> (prediction_label = 'yes')").isEmpty()
    assert before.where("prediction = y").count() / 1200 > 0.8
    if family == "LogisticRegression":
        with pytest.raises(ValueError):
            encode.feature_importance(model.stages[-1], model.transform(learnable))
    else:
        importance = encode.feature_importance(model.stages[-1], model.transform(learnable)).collect()
        assert importance[0]["feature"] == "x"
        assert sum(r["importance"] for r in importance) == pytest.approx(1.0)


def test_best_model_is_fitted_on_all_rows(learnable, spec, spark):
    best = spark.createDataFrame([("RandomForest", '{"numTrees": 5, "maxDepth": 3}', 0.9)], "family string, params string, f1 double")
    model = tuning.fit_best(learnable, spec, best)
    assert isinstance(model.stages[-1], RandomForestClassificationModel)
    assert model.stages[-1].getNumTrees == 5


def test_signature(learnable, spec):
    fitted = encode.fit_features(learnable, SPEC)
    rows = encode.signature(learnable, fitted.transform(learnable)).collect()
    assert [r["name"] for r in rows if r["io"] == "input"] == ["id", "x", "c", "y"]
    assert rows[-1]["type"] == "vector"


def test_layout_depends_on_the_rows_alone(spark, learnable, spec):
    """The same forest from any number of input partitions, also with a hot key and keyless rows."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN -1 WHEN id % 7 = 0 THEN NULL ELSE id END")
    rows = learnable.withColumn("id", key).cache()
    own = dataclasses.replace(spec, rows_per_part=100)
    models = [tuning.fit_family(rows.repartition(n), own, "RandomForest", numTrees=3, maxDepth=4).stages[-1].toDebugString for n in (1, 4, 16)]
    trees_only = [m[m.index("\n") :] for m in models]  # the first line names the model
    assert trees_only[0] == trees_only[1] == trees_only[2]
    sizes = [r["count"] for r in tuning.spread(rows, "id", 100).groupBy(F.spark_partition_id()).count().collect()]
    # A third of the rows has one key; 12 parts of 100 rows on average.
    assert len(sizes) == 12 and max(sizes) < 170


def test_ten_times_the_rows_get_ten_times_the_parts(spark):
    parts = [tuning.spread(spark.range(n), "id", 100).rdd.getNumPartitions() for n in (0, 1, 1000, 10_000)]
    assert parts == [1, 1, 10, 100]


def test_smaller_models_lie_inside_larger_ones(spark, learnable, spec):
    """Points that aren't fitted score as the built-in cross validator's fits do."""
    grids = {"GBTClassifier": {"maxDepth": [2, 3], "maxIter": [2, 5]}, "DecisionTree": {"maxDepth": [1, 2, 5]}}
    own = dataclasses.replace(spec, grids=grids)
    assert [len(points) for points in tuning._fits(own)] == [2, 2, 3]
    found = tuning.tuning_table(tuning.cross_validate(learnable, own)).collect()
    assert len(found) == 7
    for family, grid in grids.items():
        model = tuning.classifier(family, "y")
        points = tuning.param_maps(model, grid)
        validator = CrossValidator(
            estimator=Pipeline(stages=[*encode.feature_stages(SPEC), model]), estimatorParamMaps=points,
            evaluator=MulticlassClassificationEvaluator(labelCol="y", metricName="f1"), numFolds=3, foldCol="fold", parallelism=8,
        )
        theirs = validator.fit(with_fold(learnable, "id", 3)).avgMetrics
        ours = {r["params"]: r["f1"] for r in found if r["family"] == family}
        assert [ours[json.dumps({p.name: v for p, v in point.items()})] for point in points] == pytest.approx(theirs)


@pytest.mark.parametrize("family, params", [
    ("DecisionTree", {"maxDepth": 5}), ("RandomForest", {"numTrees": 4, "maxDepth": 4}), ("GBTClassifier", {"maxIter": 4, "maxDepth": 3}),
])
def test_importance_of_stored_nodes(spark, learnable, spec, family, params):
    model = tuning.fit_family(learnable, spec, family, **params)
    nodes = trees.tree_nodes(spark, model.stages[-1])
    named = encode.named_importance(trees.slot_importance(nodes, family != "GBTClassifier"), encode.feature_names(model.transform(learnable)))
    theirs = {r["feature"]: r["importance"] for r in encode.feature_importance(model.stages[-1], model.transform(learnable)).collect()}
    assert {r["feature"]: r["importance"] for r in named.collect()} == pytest.approx(theirs, abs=1e-12)


def test_logistic_model_as_arithmetic(spark, learnable, spec):
    model = tuning.fit_family(learnable, spec, "LogisticRegression", regParam=0.01)
    given = linear.linear_model(model, SPEC)
    extra = spark.createDataFrame([(-1, 0.4, "new", 0.0), (-2, 0.4, None, 0.0)], "id long, x double, c string, y double")
    rows = model.transform(learnable.unionByName(extra))
    both = rows.select("prediction", vector_to_array("probability")[1].alias("theirs"), given.probability().alias("ours"), given.prediction().alias("found"))
    assert both.count() == 1202
    assert both.where("abs(theirs - ours) > 1e-12 OR prediction <> found OR ours IS NULL").isEmpty()
    missing = spark.createDataFrame([(None, "u"), (float("nan"), "u")], "x double, c string").select(given.probability().alias("p"), given.prediction().alias("n"))
    assert [tuple(r) for r in missing.collect()] == [(None, None)] * 2

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.mllib.evaluation import MulticlassMetrics
from pyspark.sql import functions as F

from tablewright.operators import metrics as m
from tablewright.operators.curves import areas, auc_pr, auc_roc, pr_curve, roc_curve

# A recorded confusion matrix (actual, predicted, rows) and the figures that belong to it.
MATRIX = [(0.0, 0.0, 79), (0.0, 1.0, 7), (1.0, 0.0, 17), (1.0, 1.0, 40)]
METRICS = {
    "accuracy": 0.8321678321678322,
    "f1_score": 0.8287097517866748,
    "precision": 0.8341361652531865,
    "recall": 0.8321678321678321,
}
REPORT = {
    "accuracy": 0.8321678321678322,
    "weightedPrecision": 0.8341361652531865,
    "weightedRecall": 0.8321678321678321,
    "weightedFMeasure": 0.8287097517866748,
    "weightedFMeasure_beta": 0.829783852511125,
    "falsePositiveRate_0": 0.2982456140350877,
    "falsePositiveRate_1": 0.08139534883720931,
    "truePositiveRate_0": 0.9186046511627907,
    "truePositiveRate_1": 0.7017543859649122,
}


@pytest.fixture(scope="module")
def predictions(spark):
    counted = spark.createDataFrame(MATRIX, "label double, prediction double, n int")
    return counted.select("label", "prediction", F.explode(F.sequence(F.lit(1), "n")))


def test_recorded_figures(predictions):
    pairs = m.pair_counts(predictions)
    assert m.classification_metrics(pairs).first().asDict() == pytest.approx(METRICS, rel=1e-14)
    assert m.classification_report(pairs).first().asDict() == pytest.approx(REPORT, rel=1e-14)
    assert sorted(map(tuple, m.confusion_matrix(pairs).collect())) == MATRIX


def test_matrix_has_every_pair_of_labels(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (None, 1.0)], "label double, prediction double")
    pairs = m.pair_counts(df)
    assert sorted(map(tuple, m.confusion_matrix(pairs).collect())) == [(0, 0, 1), (0, 1, 0), (1, 0, 1), (1, 1, 0)]
    assert m.classification_metrics(pairs).first()["precision"] == pytest.approx(0.25)


def test_three_classes_like_the_built_in_metrics(spark):
    rng = np.random.default_rng(2)
    data = [(float(a), float(b)) for a, b in rng.integers(0, 3, size=(200, 2))]
    df = spark.createDataFrame(data, "label double, prediction double")
    got = m.classification_report(m.pair_counts(df), labels=(0.0, 1.0, 2.0)).first()
    builtin = MulticlassMetrics(spark.sparkContext.parallelize([(p, l) for l, p in data]))
    assert got["weightedFMeasure"] == pytest.approx(builtin.weightedFMeasure())
    assert got["weightedFMeasure_beta"] == pytest.approx(builtin.weightedFMeasure(2.0))
    assert got["falsePositiveRate_2"] == pytest.approx(builtin.falsePositiveRate(2.0))


def test_long_form(predictions):
    long = m.to_long(m.classification_metrics(m.pair_counts(predictions)))
    assert {r["name"]: r["value"] for r in long.collect()} == pytest.approx(METRICS)


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(9)
    labels = rng.integers(0, 2, size=400)
    scores = np.round(np.clip(rng.normal(0.45 + 0.15 * labels, 0.2), 0, 1), 2)
    return spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "score double, label int")


def rank_auc(pairs):
    positive = [s for s, y in pairs if y == 1]
    negative = [s for s, y in pairs if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 30])
def test_areas(scored, rows_per_bucket):
    pairs = [tuple(r) for r in scored.collect()]
    row = areas(scored, "score", "label", rows_per_bucket).first()
    assert row["auc_roc"] == pytest.approx(rank_auc(pairs))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert row["auc_roc"] == pytest.approx(evaluator.evaluate(scored))
    assert row["auc_roc"] == auc_roc(scored, "score", "label", rows_per_bucket).first()[0]
    assert row["auc_pr"] == auc_pr(scored, "score", "label", rows_per_bucket).first()[0]


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 30])
def test_areas_are_those_under_the_points(scored, rows_per_bucket):
    roc = sorted(((r["fpr"], r["tpr"]) for r in roc_curve(scored, "score", "label", rows_per_bucket).collect()))
    row = areas(scored, "score", "label").first()
    assert roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0)
    assert float(np.trapezoid([y for _, y in roc], [x for x, _ in roc])) == pytest.approx(row["auc_roc"])
    points = pr_curve(scored, "score", "label", rows_per_bucket).collect()
    pr = sorted(points, key=lambda r: float("inf") if r["threshold"] is None else r["threshold"], reverse=True)
    assert (pr[0]["recall"], pr[0]["precision"]) == (0.0, 1.0)
    assert float(np.trapezoid([r["precision"] for r in pr], [r["recall"] for r in pr])) == pytest.approx(row["auc_pr"])


def test_precision_recall_area_starts_at_precision_one(spark):
    df = spark.createDataFrame([(0.9, 0), (0.8, 1), (0.7, 1), (0.6, 0), (0.5, 1)], "score double, label int")
    # Points from the top: (0, 1), (0, 0), (1/3, 1/2), (2/3, 2/3), (2/3, 1/2), (1, 3/5)
    expected = (0 + 1 / 2) / 6 + (1 / 2 + 2 / 3) / 6 + (1 / 2 + 3 / 5) / 6
    assert auc_pr(df, "score", "label").first()[0] == pytest.approx(expected)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")
    assert auc_roc(df, "score", "label").first()[0] is None
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "score double, label int")
    assert areas(df, "score", "label").first().asDict() == {"auc_roc": None, "auc_pr": None}

import pytest
from pyspark.sql import functions as F

from tablewright.operators.drift import chi2_drift, drift_report, ks_drift
from tablewright.operators.encode import FeatureSpec
from tablewright.operators.sampling import hash_split, sample_n
from tablewright.operators.tuning import TrainingSpec, fit_family


@pytest.mark.parametrize("method", ["xxhash64", "multiplicative"])
def test_a_split_keeps_rows_without_a_key(spark, method):
    df = spark.createDataFrame([(None,), (1,), (2,)], "k long")
    assert sum(p.count() for p in hash_split(df, "k", [0.8, 0.2], method=method)) == 3


def test_unknown_hash_is_an_error(spark):
    with pytest.raises(ValueError):
        sample_n(spark.range(3), "id", 2, method="typo")


def test_no_shared_feature_gives_an_empty_report(spark):
    a, b = spark.range(3).select(F.col("id").alias("x")), spark.range(3).select(F.col("id").alias("y"))
    assert ks_drift(a, b, ["x", "y"]).count() == 0
    assert chi2_drift(a, b, ["x", "y"]).count() == 0


def test_features_without_values_stay_in_the_report(spark):
    df = spark.range(20).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("n"), F.lit("a").alias("c"))
    rows = {r.feature: r for r in drift_report(df, df, ["x", "n"], ["c"]).collect()}
    assert set(rows) == {"x", "n", "c"} and rows["n"].statistic is None and not rows["n"].drifted
    empty = {r.feature: r for r in drift_report(df.where("false"), df, ["x"], ["c"]).collect()}
    assert empty["c"].statistic is None and empty["c"].p_value is None and empty["x"].p_value is None


def test_the_law_does_not_depend_on_the_size(spark):
    for n in (9_999, 10_001):
        a = spark.range(n).select((F.col("id") / n + 0.02).alias("x"))
        row = ks_drift(a, spark.range(n).select((F.col("id") / n).alias("x")), ["x"]).first()
        root = (n / 2) ** 0.5
        lam = row.statistic * (root + 0.12 + 0.11 / root)
        series = 2 * sum((-1) ** (j - 1) * 2.718281828459045 ** (-2 * j * j * lam * lam) for j in range(1, 101))
        assert row.p_value == pytest.approx(series, rel=1e-9)


def test_a_forest_does_not_depend_on_the_input_partitions(spark):
    df = spark.range(600).select("id", (F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") * 53 % 97).cast("double").alias("y"))
    df = df.withColumn("label", ((F.col("x") + F.col("y") * (F.col("id") % 3)) > 90).cast("double"))
    spec = TrainingSpec(features=FeatureSpec(numeric=("x", "y"), categorical=()), label="label", key="id")
    found = [fit_family(df.repartition(n), spec, "RandomForest", numTrees=5, maxDepth=4, seed=1).stages[-1].featureImportances.toArray().tolist() for n in (1, 4, 16)]
    assert found[0] == found[1] == found[2]

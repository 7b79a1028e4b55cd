import pytest

from tablewright import presets
from tablewright.operators.profile import category_counts, numeric_profile
from tablewright.operators.quality import Rule, rejected_rows, valid_rows, violation_summary, with_violations
from tablewright.sources.tables import from_rows

# The two example requests.
GOOD = [
    dict(Pclass=1, Age=38.0, SibSp=1, Parch=0, Fare=71.2833, Sex="female", Embarked="C", Name="Cumings, Mrs. John"),
    dict(Pclass=3, Age=35.0, SibSp=0, Parch=0, Fare=8.05, Sex="male", Embarked="S", Name="Heikkinen, Mr. Lauri"),
]


def test_request_rules(spark):
    bad = [
        {**GOOD[0], "Pclass": 4},
        {**GOOD[0], "Age": -1.0, "Fare": 600.5},
        {k: v for k, v in GOOD[1].items() if k != "Name"},
        {**GOOD[1], "Sex": "other", "Embarked": None},
        {**GOOD[1], "Age": float("nan")},
    ]
    df = from_rows(spark, GOOD + bad, presets.REQUEST_SCHEMA)
    found = [r["violations"] for r in with_violations(df, presets.request_rules()).collect()]
    assert found == [
        [],
        [],
        ["Pclass_range"],
        ["Age_range", "Fare_range"],
        ["Name_required"],
        ["Embarked_required", "Sex_domain"],
        ["Age_range"],
    ]
    assert valid_rows(df, presets.request_rules()).count() == 2
    assert rejected_rows(df, presets.request_rules()).count() == 5


def test_range_ends_are_inside(spark):
    df = spark.createDataFrame([(0.0,), (600.0,), (600.1,), (-0.1,)], "x double")
    assert valid_rows(df, [Rule.between("x", 0, 600)]).count() == 2


def test_form_ranges_are_narrower(spark):
    df = from_rows(spark, [{**GOOD[0], "SibSp": 9}], presets.REQUEST_SCHEMA)
    assert valid_rows(df, presets.request_rules()).count() == 1
    assert valid_rows(df, presets.request_rules(presets.FORM_RANGES)).count() == 0


def test_summary_counts_every_rule_in_one_pass(spark, rows):
    df = spark.createDataFrame([(1.0,), (None,), (9.0,)], "x double")
    summary = violation_summary(df, [Rule.required("x"), Rule.between("x", 0, 5)])
    assert rows(summary) == [("x_range", 3, 1), ("x_required", 3, 1)]


def test_profile_uses_complete_rows_and_sample_deviation(spark):
    df = spark.createDataFrame([(1.0, 10), (3.0, 20), (None, 1000)], "a double, b int")
    profile = {r["feature"]: r for r in numeric_profile(df, ["a", "b"]).collect()}
    assert profile["b"]["max"] == 20.0 and profile["b"]["mean"] == 15.0
    assert profile["a"]["stddev"] == pytest.approx(2**0.5)


def test_null_is_a_category(spark, rows):
    df = spark.createDataFrame([("a",), (None,), (None,)], "g string")
    assert rows(category_counts(df, "g")) == [("a", 1), (None, 2)]

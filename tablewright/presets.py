"""A ready specification for passenger lists: the columns, rules and labels of that data set."""

from __future__ import annotations

from tablewright.operators.encode import FeatureSpec
from tablewright.operators.impute import FillSpec
from tablewright.operators.quality import Rule
from tablewright.operators.tuning import TrainingSpec
from tablewright.plans.preprocess import TableSpec

# Columns, ranges, domains and label texts of the passenger table.
RAW_SCHEMA = (
    "PassengerId bigint, Survived string, Pclass string, Name string, Sex string, Age string, SibSp string, "
    "Parch string, Ticket string, Fare string, Cabin string, Embarked string"
)
RAW_TEST_SCHEMA = (
    "PassengerId bigint, Pclass string, Name string, Sex string, Age string, SibSp string, "
    "Parch string, Ticket string, Fare string, Cabin string, Embarked string"
)
REQUEST_SCHEMA = (
    "Pclass int, Age double, SibSp int, Parch int, Fare double, Sex string, Embarked string, Name string"
)
KEY = "PassengerId"
LABEL = "Survived"
POSITIVE_LABEL = "Survived"
NEGATIVE_LABEL = "Did not survive"
NUMERIC_RAW = ("Pclass", "Age", "SibSp", "Parch", "Fare")
NUMERIC_FEATURES = ("Pclass", "Age_imputed", "SibSp", "Parch", "Fare", "IsAlone", "FamilySize")
CATEGORICAL_FEATURES = ("Sex", "Embarked", "Title")
DRIFT_NUMERIC = ("Age_imputed", "Fare", "FamilySize", "SibSp", "Parch")
DRIFT_CATEGORICAL = ("Pclass", "Sex", "Embarked", "Title", "IsAlone")
PROFILED = ("Age", "SibSp", "Fare")
REQUEST_RANGES = {"Pclass": (1, 3), "Age": (0, 100), "SibSp": (0, 10), "Parch": (0, 10), "Fare": (0, 600)}
FORM_RANGES = {"Pclass": (1, 3), "Age": (0, 100), "SibSp": (0, 8), "Parch": (0, 6), "Fare": (0, 512)}
DOMAINS = {"Sex": ("male", "female"), "Embarked": ("C", "Q", "S")}
REQUIRED = ("Pclass", "Age", "SibSp", "Parch", "Fare", "Sex", "Embarked", "Name")

# The key stays in the feature table: samples, splits and folds are placed by it.
TABLE = TableSpec(
    key=KEY,
    label=LABEL,
    numeric=NUMERIC_RAW,
    name="Name",
    size_parts=("SibSp", "Parch"),
    fills=FillSpec(group_mean={"Age_imputed": ("Title", "Age")}, mean=("Fare",), mode=("Embarked",)),
    dropped=("Ticket", "Cabin", "Name", "Age"),
)
FEATURES = FeatureSpec(numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES)
TRAINING = TrainingSpec(features=FEATURES, label=LABEL, key=KEY)


def request_rules(ranges: dict = REQUEST_RANGES, domains: bool = True, required: bool = True) -> list[Rule]:
    """Rules for rows to be scored: ranges and, if wanted, required fields (tables have theirs filled) and domains.

    A function, because a rule holds a column and a column needs a running session.
    """
    rules = [Rule.required(c) for c in REQUIRED if required]
    rules += [Rule.between(c, low, high) for c, (low, high) in ranges.items()]
    if domains:
        rules += [Rule.one_of(c, allowed) for c, allowed in DOMAINS.items()]
    return rules

"""Batch scoring with a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import decode_label, missing, positive_probability
from tablewright.operators.encode import FeatureSpec
from tablewright.operators.quality import Rule, with_violations

# Fixed value: decimals of a reported probability.
PROBABILITY_PLACES = 4


def score(
    model: PipelineModel, df: DataFrame, positive: str = "positive", negative: str = "negative"
) -> DataFrame:
    """Add ``prediction``, ``prediction_label`` and ``probability`` to the input's own columns.

    The row's columns, its key among them, travel with the result, so nothing is paired by
    position, and rows that the model skips are just absent.
    """
    return model.transform(df).select(
        *df.columns,
        F.col("prediction").cast("int").alias("prediction"),
        decode_label("prediction", positive, negative).alias("prediction_label"),
        F.round(positive_probability("probability"), PROBABILITY_PLACES).alias("probability"),
    )


def score_all(
    model: PipelineModel,
    df: DataFrame,
    spec: FeatureSpec,
    rules: Sequence[Rule] = (),
    positive: str = "positive",
    negative: str = "negative",
) -> DataFrame:
    """Every input row with its ``outcome`` and, if it was scored, what ``score`` adds.

    ``rejected`` rows break a rule, named in ``violations``, and are not given to the model; ``skipped`` rows lack a
    number that the model needs. No row is lost, and none needs a shuffle.
    """
    checked = with_violations(df, rules)
    valid = checked.where(F.size("violations") == 0)
    outcomes = {
        "scored": score(model, valid, positive, negative),
        "rejected": checked.where(F.size("violations") > 0),
        "skipped": incomplete_rows(valid, spec),
    }
    parts = [rows.withColumn("outcome", F.lit(name)) for name, rows in outcomes.items()]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


def incomplete_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Input rows that get no prediction: the assembler skips a row with a null or NaN number.

    Categories never cause a skip, as unseen and null ones share an index. So this is a filter on
    the input and needs no join with the scored rows.
    """
    condition = F.lit(False)
    for column in spec.numeric:
        condition = condition | missing(F.col(column).cast("double"), True)
    return df.where(condition)

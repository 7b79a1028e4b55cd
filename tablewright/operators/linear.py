"""A fitted logistic model as arithmetic over its input columns, to be used in any query without the model's own stages."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.columns import missing
from tablewright.operators.encode import FeatureSpec


@dataclass(frozen=True)
class LinearModel:
    """Log-odds = intercept + sum of weight * number + the weight of each category; unknown and null categories weigh 0."""

    intercept: float
    numeric: Mapping[str, float] = field(default_factory=dict)
    categorical: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    threshold: float = 0.5

    def log_odds(self) -> Column:
        """Null for a row with a null or NaN number, which the model would skip."""
        total = F.lit(float(self.intercept))
        for column, weight in self.numeric.items():
            value = F.col(column).cast("double")
            total = total + F.lit(float(weight)) * F.when(~missing(value, True), value)
        for column, weights in self.categorical.items():
            if not weights:
                continue
            known = F.lit(0.0)
            for category, weight in weights.items():
                known = F.when(F.col(column).cast("string") == F.lit(category), F.lit(float(weight))).otherwise(known)
            total = total + known
        return total

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds()))

    def prediction(self) -> Column:
        """1 where the probability is above the threshold, else 0; null for a row that is skipped."""
        return (self.probability() > self.threshold).cast("int")


def linear_model(model: PipelineModel, spec: FeatureSpec) -> LinearModel:
    """The weights of a fitted pipeline of feature stages and a binary logistic regression, by column and category."""
    fitted = model.stages[-1]
    weights = fitted.coefficients.toArray().tolist()
    categorical, at = {}, len(spec.numeric)
    if spec.categorical:
        for column, labels in zip(spec.categorical, model.stages[0].labelsArray, strict=True):
            categorical[column] = dict(zip(labels, weights[at : at + len(labels)], strict=True))
            at += len(labels)
    return LinearModel(float(fitted.intercept), dict(zip(spec.numeric, weights)), categorical, fitted.getThreshold())

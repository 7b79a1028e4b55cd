"""Score raw rows with a stored model and the fills it was trained with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tablewright.operators.encode import FeatureSpec
from tablewright.operators.impute import FillModel
from tablewright.operators.quality import Rule
from tablewright.operators.score import score, score_all
from tablewright.plans.preprocess import TableSpec, derive


def score_raw(
    raw: DataFrame,
    spec: TableSpec,
    fills: FillModel,
    model: PipelineModel,
    positive: str = "positive",
    negative: str = "negative",
) -> DataFrame:
    """Raw columns plus ``prediction``, ``prediction_label`` and ``probability``, batch or stream."""
    prepared = fills.apply(derive(raw, spec))
    scored = score(model, prepared, positive, negative)
    added = ["prediction", "prediction_label", "probability"]
    return scored.select(*raw.columns, *added)


def score_raw_all(
    raw: DataFrame,
    spec: TableSpec,
    features: FeatureSpec,
    fills: FillModel,
    model: PipelineModel,
    rules: Sequence[Rule],
    positive: str = "positive",
    negative: str = "negative",
) -> DataFrame:
    """``score_raw`` for every row: ``outcome`` is scored, rejected (``violations`` says why) or skipped."""
    found = score_all(model, fills.apply(derive(raw, spec)), features, rules, positive, negative)
    added = ["outcome", "violations", "prediction", "prediction_label", "probability"]
    return found.select(*raw.columns, *added)

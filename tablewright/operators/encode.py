"""Feature stages: category indices, one-hot vectors, the assembled feature vector."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FeatureSpec:
    """Columns of the feature vector: numeric ones first, then the encoded categories."""

    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    output: str = "features"

    @property
    def index_columns(self) -> list[str]:
        return [f"{c}_index" for c in self.categorical]

    @property
    def vector_columns(self) -> list[str]:
        return [f"{c}_vec" for c in self.categorical]

    @property
    def all_features(self) -> list[str]:
        return [*self.numeric, *self.vector_columns]


def indexer(spec: FeatureSpec) -> StringIndexer:
    """Index by falling frequency, ties by name; unseen and null values share one extra index.

    All columns are counted in one job, where one indexer per column would read the table for each.
    """
    return StringIndexer(inputCols=list(spec.categorical), outputCols=spec.index_columns, handleInvalid="keep")


def encoder(spec: FeatureSpec) -> OneHotEncoder:
    """One slot per known category. The extra index is the last one and has no slot (all zeros)."""
    return OneHotEncoder(inputCols=spec.index_columns, outputCols=spec.vector_columns)


def assembler(spec: FeatureSpec) -> VectorAssembler:
    """One vector per row; a row with a null or NaN feature is skipped."""
    return VectorAssembler(inputCols=spec.all_features, outputCol=spec.output, handleInvalid="skip")


def feature_stages(spec: FeatureSpec) -> list:
    encoded = [indexer(spec), encoder(spec)] if spec.categorical else []
    return [*encoded, assembler(spec)]


def fit_features(df: DataFrame, spec: FeatureSpec) -> PipelineModel:
    return Pipeline(stages=feature_stages(spec)).fit(df)


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Name of each slot of a feature vector, ordered by slot."""
    kinds = df.schema[features].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for group in kinds.values() for a in group), key=lambda a: a["idx"])]


def feature_importance(model: Transformer, transformed: DataFrame, features: str = "features") -> DataFrame:
    """Importance per feature slot, highest first, for any model that has importances."""
    if not hasattr(model, "featureImportances"):
        raise ValueError(f"{type(model).__name__} has no feature importances")
    names = feature_names(transformed, features)
    rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, model.featureImportances.toArray(), strict=True))]
    return (
        transformed.sparkSession.createDataFrame(rows, "idx int, feature string, importance double")
        .orderBy(F.desc("importance"), "idx")
    )


def named_importance(importance: DataFrame, names: Sequence[str]) -> DataFrame:
    """Slot importances with the slots' names, highest first; slots without any have 0."""
    slots = importance.sparkSession.createDataFrame(list(enumerate(names)), "idx int, feature string")
    found = slots.join(importance, "idx", "left").withColumn("importance", F.coalesce("importance", F.lit(0.0)))
    return found.orderBy(F.desc("importance"), "idx")


def feature_info(model: PipelineModel, spec: FeatureSpec, df: DataFrame) -> DataFrame:
    """Feature columns by kind, with the number of vector slots each one fills."""
    sizes = {c: 1 for c in spec.numeric}
    if spec.categorical:
        labels = model.stages[0].labelsArray
        sizes |= {f"{c}_vec": len(known) for c, known in zip(spec.categorical, labels, strict=True)}
    rows = [
        (position, name, "numerical" if name in spec.numeric else "categorical", sizes[name])
        for position, name in enumerate(spec.all_features)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, feature string, kind string, slots int")


def signature(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Names and types of a model's input and output columns."""
    rows = [
        (io, position, f.name, f.dataType.simpleString(), f.nullable)
        for io, df in (("input", inputs), ("output", outputs))
        for position, f in enumerate(df.schema.fields)
    ]
    return inputs.sparkSession.createDataFrame(
        rows, "io string, position int, name string, type string, nullable boolean"
    )

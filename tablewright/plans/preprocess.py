"""From raw labelled and unlabelled tables to the feature table, its splits and a baseline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.clean import cast_numeric, union_by_name
from tablewright.operators.features import with_group_size, with_title
from tablewright.operators.impute import FillModel, FillSpec
from tablewright.operators.sampling import hash_sample
from tablewright.sources.tables import write_baseline, write_parquet


@dataclass(frozen=True)
class TableSpec:
    """Which columns of a raw table mean what."""

    key: str
    label: str
    numeric: Sequence[str]
    name: str
    size_parts: Sequence[str]
    fills: FillSpec
    dropped: Sequence[str] = ()
    title: str = "Title"
    size: str = "FamilySize"
    single: str = "IsAlone"


def derive(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns that depend on their own row only; the same for training, scoring and streams."""
    present = [c for c in [*spec.numeric, spec.label] if c in df.columns]
    cleaned = cast_numeric(df, present)
    titled = with_title(cleaned, spec.name, spec.title)
    return with_group_size(titled, spec.size_parts, spec.size, spec.single)


def combine(training: DataFrame, scoring: DataFrame, spec: TableSpec) -> DataFrame:
    """Both raw tables in one, with the derived columns; the label is null where there is none.

    The second table's own label column, if it has one, does not make its rows labelled training rows
    of a different type: it goes through the same cast.
    """
    return union_by_name(derive(training, spec), derive(scoring, spec))


def feature_table(
    training: DataFrame, scoring: DataFrame, spec: TableSpec, fit_scope: str = "combined"
) -> tuple[DataFrame, FillModel]:
    """The filled feature table over both inputs, and the fill model it used.

    ``fit_scope``: ``combined`` fits the fills on all rows, ``train`` on the labelled rows only, so
    that nothing of the unlabelled rows leaks into training.
    """
    if fit_scope not in ("combined", "train"):
        raise ValueError(f"unknown fit scope {fit_scope!r}")
    both = combine(training, scoring, spec)
    fit_on = both if fit_scope == "combined" else both.where(F.col(spec.label).isNotNull())
    fills = FillModel.fit(fit_on, spec.fills)
    return fills.apply(both).drop(*spec.dropped), fills


def preprocess(
    training: DataFrame,
    scoring: DataFrame,
    spec: TableSpec,
    output_path: str,
    baseline_path: str | None = None,
    baseline_fraction: float = 0.2,
    fit_scope: str = "combined",
) -> FillModel:
    """Write the feature table, partitioned by ``split`` (train or test), its fills, and a baseline.

    One write makes both splits, where a write per split would compute everything again. The
    baseline, when asked for, is sampled from the written training rows by key, but only if there
    is none yet: later data are tested against the first baseline until a new one is promoted.
    """
    features, fills = feature_table(training, scoring, spec, fit_scope)
    split = F.when(F.col(spec.label).isNotNull(), "train").otherwise("test")
    write_parquet(features.withColumn("split", split), f"{output_path}/features", ["split"])
    fills.save(f"{output_path}/fills")
    if baseline_path:
        create_baseline(features.sparkSession, spec, output_path, baseline_path, baseline_fraction, "keep")
    return fills


def create_baseline(
    spark: SparkSession,
    spec: TableSpec,
    output_path: str,
    baseline_path: str,
    fraction: float = 0.2,
    existing: str = "error",
) -> None:
    """Sample the written training rows as the baseline."""
    write_baseline(hash_sample(read_split(spark, output_path, "train"), spec.key, fraction), baseline_path, existing)


def read_split(spark: SparkSession, output_path: str, split: str) -> DataFrame:
    """The training (``train``) or scoring (``test``) rows of a written feature table."""
    return spark.read.parquet(f"{output_path}/features").where(F.col("split") == split).drop("split")

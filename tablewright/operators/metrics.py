"""Classification metrics, all derived from one count of (label, prediction) pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction): the only pass over the data that the metrics need."""
    return (
        df.select(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction"))
        .where(F.col("label").isNotNull())
        .groupBy("label", "prediction")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """Every combination of the occurring labels, with zero where no row has it.

    ``pairs`` has one row per combination of classes, so it fits into one row as a map.
    """
    packed = pairs.agg(
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.map_from_entries(F.collect_list(F.struct(F.struct("label", "prediction"), "n"))).alias("cells"),
    )
    grid = packed.select("labels", "cells", F.explode("labels").alias("label")).select(
        "cells", "label", F.explode("labels").alias("prediction")
    )
    found = F.try_element_at("cells", F.struct("label", "prediction"))
    return grid.select("label", "prediction", F.coalesce(found, F.lit(0)).alias("n"))


def label_counts(pairs: DataFrame) -> DataFrame:
    """Per occurring label: true positives, predicted rows, actual rows, and all rows."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    roles = F.array(
        F.struct(F.col("label").alias("cls"), hit.alias("tp"), F.lit(0).alias("predicted"), F.col("n").alias("actual")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).alias("tp"), F.col("n").alias("predicted"), F.lit(0).alias("actual")),
    )
    total = pairs.agg(F.sum("n").alias("n")).scalar()
    return (
        pairs.select(F.inline(roles))
        .groupBy("cls")
        .agg(F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("actual").alias("actual"))
        .where(F.col("actual") > 0)
        .withColumn("total", total)
    )


def label_rates(pairs: DataFrame, beta: float = 2.0) -> DataFrame:
    """Per label: precision, recall (true positive rate), F with weight 1 and beta, false positive rate."""
    precision, recall = F.col("precision"), F.col("recall")

    def f_measure(b: float):
        bottom = b * b * precision + recall
        return F.when(bottom > 0, (1 + b * b) * precision * recall / F.nullif(bottom, F.lit(0.0))).otherwise(0.0)

    others = F.col("total") - F.col("actual")
    return (
        label_counts(pairs)
        .withColumns(
            {
                "precision": F.coalesce(F.col("tp") / F.nullif("predicted", F.lit(0)), F.lit(0.0)),
                "recall": F.col("tp") / F.col("actual"),
                "fpr": F.coalesce((F.col("predicted") - F.col("tp")) / F.nullif(others, F.lit(0)), F.lit(0.0)),
                "weight": F.col("actual") / F.col("total"),
            }
        )
        .withColumns({"f1": f_measure(1.0), "f_beta": f_measure(beta)})
    )


def classification_metrics(pairs: DataFrame) -> DataFrame:
    """One row: accuracy and the label-weighted F1, precision and recall."""
    return label_rates(pairs).agg(
        (F.sum("tp") / F.max("total")).alias("accuracy"),
        F.sum(F.col("f1") * F.col("weight")).alias("f1_score"),
        F.sum(F.col("precision") * F.col("weight")).alias("precision"),
        F.sum(F.col("recall") * F.col("weight")).alias("recall"),
    )


def classification_report(pairs: DataFrame, labels: Sequence[float] = (0.0, 1.0), beta: float = 2.0) -> DataFrame:
    """One row: accuracy, weighted averages, and the false and true positive rate of each label."""

    def of_label(column: str, label: float):
        return F.max(F.when(F.col("cls") == label, F.col(column)))

    return label_rates(pairs, beta).agg(
        (F.sum("tp") / F.max("total")).alias("accuracy"),
        F.sum(F.col("precision") * F.col("weight")).alias("weightedPrecision"),
        F.sum(F.col("recall") * F.col("weight")).alias("weightedRecall"),
        F.sum(F.col("f1") * F.col("weight")).alias("weightedFMeasure"),
        F.sum(F.col("f_beta") * F.col("weight")).alias("weightedFMeasure_beta"),
        *[of_label("fpr", v).alias(f"falsePositiveRate_{v:g}") for v in labels],
        *[of_label("recall", v).alias(f"truePositiveRate_{v:g}") for v in labels],
    )


def to_long(row: DataFrame) -> DataFrame:
    """Turn a one-row table of numbers into ``name, value`` rows."""
    entries = [F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in row.columns]
    return row.select(F.inline(F.array(*entries)))

"""Exact ROC and precision–recall curves and the areas under them.

Every distinct score is a point; curves stay distributed. Each point's neighbour is known from the
running counts in its own row, so the areas need no second ordering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.prefix import ROWS_PER_BUCKET, prefix_counts


def score_counts(df: DataFrame, score: str, label: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Per distinct score: positives and negatives at it, and at or above it (``tp``, ``fp``)."""
    is_positive = (F.col(label) == 1).cast("long")
    known = df.where(F.col(label).isNotNull())
    counts = prefix_counts(known, [score], {"pos": is_positive, "neg": 1 - is_positive}, rows_per_bucket)
    return counts.select(
        F.col("value").alias("threshold"),
        "pos",
        "neg",
        (F.col("pos_total") - F.col("pos_upto") + F.col("pos")).alias("tp"),
        (F.col("neg_total") - F.col("neg_upto") + F.col("neg")).alias("fp"),
        F.col("pos_total").alias("positives"),
        F.col("neg_total").alias("negatives"),
    )


def roc_curve(df: DataFrame, score: str, label: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``threshold, fpr, tpr`` for every distinct score, and the start point (infinity, 0, 0)."""
    return roc_points(score_counts(df, score, label, rows_per_bucket))


def pr_curve(df: DataFrame, score: str, label: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``threshold, recall, precision`` for every distinct score, and the end point (null, 0, 1)."""
    return pr_points(score_counts(df, score, label, rows_per_bucket))


def auc_roc(df: DataFrame, score: str, label: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Area under the ROC curve by trapezoids, which is the tie-corrected rank statistic."""
    return areas_of(score_counts(df, score, label, rows_per_bucket)).select("auc_roc")


def auc_pr(df: DataFrame, score: str, label: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Area under the precision–recall curve by trapezoids, starting at recall 0, precision 1."""
    return areas_of(score_counts(df, score, label, rows_per_bucket)).select("auc_pr")


def areas(df: DataFrame, score: str, label: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Both areas from one pass over the running counts."""
    return areas_of(score_counts(df, score, label, rows_per_bucket))


def roc_points(counts: DataFrame) -> DataFrame:
    """ROC points of ``score_counts``."""
    points = counts.select("threshold", _ratio("fp", "negatives").alias("fpr"), _ratio("tp", "positives").alias("tpr"))
    return points.unionByName(_end_point(counts, threshold=float("inf"), fpr=0.0, tpr=0.0))


def pr_points(counts: DataFrame) -> DataFrame:
    """Precision–recall points of ``score_counts``."""
    points = counts.select(
        "threshold",
        _ratio("tp", "positives").alias("recall"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
    )
    return points.unionByName(_end_point(counts, threshold=None, recall=0.0, precision=1.0))


def areas_of(counts: DataFrame) -> DataFrame:
    """Both areas of ``score_counts``; null where a class that they need is absent."""
    return counts.agg(_roc_area().alias("auc_roc"), _pr_area().alias("auc_pr"))


def _roc_area():
    width = _ratio("neg", "negatives")
    height = (F.col("tp") + (F.col("tp") - F.col("pos"))) / (2.0 * F.col("positives"))
    return F.sum(F.when((F.col("positives") > 0) & (F.col("negatives") > 0), width * height))


def _pr_area():
    above = F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    precision_above = F.when(above > 0, (F.col("tp") - F.col("pos")) / F.nullif(above, F.lit(0))).otherwise(1.0)
    return F.sum(_ratio("pos", "positives") * (precision + precision_above) / 2.0)


def _ratio(part: str, whole: str):
    """Null instead of a division by zero when a class is absent."""
    return F.col(part) / F.nullif(F.col(whole), F.lit(0))


def _end_point(df: DataFrame, **values: float | None) -> DataFrame:
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(n) for n, v in values.items()])

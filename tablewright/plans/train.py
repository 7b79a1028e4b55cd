"""Tune, select, evaluate and store a classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright import scratch
from tablewright.functions.columns import positive_probability
from tablewright.operators import metrics as m
from tablewright.operators.curves import areas_of, pr_points, roc_points, score_counts
from tablewright.operators.encode import feature_importance, feature_info, signature
from tablewright.operators.sampling import hash_split
from tablewright.operators.tuning import (
    TrainingSpec,
    best_model,
    best_params,
    best_per_family,
    cross_validate,
    fit_best,
    tuning_table,
)
from tablewright.sources.documents import write_document
from tablewright.sources.models import save_model
from tablewright.sources.runlog import Run


@dataclass(frozen=True)
class Evaluation:
    """Everything known about a model on held-out rows; the curves keep all their points."""

    metrics: DataFrame
    report: DataFrame
    confusion: DataFrame
    roc: DataFrame
    pr: DataFrame


def evaluate(model: PipelineModel, held_out: DataFrame, label: str) -> Evaluation:
    """Score the rows once, into a table of three columns, and derive every figure from it.

    The running counts over the scores are stored as well: both curves and both areas read them.
    """
    scored = scratch.write_table(
        model.transform(held_out).select(
            F.col(label).cast("double").alias("label"),
            "prediction",
            positive_probability("probability").alias("score"),
        ),
        "evaluation",
    )
    pairs = scratch.write_table(m.pair_counts(scored), "pairs")
    counts = scratch.write_table(score_counts(scored, "score", "label"), "score-counts")
    headline = m.to_long(m.classification_metrics(pairs)).unionByName(m.to_long(areas_of(counts)))
    return Evaluation(
        metrics=scratch.write_table(headline, "metrics"),
        report=m.classification_report(pairs),
        confusion=m.confusion_matrix(pairs),
        roc=roc_points(counts),
        pr=pr_points(counts),
    )


def train(
    df: DataFrame,
    spec: TrainingSpec,
    model_path: str,
    report_path: str,
    run: Run | None = None,
    held_out_share: float = 0.2,
) -> tuple[PipelineModel, Evaluation]:
    """Split, tune every family, fit the best one on all training rows, evaluate and store it.

    Reports go to ``report_path``: metrics, classification report, best parameters, confusion
    matrix, curves, features, signature and (for tree models) importances.
    """
    training, held_out = hash_split(df, spec.key, [1 - held_out_share, held_out_share])
    tuned = scratch.write_table(tuning_table(cross_validate(training, spec)), "tuning")
    best = scratch.write_table(best_model(tuned), "best")
    model = fit_best(training, spec, best)
    save_model(model, model_path)
    result = evaluate(model, held_out, spec.label)

    documents = {
        "metrics": result.metrics,
        "classification_report": m.to_long(result.report),
        "best_params": best_params(best),
        "confusion_matrix": result.confusion,
        "feature_info": feature_info(model, spec.features, df),
        "signature": signature(df, model.transform(df)),
    }
    if hasattr(model.stages[-1], "featureImportances"):
        documents["feature_importance"] = feature_importance(model.stages[-1], model.transform(held_out))
    for name, document in documents.items():
        write_document(document, f"{report_path}/{name}")
    # The curves have a point per distinct score, so they are tables, not documents.
    result.roc.write.mode("overwrite").parquet(f"{report_path}/roc_curve")
    result.pr.write.mode("overwrite").parquet(f"{report_path}/pr_curve")

    if run is not None:
        _log(run, tuned, best, result)
    return model, result


def _log(run: Run, tuned: DataFrame, best: DataFrame, result: Evaluation) -> None:
    for row in best_per_family(tuned).collect():  # one row per family
        with run.child(f"tuning_{row['family']}") as child:
            child.params({"model_type": row["family"]})
            child.metrics({"best_cv_f1_score": row["f1"]})
    winner = best.first()
    run.params({"best_model_type": winner["family"]})
    run.params({r["param"]: r["value"] for r in best_params(best).collect()})
    run.metric_table(result.metrics)
    run.metric_table(m.to_long(result.report))

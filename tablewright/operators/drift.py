"""Distribution drift between a new table and a baseline, and the decision to retrain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType

from tablewright.functions.pvalues import chi2_sf, ks_exact_p, ks_limit_p
from tablewright.operators.prefix import ROWS_PER_BUCKET, long_values, running_counts

# Fixed value: significance level of both tests.
ALPHA = 0.05

REPORT_COLUMNS = ("feature", "kind", "statistic", "dof", "p_value", "drifted")


def shared_features(new: DataFrame, baseline: DataFrame, features: Sequence[str]) -> list[str]:
    """The features that both tables have; a missing one is skipped, not an error."""
    both = set(new.columns) & set(baseline.columns)
    return [f for f in features if f in both]


def ks_drift(
    new: DataFrame,
    baseline: DataFrame,
    features: Sequence[str],
    alpha: float = ALPHA,
    method: str = "corrected",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov test of every numeric feature, in one job over both tables.

    ``method``, at every size: ``corrected`` uses the large-sample law with a finite-size correction, ``limit`` the plain
    one, ``exact`` the exact law (for small samples: its time grows with the product of their sizes). Null and NaN values are
    left out. A feature without values on one side has no statistic and does not count as drifted. Without a shared
    feature the result is empty.
    """
    features = shared_features(new, baseline, features)
    return _ks_of_values(new_values(new, features), base_values(baseline, features), features, alpha, method, rows_per_bucket)


def chi2_drift(new: DataFrame, baseline: DataFrame, features: Sequence[str], alpha: float = ALPHA) -> DataFrame:
    """Chi-squared test of homogeneity of every categorical feature, in one job over both tables."""
    return chi2_from_counts(contingency(new, baseline, features), alpha)


def contingency(new: DataFrame, baseline: DataFrame, features: Sequence[str]) -> DataFrame:
    """Counts per feature and category on both sides, zero where a side lacks the category.

    The sides are tagged and counted together, so no join is needed and null is a category.
    """
    features = shared_features(new, baseline, features)
    return side_sums(new_categories(new, features).unionByName(base_categories(baseline, features)))


def chi2_from_counts(counts: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """The test on a contingency table; with one degree of freedom it uses Yates' correction.

    One category gives statistic 0 and p 1. An empty side gives no statistic and no p-value.
    """
    # One row per feature: a bounded broadcast.
    totals = counts.groupBy("feature").agg(
        F.sum("n_new").alias("total_new"), F.sum("n_base").alias("total_base"), (F.count(F.lit(1)) - 1).alias("dof")
    )
    per_category = counts.join(F.broadcast(totals), "feature")
    total = F.col("total_new") + F.col("total_base")
    share = (F.col("n_new") + F.col("n_base")) / total

    def cell(observed: str, side_total: str) -> Column:
        expected = share * F.col(side_total)
        off = F.abs(F.col(observed) - expected)
        off = off - F.when(F.col("dof") == 1, F.least(F.lit(0.5), off)).otherwise(F.lit(0.0))
        return off * off / expected

    both = (F.col("total_new") > 0) & (F.col("total_base") > 0)
    result = per_category.groupBy("feature", "dof").agg(
        F.sum(F.when(both, cell("n_new", "total_new") + cell("n_base", "total_base"))).alias("raw"),
        F.max("total_new").alias("n_new"),
        F.max("total_base").alias("n_base"),
    )
    return (
        result.withColumn("statistic", F.when((F.col("dof") == 0) & F.col("raw").isNotNull(), 0.0).otherwise(F.col("raw")))
        .drop("raw")
        .withColumn("p_value", F.when(F.col("statistic").isNull(), F.lit(None)).when(F.col("dof") == 0, F.lit(1.0)).otherwise(chi2_sf(F.col("statistic"), F.col("dof"))))
        .withColumn("drifted", _drifted(alpha))
    )


def drift_report(
    new: DataFrame,
    baseline: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    alpha: float = ALPHA,
    method: str = "corrected",
) -> DataFrame:
    """One row per feature: kind of test, statistic, degrees of freedom, p-value, drifted or not."""
    parts = []
    if shared_features(new, baseline, numeric):
        parts.append(ks_rows(ks_drift(new, baseline, numeric, alpha, method)))
    if shared_features(new, baseline, categorical):
        parts.append(chi2_rows(chi2_drift(new, baseline, categorical, alpha)))
    return one_report(parts)


def drift_verdict(report: DataFrame) -> DataFrame:
    """One row: did any feature drift, and how many."""
    return report.agg(
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drift_detected"),
        F.count_if("drifted").alias("n_drifted"),
        F.count(F.lit(1)).alias("n_features"),
    )


def retrain_gate(verdict: DataFrame, model_exists: bool) -> DataFrame:
    """One row with the decision: train on drift, or when there is no model yet."""
    exists = F.lit(model_exists)
    return verdict.select(
        "drift_detected",
        exists.alias("model_exists"),
        F.when(F.col("drift_detected") | ~exists, "train").otherwise("skip").alias("action"),
        F.when(F.col("drift_detected") & ~exists, "drift and no model")
        .when(F.col("drift_detected"), "drift")
        .when(~exists, "no model")
        .otherwise("no drift and a model exists")
        .alias("reason"),
    )


def _drifted(alpha: float) -> Column:
    return F.coalesce(F.col("p_value") < alpha, F.lit(False))


def _ks_of_values(
    new_values: DataFrame, base_values: DataFrame, features: Sequence[str], alpha: float, method: str, rows_per_bucket: int
) -> DataFrame:
    check_method(method)
    counts = running_counts(new_values.unionByName(base_values), ["new", "base"], rows_per_bucket)
    gap = F.abs(F.col("new_upto") / F.col("new_total") - F.col("base_upto") / F.col("base_total"))
    both = (F.col("new_total") > 0) & (F.col("base_total") > 0)
    result = counts.groupBy("feature").agg(
        F.max(F.when(both, gap)).alias("statistic"),
        F.max("new_total").alias("n_new"),
        F.max("base_total").alias("n_base"),
    )
    return ks_verdicts(result, features, alpha, method)


def check_method(method: str) -> None:
    if method not in ("corrected", "limit", "exact"):
        raise ValueError(f"unknown method {method!r}")


def ks_verdicts(measured: DataFrame, features: Sequence[str], alpha: float, method: str) -> DataFrame:
    """Adds p-value and verdict to rows (feature, statistic, n_new, n_base); features without any value get a row, too."""
    names = measured.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    result = names.join(measured, "feature", "left").withColumns({n: F.coalesce(n, F.lit(0).cast("long")) for n in ("n_new", "n_base")})
    sizes = F.col("statistic"), F.col("n_new"), F.col("n_base")
    p = ks_exact_p(*sizes) if method == "exact" else ks_limit_p(*sizes, corrected=method == "corrected")
    return result.withColumn("p_value", p).withColumn("drifted", _drifted(alpha))


def new_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return long_values(df, features, {"new": F.lit(1), "base": F.lit(0)})


def base_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return long_values(df, features, {"new": F.lit(0), "base": F.lit(1)})


def new_categories(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return _long_categories(df, features, 1, 0)


def base_categories(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return _long_categories(df, features, 0, 1)


def _long_categories(df: DataFrame, features: Sequence[str], new: int, base: int) -> DataFrame:
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, category string, new long, base long")
    entries = [F.struct(F.lit(f).alias("feature"), _category_text(df, f).alias("category")) for f in features]
    return df.select(
        F.inline(F.array(*entries)), F.lit(new).cast("long").alias("new"), F.lit(base).cast("long").alias("base")
    )


def _category_text(df: DataFrame, feature: str) -> Column:
    """Category as text; a whole number reads the same whether it is stored as integer or double."""
    c = F.col(feature)
    if isinstance(df.schema[feature].dataType, FractionalType):
        c = c.cast("double")
        whole = (c == F.floor(c)) & (F.abs(c) < 2.0**53)
        return F.when(whole, c.cast("long").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def side_sums(long: DataFrame) -> DataFrame:
    return long.groupBy("feature", "category").agg(F.sum("new").alias("n_new"), F.sum("base").alias("n_base"))


def ks_rows(ks: DataFrame) -> DataFrame:
    return ks.withColumns({"kind": F.lit("ks"), "dof": F.lit(None).cast("long")}).select(*REPORT_COLUMNS)


def chi2_rows(chi2: DataFrame) -> DataFrame:
    return chi2.withColumn("kind", F.lit("chi2")).select(*REPORT_COLUMNS)


def one_report(parts: Sequence[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("the tables share none of the features")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

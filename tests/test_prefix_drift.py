import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from tablewright.functions.pvalues import gamma_upper_ratio, kolmogorov_sf, ks_exit_probability
from tablewright.operators.baseline import StoredBaseline
from tablewright.operators.drift import (
    chi2_drift,
    chi2_from_counts,
    contingency,
    drift_report,
    drift_verdict,
    ks_drift,
    retrain_gate,
)
from tablewright.operators.prefix import long_values, prefix_counts, range_parts

NAN = float("nan")


def values_frame(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")


def brute_prefix(values):
    kept = sorted(v + 0.0 for v in values if v is not None and not math.isnan(v))
    return [(v, kept.count(v), sum(1 for w in kept if w <= v), len(kept)) for v in sorted(set(kept))]


def brute_ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 50, 7, 1])
def test_buckets_do_not_change_running_counts(spark, rows_per_bucket):
    rng = np.random.default_rng(3)
    values = [*rng.normal(size=300), *[0.5] * 200, *[0.0, -0.0] * 20, None, NAN, math.inf, -math.inf, math.inf]
    got = prefix_counts(values_frame(spark, values), ["x"], {"n": F.lit(1)}, rows_per_bucket)
    assert sorted(tuple(r)[1:] for r in got.collect()) == brute_prefix(values)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(width=32), st.integers(-3, 3).map(float)), min_size=1, max_size=60))
def test_bucketed_equals_brute_force(spark, values):
    got = prefix_counts(values_frame(spark, values), ["x"], {"n": F.lit(1)}, 5)
    assert sorted(tuple(r)[1:] for r in got.collect()) == brute_prefix(values)


def test_several_features_with_own_totals(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, None), (2.0, 7)], "a double, b int")
    got = {(r["feature"], r["value"]): (r["w_upto"], r["w_total"]) for r in prefix_counts(df, ["a", "b"], {"w": F.lit(2)}).collect()}
    assert got == {("a", 1.0): (2, 6), ("a", 2.0): (6, 6), ("b", 5.0): (2, 4), ("b", 7.0): (4, 4)}


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 40])
def test_ks_statistic_is_the_largest_gap(spark, rows_per_bucket):
    rng = np.random.default_rng(5)
    a = [round(v, 1) for v in rng.normal(size=150)]
    b = [round(v, 1) for v in rng.normal(0.4, 1.3, size=220)]
    row = ks_drift(values_frame(spark, [*a, None, NAN]), values_frame(spark, b), ["x"], rows_per_bucket=rows_per_bucket).first()
    assert row["statistic"] == pytest.approx(brute_ks(a, b), abs=1e-12)
    assert (row["n_new"], row["n_base"]) == (150, 220)


def test_ks_against_itself_and_against_nothing(spark):
    df = values_frame(spark, range(50))
    row = ks_drift(df, df, ["x"]).first()
    assert (row["statistic"], row["p_value"], row["drifted"]) == (0.0, 1.0, False)
    row = ks_drift(values_frame(spark, [None]), df, ["x"]).first()
    assert (row["statistic"], row["p_value"], row["drifted"]) == (None, None, False)


def test_exact_p_value_against_all_orders():
    """Every merge order of 4 and 3 values, counted one by one."""
    from itertools import combinations

    n, m = 4, 3
    gaps = []
    for first in combinations(range(n + m), n):
        i = j = 0
        worst = 0.0
        for position in range(n + m):
            i, j = (i + 1, j) if position in first else (i, j + 1)
            worst = max(worst, abs(i / n - j / m))
        gaps.append(worst)
    for d in sorted(set(gaps)):
        assert ks_exit_probability(d, n, m) == pytest.approx(sum(g >= d - 1e-12 for g in gaps) / len(gaps))


def test_exact_p_value_nears_the_limit_law(spark):
    lam = 1.3581  # 5% point of the limit law
    limit = spark.range(1).select(kolmogorov_sf(F.lit(lam))).first()[0]
    assert limit == pytest.approx(0.05, abs=1e-6)
    n = m = 4000
    d = round(lam / math.sqrt(n / 2) * n) / n
    assert ks_exit_probability(d, n, m) == pytest.approx(0.05, abs=0.003)


def test_large_samples_use_the_corrected_law(spark):
    new = spark.range(12_000).select((F.col("id") / 12_000 + 0.012).alias("x"))
    base = spark.range(20_000).select((F.col("id") / 20_000).alias("x"))
    auto, limit = (ks_drift(new, base, ["x"], method=m).first() for m in ("corrected", "limit"))
    en = 12_000 * 20_000 / 32_000
    lam = auto["statistic"] * math.sqrt(en)
    # The one-sample law at size en is the limit law at lam + 1/(6 sqrt(en)), to this order.
    shifted = spark.range(1).select(kolmogorov_sf(F.lit(lam + 1 / (6 * math.sqrt(en))))).first()[0]
    assert auto["p_value"] == pytest.approx(shifted, rel=2e-3)
    assert limit["p_value"] > auto["p_value"]


def test_chi2_tail_against_closed_forms():
    for x in (0.01, 0.5, 2.0506149, 9.5, 60.0):
        assert gamma_upper_ratio(0.5, x / 2) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-10)
        assert gamma_upper_ratio(1.0, x / 2) == pytest.approx(math.exp(-x / 2), rel=1e-10)
        assert gamma_upper_ratio(2.0, x / 2) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-10)
    assert gamma_upper_ratio(2.0, 2.0506149 / 2) == pytest.approx(0.7264497713478, abs=1e-7)
    # 5% points from published tables.
    for dof, point in ((1, 3.841458820694124), (10, 18.307038053275), (100, 124.342113404)):
        assert gamma_upper_ratio(dof / 2, point / 2) == pytest.approx(0.05, rel=1e-8)
    # A large number of degrees of freedom is close to normal.
    assert gamma_upper_ratio(500_000.0, 500_000.0) == pytest.approx(0.5, abs=0.001)


def test_chi2_equals_the_built_in_test(spark):
    rng = np.random.default_rng(11)
    data = [(int(i < 300), str(c)) for i, c in enumerate(rng.choice(list("abcd"), size=1000, p=[0.4, 0.3, 0.2, 0.1]))]
    df = spark.createDataFrame(data, "side int, c string")
    ours = chi2_drift(df.where("side = 1"), df.where("side = 0"), ["c"]).first()
    indexed = StringIndexer(inputCol="c", outputCol="i").fit(df).transform(df)
    vectors = VectorAssembler(inputCols=["i"], outputCol="f").transform(indexed)
    builtin = ChiSquareTest.test(vectors, "f", "side").first()
    assert ours["statistic"] == pytest.approx(builtin["statistics"][0])
    assert ours["p_value"] == pytest.approx(builtin["pValues"][0])
    assert ours["dof"] == builtin["degreesOfFreedom"][0] == 3


def test_chi2_corrections_and_edges(spark):
    counts = spark.createDataFrame(
        [("two", "a", 10, 20), ("two", "b", 20, 10), ("one", "a", 5, 7), ("empty", "a", 0, 7), ("empty", "b", 0, 2)],
        "feature string, category string, n_new bigint, n_base bigint",
    )
    got = {r["feature"]: r for r in chi2_from_counts(counts).collect()}
    assert got["two"]["statistic"] == pytest.approx(4 * (5 - 0.5) ** 2 / 15)  # Yates
    assert (got["one"]["statistic"], got["one"]["p_value"], got["one"]["drifted"]) == (0.0, 1.0, False)
    assert (got["empty"]["statistic"], got["empty"]["p_value"], got["empty"]["drifted"]) == (None, None, False)


def test_contingency_aligns_null_and_absent_categories(spark, rows):
    new = spark.createDataFrame([("a",), (None,)], "c string")
    base = spark.createDataFrame([("b",), (None,), (None,)], "c string")
    assert rows(contingency(new, base, ["c", "absent"])) == [("c", "a", 1, 0), ("c", "b", 0, 1), ("c", None, 1, 2)]


def test_number_categories_match_across_types(spark, rows):
    new = spark.createDataFrame([(1,), (2,)], "c int")
    base = spark.createDataFrame([(1.0,), (2.5,)], "c double")
    assert rows(contingency(new, base, ["c"])) == [("c", "1", 1, 1), ("c", "2", 1, 0), ("c", "2.5", 0, 1)]


@pytest.fixture(scope="module")
def passengers(spark):
    return spark.range(600).selectExpr(
        "CAST(20 + id % 41 AS DOUBLE) AS age",
        "CAST(5 + (id * 7) % 90 AS DOUBLE) AS fare",
        "CAST(1 + id % 3 AS DOUBLE) AS class",
        "CASE WHEN id % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
    )


@pytest.mark.parametrize(
    "changed, drifted",
    [
        ({}, set()),
        ({"age": "age + 30"}, {"age"}),
        ({"age": "age + 25 + pmod(hash(fare), 16)"}, {"age"}),
        ({"fare": "fare * (3 + pmod(hash(age, fare), 3))"}, {"fare"}),
        ({"class": "1.0D"}, {"class"}),
    ],
)
def test_drift_scenarios(spark, passengers, changed, drifted):
    new = passengers.limit(150).withColumns({c: F.expr(e) for c, e in changed.items()})
    numeric, categorical = ["age", "fare", "absent"], ["class", "sex", "absent"]
    report = drift_report(new, passengers, numeric, categorical)
    assert {r["feature"] for r in report.collect() if r["drifted"]} == drifted
    assert report.count() == 4
    stored = StoredBaseline.build(passengers, numeric, categorical).report(new)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, report.collect()))
    assert drift_verdict(report).first()["drift_detected"] == bool(drifted)


def test_no_shared_feature_is_an_error(spark, passengers):
    with pytest.raises(ValueError):
        drift_report(passengers, passengers, ["x"], ["y"])


@pytest.mark.parametrize(
    "drift, exists, action", [(True, True, "train"), (True, False, "train"), (False, False, "train"), (False, True, "skip")]
)
def test_gate(spark, drift, exists, action):
    verdict = spark.createDataFrame([(drift,)], "drift_detected boolean")
    assert retrain_gate(verdict, exists).first()["action"] == action


def test_features_of_uneven_size_share_even_buckets(spark):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("large"), F.expr("CASE WHEN id < 300 THEN CAST(id AS DOUBLE) END").alias("small"))
    counted = long_values(df, ["large", "small"], {"n": F.lit(1)})
    placed = range_parts(counted, ["n"], 21)
    sizes = {r["bucket"]: r["count"] for r in placed.groupBy("bucket").count().collect()}
    assert len(sizes) == 21 and max(sizes.values()) < 2_000
    got = prefix_counts(df, ["large", "small"], {"n": F.lit(1)}, 1_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The stored parts are read as they lie: only the offsets, one row per part, move.
    assert "SortMergeJoin" not in plan and plan.count("value-buckets") == 2
    assert got.count() == 20_300 and got.where("n_upto <> value + 1 OR n_total <> if(feature = 'large', 20000, 300)").isEmpty()

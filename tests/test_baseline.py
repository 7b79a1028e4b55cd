import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import baseline as stored_baseline
from tablewright.operators.baseline import StoredBaseline
from tablewright.operators.drift import ks_drift


def frame(spark, columns):
    n = max(map(len, columns.values()))
    rows = [tuple(float(c[i]) if i < len(c) else None for c in columns.values()) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))


def cases():
    rng = np.random.default_rng(5)
    base = rng.normal(0, 1, 900)
    yield "same law", {"x": base, "y": rng.integers(0, 9, 900)}, {"x": rng.normal(0, 1, 300), "y": rng.integers(0, 9, 300)}
    yield "moved", {"x": base, "y": np.arange(900)}, {"x": base[:200] + 0.7, "y": np.arange(0, 900, 9)}
    yield "apart", {"x": base, "y": np.arange(50)}, {"x": base + 100, "y": np.arange(-50, 0)}
    yield "one value", {"x": [1.0] * 40 + [2.0] * 3, "y": [5.0]}, {"x": [1.0] * 7, "y": [5.0]}
    yield "one side empty", {"x": base[:50], "y": []}, {"x": [], "y": [1.0, 2.0]}
    yield "inside one bucket", {"x": np.arange(1000), "y": np.arange(1000)}, {"x": [500.5, 500.6, 501.0], "y": [499.0, 500.0]}
    yield "ends of buckets", {"x": np.arange(100), "y": np.repeat(np.arange(10), 10)}, {"x": [9, 19, 29, 99], "y": [0, 9]}


@pytest.mark.parametrize("rows_per_bucket, sent_values", [(7, 100_000), (7, 0), (100_000, 100_000)])
def test_statistics_equal_those_of_both_tables(spark, rows, rows_per_bucket, sent_values):
    """All cases at once, as features of one table."""
    base, new = ({f"{name} {c}".replace(" ", "_"): v for name, *sides in cases() for c, v in sides[i].items()} for i in (0, 1))
    features = list(base)
    base, new = frame(spark, base), frame(spark, new)
    found = StoredBaseline.build(base, features, [], rows_per_bucket).ks(new, features, sent_values=sent_values)
    assert rows(found) == rows(ks_drift(new, base, features).select(*found.columns))


def shuffled(spark, action):
    """Rows that all stages of an action wrote to shuffles."""
    context = spark.sparkContext._jsc.sc()

    def stages():
        context.listenerBus().waitUntilEmpty(30_000)
        found = context.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(min(found.size(), 200))}

    before = max(stages(), default=-1)  # the latest stages come first
    action()
    return sum(n for stage, n in stages().items() if stage > before)


def test_what_a_batch_shuffles_depends_on_the_batch(spark):
    moved = []
    for n in (2_000, 40_000):
        base = spark.range(n).select((F.col("id") / n).alias("x"))
        stored = StoredBaseline.build(base, ["x"], [], rows_per_bucket=n // 10)
        new = spark.range(0, n, n // 100).select((F.col("id") / n).alias("x"))
        moved.append(shuffled(spark, lambda: stored.ks(new, ["x"]).collect()))
    assert 0 < moved[1] <= 1.2 * moved[0] and moved[1] < 2_000


def test_buckets_that_cannot_hold_the_largest_gap_are_not_read(spark):
    base = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    stored = StoredBaseline.build(base, ["x"], [], rows_per_bucket=100)
    read = []
    exact = StoredBaseline._exact
    try:
        StoredBaseline._exact = lambda self, batch, chosen, sent: read.append(chosen.count()) or exact(self, batch, chosen, sent)
        row = stored.ks(spark.range(4_000, 9_000, 5).select(F.col("id").cast("double").alias("x")), ["x"]).first()
    finally:
        StoredBaseline._exact = exact
    assert row["statistic"] == pytest.approx(0.4) and 0 < read[0] <= 5
    assert stored_baseline.BASELINE_BUCKET > 1


def test_batches_with_and_without_categories(spark):
    base = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, None)], "x double, c string")
    stored = StoredBaseline.build(base, ["x", "absent"], ["c"])
    assert [r["feature"] for r in stored.report(base.drop("c")).collect()] == ["x"]
    assert [r["p_value"] for r in stored.report(base.drop("x")).collect()] == [1.0]
    assert stored.report(base.where("false")).where("statistic IS NOT NULL OR drifted").isEmpty()
    with pytest.raises(ValueError):
        stored.ks(base, ["x"], method="typo")

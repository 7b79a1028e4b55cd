import math
import re

import pytest
from pyspark.sql import functions as F

from tablewright import scratch
from tablewright.operators.impute import (
    FillModel,
    FillSpec,
    column_mode,
    fill_group_mean,
    fill_mean,
    fill_mode,
    group_means,
    join_group_stats,
)

SCHEMA = "id int, g string, v double"


@pytest.fixture(scope="module")
def gaps(spark):
    data = [(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, None, None), (5, "b", None), (6, None, 9.0)]
    return spark.createDataFrame(data, SCHEMA)


def test_group_mean_fill(gaps, rows):
    # A null group and a group without values stay null.
    filled = fill_group_mean(gaps, "g", "v")
    assert rows(filled, "id", "v") == [(1, 1.0), (2, 3.0), (3, 2.0), (4, None), (5, None), (6, 9.0)]


def test_nan_is_a_value_unless_asked_otherwise(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", float("nan")), (3, "a", None)], SCHEMA)
    plain = {r["id"]: r["v"] for r in fill_group_mean(df, "g", "v").collect()}
    assert math.isnan(plain[2]) and math.isnan(plain[3])
    aware = {r["id"]: r["v"] for r in fill_group_mean(df, "g", "v", nan_as_missing=True).collect()}
    assert aware == {1: 1.0, 2: 1.0, 3: 1.0}
    assert {r["id"]: r["v"] for r in fill_mean(df, "v", nan_as_missing=True).collect()} == {1: 1.0, 2: 1.0, 3: 1.0}


def test_mean_fill_replaces_null_and_nan(spark):
    fit = spark.createDataFrame([(1, "a", 2.0), (2, "a", 4.0)], SCHEMA)
    df = spark.createDataFrame([(1, "a", None), (2, "a", float("nan")), (3, "a", 5.0)], SCHEMA)
    assert sorted(r["v"] for r in fill_mean(df, "v", fit_on=fit).collect()) == [3.0, 3.0, 5.0]


def test_mode_tie_takes_the_smallest_and_all_null_fills_nothing(spark):
    tie = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "g string")
    assert column_mode(tie, "g").first()["g"] == "a"
    assert [r["g"] for r in fill_mode(tie, "g").collect()].count("a") == 3
    empty = spark.createDataFrame([(None,), (None,)], "g string")
    assert [r["g"] for r in fill_mode(empty, "g").collect()] == [None, None]


def test_model_fills_like_the_single_fills(gaps, rows):
    spec = FillSpec(group_mean={"filled": ("g", "v")}, mean=("v",), mode=("g",))
    out = FillModel.fit(gaps, spec).apply(gaps)
    mean = (1.0 + 3.0 + 9.0) / 3
    got = {r["id"]: (r["g"], r["v"], r["filled"]) for r in out.collect()}
    assert got[3] == ("a", pytest.approx(mean), 2.0)
    assert got[4] == ("a", pytest.approx(mean), None)
    assert got[5] == ("b", pytest.approx(mean), None)


def test_model_with_global_fallback(gaps):
    spec = FillSpec(group_mean={"filled": ("g", "v")}, global_fallback=True)
    got = {r["id"]: r["filled"] for r in FillModel.fit(gaps, spec).apply(gaps).collect()}
    assert got[3] == 2.0 and got[4] == pytest.approx(13 / 3) and got[5] == pytest.approx(13 / 3)


def test_model_without_groups_and_with_number_keys(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (2, 5, None), (3, None, 3.0)], "id int, g int, v double")
    only_mean = FillModel.fit(df, FillSpec(mean=("v",))).apply(df)
    assert {r["id"]: r["v"] for r in only_mean.collect()} == {1: 1.0, 2: 2.0, 3: 3.0}
    both = FillModel.fit(df, FillSpec(group_mean={"w": ("g", "v")}, mode=("g",))).apply(df)
    assert {r["id"]: (r["g"], r["w"]) for r in both.collect()} == {1: (5, 1.0), 2: (5, 1.0), 3: (5, 3.0)}
    assert both.schema["g"].dataType.simpleString() == "int"


def test_model_on_an_empty_table_fills_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    rows = spark.createDataFrame([(1, None, None)], SCHEMA)
    spec = FillSpec(group_mean={"w": ("g", "v")}, mean=("v",), mode=("g",))
    assert FillModel.fit(empty, spec).apply(rows).first().asDict() == {"id": 1, "g": None, "v": None, "w": None}


def test_saved_model_gives_the_same(spark, gaps, rows, tmp_path):
    spec = FillSpec(group_mean={"w": ("g", "v")}, mean=("v",), mode=("g",))
    fitted = FillModel.fit(gaps, spec)
    fitted.save(str(tmp_path / "fills"))
    loaded = FillModel.load(spark, str(tmp_path / "fills"), spec)
    assert rows(loaded.apply(gaps), "id", "g", "v", "w") == rows(fitted.apply(gaps), "id", "g", "v", "w")


def test_skewed_join_beyond_the_broadcast_limit(spark, rows):
    """A third of the rows in one group, a third without a group, the rest in many small groups."""
    df = spark.range(30_000).select(
        "id",
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('g', id % 5000) END").alias("g"),
        F.expr("CASE WHEN id % 4 = 0 THEN NULL ELSE CAST(id % 97 AS DOUBLE) END").alias("v"),
    )
    stats = scratch.write_table(group_means(df, "g", "v"), "stats")
    small = join_group_stats(df, stats, "g", ["mean_v"], "n_rows")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = join_group_stats(df, stats, "g", ["mean_v"], "n_rows", broadcast_bytes=0, target_rows=5_000)
        assert large.columns == small.columns
        assert large.count() == 30_000
        assert large.exceptAll(small).isEmpty() and small.exceptAll(large).isEmpty()
        # Both sides are shuffled by group and spread number, so hot and null rows share no partition.
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"hashpartitioning\(g#\d+, _spread#\d+, ", plan)) >= 2, plan
        assert "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

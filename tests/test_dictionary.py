import os

import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tablewright.operators import encode
from tablewright.operators.dictionary import build_dictionary, with_index, with_sparse_vector

FOLDER = entry.SMOKE_FOLDER


@pytest.mark.parametrize("table, column", [("part", "p_brand"), ("part", "p_name"), ("orders", "o_orderpriority"), ("orders", "o_custkey")])
@pytest.mark.parametrize("rows_per_part", [7, 1_000_000])
def test_indices_equal_the_built_in_indexer(spark, table, column, rows_per_part):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet").select(F.col(column).cast("string").alias("c"))
    rows = rows.unionByName(spark.createDataFrame([(None,)], "c string"))
    known = build_dictionary(rows.where("c IS NOT NULL"), "c", rows_per_part)
    fitted = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(rows.where("c IS NOT NULL"))
    assert [r["category"] for r in known.table.orderBy("idx").collect()] == fitted.labels
    assert with_index(rows, known, "i").exceptAll(fitted.transform(rows)).isEmpty()


def test_hot_unknown_and_null_categories(spark, rows):
    fit_on = spark.createDataFrame([("a",)] * 50 + [("b",)] * 2 + [("c",)] * 2 + [(None,)] * 9, "c string")
    known = build_dictionary(fit_on, "c")
    assert rows(known.table) == [("a", 0, 50), ("b", 1, 2), ("c", 2, 2)]
    asked = spark.createDataFrame([(1, "a", 7.0), (2, "b", 7.0), (3, "z", 7.0), (4, None, 7.0)], "id int, c string, _rows double")
    for options in ({}, {"broadcast_bytes": 0, "target_rows": 5}, {"broadcast_bytes": 0, "target_rows": 1000}):
        found = with_index(asked, known, "i", **options)
        assert found.columns == ["id", "c", "_rows", "i"]
        assert rows(found, "id", "i") == [(1, 0.0), (2, 1.0), (3, 3.0), (4, 3.0)]


def test_hot_and_null_categories_leave_the_shuffle_key(spark):
    fit_on = spark.range(1000).select(F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id) END").alias("c"))
    plan = with_index(fit_on, build_dictionary(fit_on, "c"), "i", broadcast_bytes=0, target_rows=100)._jdf.queryExecution().toString()
    assert "_spread" in plan and "StringIndexer" not in plan


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "c string, x double")
    known = build_dictionary(empty, "c")
    assert known.size == 0 and known.table.count() == 0
    some = spark.createDataFrame([("a", 1.0)], "c string, x double")
    assert [r["i"] for r in with_index(some, known, "i").collect()] == [0.0]
    vectors = with_sparse_vector(with_index(some, known, "i"), ["x"], [("i", known)])
    assert vectors.select(vector_to_array("features").alias("v")).first()["v"] == [1.0]
    assert with_sparse_vector(empty, [], []).count() == 0


def test_vectors_equal_those_of_the_feature_stages(spark):
    fit_on = spark.createDataFrame([(1.0, "b", "u"), (2.0, "b", "v"), (0.0, "a", "v"), (1.0, "c", None)], "x double, c string, d string")
    df = fit_on.unionByName(spark.createDataFrame([(3.0, "z", "u"), (None, "a", "u"), (float("nan"), "a", "u"), (4.0, None, None)], fit_on.schema))
    spec = encode.FeatureSpec(numeric=("x",), categorical=("c", "d"))
    theirs = encode.fit_features(fit_on, spec).transform(df)
    known = {c: build_dictionary(fit_on, c) for c in ("c", "d")}
    indexed = with_index(with_index(df, known["c"], "ci"), known["d"], "di")
    ours = with_sparse_vector(indexed, ["x"], [("ci", known["c"]), ("di", known["d"])])
    assert ours.schema["features"].dataType == theirs.schema["features"].dataType
    arrays = [sorted(map(str, (r["v"] for r in t.select(vector_to_array("features").alias("v")).collect()))) for t in (ours, theirs)]
    assert arrays[0] == arrays[1] and len(arrays[0]) == 6
    # Spark's own stages take them.
    assert VectorAssembler(inputCols=["features", "ci"], outputCol="all").transform(ours).count() == 6

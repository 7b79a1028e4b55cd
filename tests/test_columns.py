import math

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablewright.functions.columns import decode_label, positive_probability, tolerant_double
from tablewright.operators.clean import align_to, cast_numeric, labelled, misfit_rows, union_by_name, unlabelled
from tablewright.operators.features import with_group_size, with_title

# The two example passengers.
NAMES = ["Cumings, Mrs. John Bradley (Florence Briggs Thayer)", "Heikkinen, Mr. Lauri"]


def test_tolerant_cast_keeps_numbers_and_nulls_the_rest(spark, rows):
    df = spark.createDataFrame([("1",), (" 2.5 ",), ("x",), ("",), (None,), ("1e3",), ("NaN",)], "t string")
    values = [r[0] for r in df.select(tolerant_double("t")).collect()]
    assert values[:6] == [1.0, 2.5, None, None, None, 1000.0]
    assert math.isnan(values[6])


def test_cast_skips_absent_columns_and_keeps_order(spark):
    df = spark.createDataFrame([("1", "a")], "n string, s string")
    out = cast_numeric(df, ["n", "absent"])
    assert out.columns == ["n", "s"]
    assert out.first()["n"] == 1.0


def test_titles(spark):
    df = spark.createDataFrame([(n,) for n in [*NAMES, "no title here", "", None, "A, B. C, D. E"]], "name string")
    titles = [r["Title"] for r in with_title(df, "name").collect()]
    assert titles == ["Mrs", "Mr", "Other", "Other", None, "B"]


def test_group_size_and_flag(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 0.0)], "a double, b double")
    out = with_group_size(df, ["a", "b"]).collect()
    assert [r["FamilySize"] for r in out] == [2.0, 1.0, None]
    assert [r["IsAlone"] for r in out] == [0, 1, 0]


def test_probability_and_label(spark):
    df = spark.createDataFrame([(Vectors.dense(0.25, 0.75), 1.0), (Vectors.dense(1.0, 0.0), 0.0)], ["probability", "p"])
    out = df.select(positive_probability().alias("x"), decode_label("p", "yes", "no").alias("t")).collect()
    assert [tuple(r) for r in out] == [(0.75, "yes"), (0.0, "no")]


def test_union_by_name_fills_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2.0, 2)], "s string, v double, id int")
    assert rows(union_by_name(a, b), "id", "s", "v") == [(1, "x", None), (2, "y", 2.0)]


def test_malformed_label_moves_to_the_unlabelled_part(spark):
    df = cast_numeric(spark.createDataFrame([(1, "1"), (2, "bad"), (3, None)], "id int, y string"), ["y"])
    assert [r["id"] for r in labelled(df, "y").collect()] == [1]
    assert sorted(r["id"] for r in unlabelled(df, "y").collect()) == [2, 3]


def test_align_orders_casts_and_rejects_unknown(spark):
    import pytest

    target = spark.createDataFrame([], "id bigint, v double, s string").schema
    batch = spark.createDataFrame([("x", "7"), ("y", "bad")], "s string, id string")
    out = align_to(batch, target, misfits="null")
    assert out.schema.simpleString() == target.simpleString()
    assert [tuple(r) for r in out.collect()] == [(7, None, "x"), (None, None, "y")]
    with pytest.raises(Exception, match="does not fit column id: bad"):
        align_to(batch, target).collect()
    assert [tuple(r) for r in align_to(batch.where("id = '7'"), target).collect()] == [(7, None, "x")]
    assert [tuple(r) for r in misfit_rows(batch, target).collect()] == [("y", "bad", ["id"])]
    with pytest.raises(ValueError, match="extra"):
        align_to(batch.withColumn("extra", F.lit(1)), target)

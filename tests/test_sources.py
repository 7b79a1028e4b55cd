import pytest
from pyspark.sql import functions as F

from tablewright.sources.runlog import Run, read_runs
from tablewright.sources.tables import append_batch, read_appended, read_csv, read_csv_accounted

LINES = ["a,b", "1,x", "foo,y", "2,z,9", "3", "", '4,"q,r"', ",", "5,"]


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(path)


def test_rows_and_rejects_are_all_records(spark, rows, tmp_path, csv):
    kept, rejects = read_csv_accounted(spark, csv, "a int, b string", str(tmp_path / "rejects"))
    assert rows(kept) == [(1, "x"), (4, "q,r"), (5, None), (None, None)]
    assert rows(rejects, "record") == [("2,z,9",), ("3",), ("foo,y",)]
    assert all(r["file"].endswith("in.csv") for r in rejects.collect())
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 3
    # A second reading replaces the side table.
    read_csv_accounted(spark, csv, "a int, b string", str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 3
    # Any set of columns gives the same rows.
    assert kept.select("b").count() == 4


def test_malformed_records_are_errors_by_default(spark, csv, tmp_path):
    for action in (lambda df: df.collect(), lambda df: df.select("b").collect(), lambda df: df.count()):
        with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
            action(read_csv(spark, csv, "a int, b string"))
    fine = tmp_path / "fine.csv"
    fine.write_text("a,b\n1,x\n", encoding="utf-8")
    assert read_csv(spark, str(fine), "a int, b string").collect() == [(1, "x")]


def test_column_named_like_the_record(spark, rows, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("_record,row\n1,2\n1,2,3\n", encoding="utf-8")
    kept, rejects = read_csv_accounted(spark, str(path), "_record string, row int")
    assert rows(kept) == [("1", 2)] and rows(rejects, "record") == [("1,2,3",)]


def test_empty_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n", encoding="utf-8")
    kept, rejects = read_csv_accounted(spark, str(path), "a int, b string")
    assert kept.count() == 0 and rejects.count() == 0


def test_replayed_batches_leave_one_copy(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    schema = spark.createDataFrame([], "id long, s string").schema
    first, second = (spark.range(n, n + 3).select(F.lit(None).cast("string").alias("s"), "id") for n in (0, 10))
    append_batch(first, path, schema, batch_id="2024-01-01")
    append_batch(second, path, schema, batch_id="2024-01-02")
    append_batch(second, path, batch_id="2024-01-02")  # the schema is the table's
    append_batch(second.where("id < 12"), path, schema, batch_id="2024-01-02")
    assert rows(read_appended(spark, path, schema), "id") == [(0,), (1,), (10,), (11,), (2,)]
    assert read_appended(spark, path).columns == ["id", "s"]
    assert rows(read_appended(spark, path, schema, "2024-01-02"), "id") == [(10,), (11,)]
    # Without an id a replay is a second copy.
    plain = str(tmp_path / "plain")
    for _ in range(2):
        append_batch(first, plain, schema)
    assert spark.read.parquet(plain).count() == 6


def test_replayed_runs_leave_one_copy(spark, tmp_path):
    path = str(tmp_path / "runs")
    for value in (1, 2):
        with Run(spark, path, "job", run_id="job-1") as run:
            run.metrics({"score": value})
            for name in ("x", "x", "y"):
                with run.child(name) as child:
                    child.params({"p": name})
    with Run(spark, path, "job") as other:
        other.metrics({"score": 9})
    logged = read_runs(spark, path)
    assert sorted(r["number"] for r in logged.where("key = 'score'").collect()) == [2.0, 9.0]
    assert sorted(r["text"] for r in logged.where("key = 'p'").collect()) == ["x", "x", "y"]
    assert logged.select("run_id").distinct().count() == 5

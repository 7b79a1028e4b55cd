import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablewright import __main__ as cli
from tablewright import presets, scratch, session
from tablewright.operators.impute import FillModel
from tablewright.plans.preprocess import create_baseline, derive, feature_table, preprocess, read_split
from tablewright.plans.score import score_raw
from tablewright.plans.train import train
from tablewright.plans.validate import decide, validate
from tablewright.operators.tuning import TrainingSpec
from tablewright.sources.models import load_model
from tablewright.sources.runlog import Run, read_runs
from tablewright.sources.tables import append_batch, from_rows, read_csv, write_csv
from tablewright.streaming.drift import batch_handler, read_batches, stream_drift
from tablewright.streaming.scoring import stream_score
from tablewright.operators.baseline import StoredBaseline

REQUESTS = [
    dict(Pclass=1, Age=38.0, SibSp=1, Parch=0, Fare=71.2833, Sex="female", Embarked="C",
         Name="Cumings, Mrs. John Bradley (Florence Briggs Thayer)"),
    dict(Pclass=3, Age=35.0, SibSp=0, Parch=0, Fare=8.05, Sex="male", Embarked="S", Name="Heikkinen, Mr. Lauri"),
]


def passenger_rows(spark, first, count):
    """Invented passengers; women and the first class mostly have label 1."""
    base = spark.range(first, first + count).select(
        F.col("id").alias("PassengerId"),
        F.expr("CAST(1 + pmod(hash(id), 3) AS STRING)").alias("Pclass"),
        F.expr("pmod(hash(id, 1), 2) = 0").alias("woman"),
        F.expr("CASE WHEN pmod(hash(id, 2), 6) = 0 THEN NULL ELSE CAST(5 + pmod(hash(id, 3), 60) AS STRING) END").alias("Age"),
        F.expr("CAST(pmod(hash(id, 4), 3) AS STRING)").alias("SibSp"),
        F.expr("CAST(pmod(hash(id, 5), 2) AS STRING)").alias("Parch"),
        F.expr("concat('T', id)").alias("Ticket"),
        F.expr("CASE WHEN pmod(hash(id, 6), 40) = 0 THEN NULL ELSE CAST(5 + pmod(hash(id, 7), 90) AS STRING) END").alias("Fare"),
        F.lit(None).cast("string").alias("Cabin"),
        F.expr("CASE WHEN pmod(hash(id, 8), 50) = 0 THEN NULL ELSE element_at(array('S', 'S', 'C', 'Q'), 1 + pmod(hash(id, 9), 4)) END").alias("Embarked"),
    )
    named = base.withColumns(
        {
            "Sex": F.expr("IF(woman, 'female', 'male')"),
            "Name": F.expr("concat('Family', PassengerId, IF(woman, ', Mrs. ', ', Mr. '), 'Given')"),
            "Survived": F.expr("CAST(CAST(woman AND pmod(hash(PassengerId, 10), 10) > 1 OR Pclass = '1' AND pmod(hash(PassengerId, 11), 2) = 0 AS INT) AS STRING)"),
        }
    )
    columns = [f.split()[0] for f in presets.RAW_SCHEMA.split(", ")]
    return named.select(*columns)


@pytest.fixture(scope="module")
def raw(spark):
    return passenger_rows(spark, 1, 600), passenger_rows(spark, 601, 200).drop("Survived")


SMALL = TrainingSpec(
    features=presets.FEATURES,
    label=presets.LABEL,
    key=presets.KEY,
    grids={"DecisionTree": {"maxDepth": [3]}, "LogisticRegression": {"regParam": [0.01, 0.1]}},
)


def test_example_requests(spark):
    out = derive(from_rows(spark, REQUESTS, presets.REQUEST_SCHEMA), presets.TABLE).collect()
    assert [(r["Title"], r["FamilySize"], r["IsAlone"]) for r in out] == [("Mrs", 2.0, 0), ("Mr", 1.0, 1)]


def test_feature_table_columns(raw):
    table, _ = feature_table(*raw, presets.TABLE)
    assert set(table.columns) == {
        "PassengerId", "Title", "Survived", "Pclass", "Sex", "SibSp", "Parch", "Fare", "Embarked",
        "Age_imputed", "FamilySize", "IsAlone",
    }
    assert table.count() == 800
    assert table.where("Fare IS NULL OR Embarked IS NULL OR Age_imputed IS NULL").isEmpty()
    assert table.where("Survived IS NULL").count() == 200


def test_fit_scope_decides_which_rows_shape_the_fills(spark):
    schema = "PassengerId bigint, Survived string, Pclass string, Name string, Sex string, Age string, SibSp string, Parch string, Fare string, Embarked string"
    one = spark.createDataFrame([(1, "1", "1", "A, Mr. B", "male", "20", "0", "0", "10", "S"), (2, "0", "1", "A, Mr. B", "male", None, "0", "0", None, None)], schema)
    two = spark.createDataFrame([(3, None, "1", "A, Mr. B", "male", "40", "0", "0", "30", "C")], schema).drop("Survived")
    combined = {r["PassengerId"]: r for r in feature_table(one, two, presets.TABLE)[0].collect()}
    labelled = {r["PassengerId"]: r for r in feature_table(one, two, presets.TABLE, "train")[0].collect()}
    assert (combined[2]["Age_imputed"], combined[2]["Fare"], combined[2]["Embarked"]) == (30.0, 20.0, "C")
    assert (labelled[2]["Age_imputed"], labelled[2]["Fare"], labelled[2]["Embarked"]) == (20.0, 10.0, "S")


def test_preprocess_validate_train_score(spark, raw, tmp_path):
    data, base, status = str(tmp_path / "data"), str(tmp_path / "base"), str(tmp_path / "status")
    model_path, reports, runs = str(tmp_path / "model"), str(tmp_path / "reports"), str(tmp_path / "runs")
    fills = preprocess(*raw, presets.TABLE, data, base)
    training = read_split(spark, data, "train")
    assert (training.count(), read_split(spark, data, "test").count()) == (600, 200)
    assert 80 < spark.read.parquet(base).count() < 160
    first = spark.read.parquet(base).count()
    preprocess(raw[0].limit(100), raw[1], presets.TABLE, str(tmp_path / "later"), base)
    assert spark.read.parquet(base).count() == first  # an existing baseline is kept
    with pytest.raises(AnalysisException):
        create_baseline(spark, presets.TABLE, data, base)
    create_baseline(spark, presets.TABLE, str(tmp_path / "later"), str(tmp_path / "other"))
    assert spark.read.parquet(str(tmp_path / "other")).count() < 50

    report = validate(training, spark.read.parquet(base), presets.DRIFT_NUMERIC, presets.DRIFT_CATEGORICAL, status)
    assert report.count() == 10
    assert not report.where("drifted").count()
    decision = decide(spark, status, model_path).first()
    assert (decision["action"], decision["reason"]) == ("train", "no model")

    with Run(spark, runs, "training") as run:
        model, result = train(training, SMALL, model_path, reports, run)
    assert decide(spark, status, model_path).first()["action"] == "skip"
    measured = {r["name"]: r["value"] for r in result.metrics.collect()}
    assert set(measured) == {"accuracy", "f1_score", "precision", "recall", "auc_roc", "auc_pr"}
    assert measured["auc_roc"] > 0.7
    stored = spark.read.json(f"{reports}/metrics")
    assert {r["name"]: r["value"] for r in stored.collect()} == pytest.approx(measured)
    assert result.confusion.count() == 4
    assert spark.read.parquet(f"{reports}/roc_curve").count() > 10
    logged = read_runs(spark, runs)
    assert logged.where("parent_run_id IS NOT NULL AND key = 'best_cv_f1_score'").count() == 2
    assert logged.where("parent_run_id IS NULL AND key = 'accuracy'").count() == 2  # metrics and report
    assert logged.where("key = 'best_model_type'").count() == 1

    # Scoring raw rows fills them as training did: the same numbers as for the stored feature table.
    loaded = FillModel.load(spark, f"{data}/fills", presets.TABLE.fills)
    scored = score_raw(raw[1], presets.TABLE, loaded, load_model(model_path), "Survived", "Did not survive")
    direct = model.transform(read_split(spark, data, "test")).select("PassengerId", F.col("prediction").cast("int"))
    assert scored.count() == 200
    assert scored.select("PassengerId", "prediction").exceptAll(direct).isEmpty()
    assert scored.columns == [*raw[1].columns, "prediction", "prediction_label", "probability"]
    both = score_raw(from_rows(spark, REQUESTS, presets.REQUEST_SCHEMA), presets.TABLE, fills, model, "Survived", "Did not survive")
    assert [r["prediction_label"] for r in both.orderBy("Age", ascending=False).collect()] == ["Survived", "Did not survive"]

    # A stream of files gives the same rows as the table.
    arriving = str(tmp_path / "arriving")
    raw[1].repartition(3).write.parquet(arriving)
    query = stream_score(
        spark, arriving, raw[1].schema,
        lambda df: score_raw(df, presets.TABLE, loaded, model, "Survived", "Did not survive"),
        str(tmp_path / "scored"), str(tmp_path / "progress"), max_files_per_trigger=1,
    )
    query.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "scored"))
    assert streamed.count() == 200
    assert streamed.select(*scored.columns).exceptAll(scored).isEmpty()


def test_command_line(spark, raw, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(presets, "TRAINING", SMALL)
    at = {n: str(tmp_path / n) for n in ("train", "test", "data", "base", "status", "model", "reports", "scored", "profile")}
    write_csv(raw[0], at["train"])
    write_csv(raw[1].withColumn("Sex", F.expr("IF(PassengerId = 601, 'other', Sex)")), at["test"])
    cli.main(["preprocess", "--train_input", at["train"], "--test_input", at["test"], "--output_path", at["data"], "--baseline_path", at["base"]])
    cli.main(["validate", "--data_path", at["data"], "--baseline_path", at["base"], "--status_path", at["status"]])
    arguments = ["train", "--data_path", at["data"], "--status_path", at["status"], "--model_out", at["model"], "--report_path", at["reports"]]
    cli.main(arguments)
    assert "train: no model" in capsys.readouterr().out
    cli.main(arguments)
    assert "skip: no drift" in capsys.readouterr().out
    cli.main(["score", "--input", at["test"], "--data_path", at["data"], "--model", at["model"], "--output", at["scored"]])
    found = spark.read.parquet(at["scored"])
    assert found.count() == 200 and found.where("outcome = 'scored' AND prediction IS NOT NULL").count() == 199
    assert [tuple(r) for r in found.where("outcome <> 'scored'").select("PassengerId", "outcome", "violations").collect()] == [(601, "rejected", ["Sex_domain"])]
    cli.main(["profile", "--input", at["train"], "--output", at["profile"]])
    assert spark.read.json(at["profile"]).count() == 3


def test_csv_header_must_match_the_schema(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame([(1, 2)], "a int, b int"), path)
    assert read_csv(spark, path, "a int, b int").first()["b"] == 2
    assert read_csv(spark, path).schema.simpleString() == "struct<a:int,b:int>"
    with pytest.raises(Exception, match="(?i)header|column"):
        read_csv(spark, path, "b int, a int").collect()


def test_append_by_name(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    spark.createDataFrame([(1, "a", 1.0)], "id bigint, s string, v double").write.parquet(path)
    append_batch(spark.createDataFrame([("2.5", 2)], "v string, id int"), path)
    assert rows(spark.read.parquet(path), "id", "s", "v") == [(1, "a", 1.0), (2, None, 2.5)]


def test_replayed_batch_leaves_one_copy(spark, tmp_path):
    baseline = spark.range(300).selectExpr("id", "CAST(id % 50 AS DOUBLE) AS x", "CAST(id % 3 AS STRING) AS c")
    stored = StoredBaseline.build(baseline, ["x"], ["c"])
    paths = [str(tmp_path / n) for n in ("table", "reports", "decisions")]
    handle = batch_handler(stored, *paths, baseline.schema, lambda: True)
    same, shifted = baseline.limit(200), baseline.withColumn("x", F.col("x") + 30)
    for batch, number in ((same, 0), (shifted, 1), (shifted, 1), (same.limit(0), 2)):
        handle(batch, number)
    assert read_batches(spark, paths[0]).count() == 500
    assert read_batches(spark, paths[1]).count() == 4
    actions = {r["batch_id"]: r["action"] for r in read_batches(spark, paths[2]).collect()}
    assert actions == {0: "skip", 1: "train"}


def test_stream_of_batches(spark, tmp_path):
    baseline = spark.range(300).selectExpr("id", "CAST(id % 50 AS DOUBLE) AS x", "CAST(id % 3 AS STRING) AS c")
    stored = StoredBaseline.build(baseline, ["x"], ["c"])
    paths = [str(tmp_path / n) for n in ("table", "reports", "decisions")]
    handle = batch_handler(stored, *paths, baseline.schema, lambda: True)
    arriving, progress = str(tmp_path / "arriving"), str(tmp_path / "progress")
    for shift in (0, 30):
        baseline.withColumn("x", F.col("x") + shift).write.mode("append").parquet(arriving)
        stream_drift(spark, arriving, baseline.schema, handle, progress).awaitTermination()
    assert {r["batch_id"]: r["action"] for r in read_batches(spark, paths[2]).collect()} == {0: "skip", 1: "train"}
    assert read_batches(spark, paths[0]).count() == 600


def test_profiles():
    assert session.profile_settings()["spark.sql.shuffle.partitions"] == "20"
    assert session.profile_settings("low_resource", {"spark.driver.memory": "3g"})["spark.driver.memory"] == "3g"
    with pytest.raises(ValueError):
        session.profile_settings("unknown")


def test_active_session_is_kept(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert session.build("high_parallelism") is spark or session.build("high_parallelism").sparkContext is spark.sparkContext
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_shared_folder_is_the_configured_one(spark):
    assert scratch.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch.new_path(spark, "a") != scratch.new_path(spark, "a")


def test_failed_run_is_logged(spark, tmp_path):
    path = str(tmp_path / "runs")
    with pytest.raises(RuntimeError), Run(spark, path, "x") as run:
        run.params({"a": 1})
        raise RuntimeError
    assert {r["key"]: r["text"] for r in read_runs(spark, path).collect()} == {"a": "1", "status": "failed", "run_name": "x"}


def test_stored_texts_take_less_disk_than_by_default(spark, tmp_path):
    texts = spark.range(4000).select(F.concat_ws(" ", *[F.substring(F.sha2(F.concat("id", F.lit(i)), 256), 1, 3) for i in range(60)]).alias("text"))
    own, default = scratch.new_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:"), str(tmp_path / "default")
    before = set(glob.glob(f"{own}/texts-*"))
    assert scratch.write_table(texts.coalesce(1), "texts", "zstd").exceptAll(texts).isEmpty()
    texts.coalesce(1).write.parquet(default)
    (new,) = set(glob.glob(f"{own}/texts-*")) - before
    sizes = [sum(os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet")) for path in (new, default)]
    assert sizes[0] < 0.85 * sizes[1]

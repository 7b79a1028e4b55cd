"""Every operator as a query over the shared test tables. Each reads its tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright import scratch
from tablewright.catalog import inputs as src
from tablewright.operators import clean, curves, dictionary, drift, encode, impute, metrics, profile, quality, sampling, trees, tuning
from tablewright.operators.baseline import StoredBaseline
from tablewright.operators.features import with_group_size, with_title
from tablewright.operators.prefix import prefix_counts as running_counts
from tablewright.operators.score import incomplete_rows, score, score_all
from tablewright.plans.preprocess import derive
from tablewright.plans.preprocess import feature_table as build_features
from tablewright.sources import documents, models, runlog, tables
from tablewright.streaming import drift as drift_stream
from tablewright.streaming import scoring as scoring_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def vector_parts(vector: str) -> Column:
    """The size, indices and values of a sparse vector."""
    return F.from_json(F.to_json(F.struct(vector)), f"struct<{vector}: struct<type: int, size: int, indices: array<int>, values: array<double>>>")[vector]


def rounded(column: str | Column, places: int = 6) -> Column:
    return F.round(column, places)


# ---- sources and sinks


@query
def csv_roundtrip(spark, folder):
    part = src.table(spark, folder, "part")
    as_csv, as_parquet = scratch.new_path(spark, "csv"), scratch.new_path(spark, "parquet")
    tables.write_csv(part, as_csv)
    tables.write_parquet(tables.read_csv(spark, as_csv, part.schema), as_parquet)
    return tables.read_parquet(spark, as_parquet)


@query
def append_batch(spark, folder):
    """The second batch has other column order and types, and lacks a column."""
    rows = src.table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "ts")
    path = scratch.new_path(spark, "appended")
    before = F.col("ts") < F.lit(src.CUT)
    first = rows.where(before).drop("ts")
    tables.write_parquet(first, path)
    second = rows.where(~before).select("value", F.col("event_id").cast("string").alias("event_id"), "event_type")
    tables.append_batch(second, path, first.schema)
    return spark.read.schema(first.schema).parquet(path)


@query
def append_batch_replayed(spark, folder):
    """The same two batches, both replayed after a failure: the table holds one copy of each."""
    rows = src.table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "ts")
    path = scratch.new_path(spark, "appended")
    before = F.col("ts") < F.lit(src.CUT)
    first = rows.where(before).drop("ts")
    second = rows.where(~before).select("value", F.col("event_id").cast("string").alias("event_id"), "event_type")
    for number, batch in ((1, first), (2, second), (1, first), (2, second)):
        tables.append_batch(batch, path, first.schema, batch_id=number)
    return tables.read_appended(spark, path, first.schema)


@query
def csv_rejects(spark, folder):
    """Parts as lines of text, some too short, too long or with a name for a number: rows and rejects are all lines."""
    part = src.table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    path = scratch.new_path(spark, "csv")
    src.write_lines(part, path)
    rows, rejects = tables.read_csv_accounted(spark, path, part.schema, scratch.new_path(spark, "rejects"))
    tagged = rows.withColumn("kind", F.lit("row"))
    return tagged.unionByName(rejects.select("record", F.lit("reject").alias("kind")), allowMissingColumns=True)


@query
def append_rejects(spark, folder):
    """Rows of a batch that a table of 32-bit amounts can't hold, with the columns that don't fit."""
    batch = src.table(spark, folder, "events").select("event_id", "event_type", (F.col("event_id") * 1_000_003).alias("amount"))
    return clean.misfit_rows(batch, StructType.fromDDL("event_id long, event_type int, amount int")).select(
        "event_id", F.array_join("misfits", ",").alias("misfits")
    )


# ---- cleaning and features


@query
def tolerant_cast(spark, folder):
    return clean.cast_numeric(src.events(spark, folder).select("event_id", "raw_text"), ["raw_text", "absent"])


@query
def title_extract(spark, folder):
    return with_title(src.table(spark, folder, "documents"), "text", "title").select("doc_id", "title")


@query
def family_features(spark, folder):
    lines = src.table(spark, folder, "lineitem").select(
        "l_orderkey",
        (F.col("l_linenumber") - 1).alias("siblings"),
        src.gap("l_orderkey % 7 = 0", "l_partkey % 3").alias("parents"),
    )
    return with_group_size(lines, ["siblings", "parents"], "family_size", "is_alone")


@query
def union_by_name(spark, folder):
    rows = src.events(spark, folder)
    before = F.col("ts") < F.lit(src.CUT)
    return clean.union_by_name(
        rows.where(before).select("event_id", "g", "label"), rows.where(~before).select("v", "event_id", "g")
    )


@query
def split_labelled(spark, folder):
    return clean.labelled(src.events(spark, folder).select("event_id", "label"), "label")


@query
def split_unlabelled(spark, folder):
    return clean.unlabelled(src.events(spark, folder).select("event_id", "label"), "label")


@query
def feature_table(spark, folder):
    table, _ = build_features(*src.raw_events(spark, folder), src.EVENT_TABLE)
    return _rounded_features(table)


@query
def feature_table_train_scope(spark, folder):
    table, _ = build_features(*src.raw_events(spark, folder), src.EVENT_TABLE, fit_scope="train")
    return _rounded_features(table)


def _rounded_features(table: DataFrame) -> DataFrame:
    return table.withColumns({"amount_filled": rounded("amount_filled"), "fare": rounded("fare")})


# ---- aggregates and fills


@query
def group_mean(spark, folder):
    means = impute.group_means(src.events(spark, folder), "g", "v")
    return means.select("g", rounded("mean_v").alias("mean_v"), "n_rows")


@query
def category_counts(spark, folder):
    return profile.category_counts(src.events(spark, folder), "g")


@query
def mode_top1(spark, folder):
    return impute.column_mode(src.events(spark, folder), "g")


@query
def impute_group_mean(spark, folder):
    rows = src.events(spark, folder).select("event_id", "g", "v")
    return impute.fill_group_mean(rows, "g", "v", "filled").select("event_id", "g", rounded("filled").alias("filled"))


@query
def impute_group_mean_shuffled(spark, folder):
    """The form for statistics too large to broadcast: parts by key number, over whole line items."""
    lines = src.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_extendedprice",
        F.expr("CASE WHEN l_orderkey % 3 = 0 THEN -1 WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_partkey END").alias("part"),
        src.gap("l_orderkey % 7 = 0", "l_quantity").alias("quantity"),
    )
    filled = impute.fill_group_mean(lines, "part", "quantity", broadcast_bytes=0, target_rows=5_000)
    return filled.select("l_orderkey", "l_extendedprice", "part", rounded("quantity").alias("quantity"))


@query
def impute_mode(spark, folder):
    return impute.fill_mode(src.events(spark, folder).select("event_id", "g"), "g")


@query
def impute_mean(spark, folder):
    filled = impute.fill_mean(src.events(spark, folder).select("event_id", "v"), "v")
    return filled.select("event_id", rounded("v").alias("v"))


@query
def numeric_profile(spark, folder):
    lines = src.table(spark, folder, "lineitem").withColumn("l_quantity", src.gap("l_orderkey % 7 = 0", "l_quantity"))
    result = profile.numeric_profile(lines, ["l_quantity", "l_extendedprice", "l_discount"])
    return result.select("feature", *[rounded(s, 4).alias(s) for s in profile.STATISTICS])


# ---- row rules


@query
def quality_violations(spark, folder):
    rejected = quality.rejected_rows(src.rule_orders(spark, folder), src.order_rules())
    return rejected.select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@query
def quality_valid(spark, folder):
    return quality.valid_rows(src.rule_orders(spark, folder), src.order_rules()).select("o_orderkey", "o_custkey")


@query
def quality_summary(spark, folder):
    return quality.violation_summary(src.rule_orders(spark, folder), src.order_rules())


# ---- samples, splits, folds (by a hash that SQL can repeat)


@query
def hash_sample(spark, folder):
    orders = src.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sampling.hash_sample(orders, "o_orderkey", 0.2, method="multiplicative")


@query
def hash_split(spark, folder):
    orders = src.table(spark, folder, "orders").select("o_orderkey")
    training, held_out = sampling.hash_split(orders, "o_orderkey", [0.8, 0.2], method="multiplicative")
    return training.withColumn("part", F.lit("train")).unionByName(held_out.withColumn("part", F.lit("test")))


@query
def sample_n(spark, folder):
    orders = src.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_n(orders, "o_orderkey", 150, method="multiplicative")


@query
def sample_n_large(spark, folder):
    """Half of all line items; those of one order share a hash."""
    lines = src.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    others = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return sampling.sample_n(lines, "l_orderkey", lines.count() // 2, method="multiplicative", order_by=others)


@query
def kfold_counts(spark, folder):
    orders = src.table(spark, folder, "orders").select("o_orderkey")
    folded = sampling.with_fold(orders, "o_orderkey", 3, method="multiplicative")
    return folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


# ---- running counts and drift


def _price_counts(spark, folder, **options):
    lines = src.table(spark, folder, "lineitem")
    return running_counts(lines, ["l_extendedprice"], {"n": F.lit(1)}, **options)


@query
def prefix_counts(spark, folder):
    return _price_counts(spark, folder)


@query
def prefix_counts_bucketed(spark, folder):
    """The form large tables get: the same rows from buckets of about 5,000 input rows."""
    return _price_counts(spark, folder, rows_per_bucket=5_000)


@query
def contingency(spark, folder):
    return drift.contingency(*src.order_samples(spark, folder), ["gappy_priority", "o_orderstatus"])


def _chi2(spark, folder, features):
    result = drift.chi2_drift(*src.order_samples(spark, folder), features)
    return result.withColumns({"statistic": rounded("statistic"), "p_value": rounded("p_value")})


@query
def drift_chi2(spark, folder):
    return _chi2(spark, folder, ["o_orderpriority", "o_orderstatus", "constant", "absent"])


@query
def drift_chi2_yates(spark, folder):
    return _chi2(spark, folder, ["price_class"])


def _ks(spark, folder, **options):
    result = drift.ks_drift(*src.two_samples(spark, folder), ["v", "user_id", "tripled", "absent"], **options)
    return result.withColumns({"statistic": rounded("statistic", 9), "p_value": rounded("p_value")})


@query
def drift_ks(spark, folder):
    return _ks(spark, folder)


@query
def drift_ks_bucketed(spark, folder):
    return _ks(spark, folder, rows_per_bucket=2_000)


def _report(spark, folder):
    return drift.drift_report(
        *src.two_samples(spark, folder),
        ["v", "user_id", "tripled", "absent"],
        ["event_type", "one_type", "absent"],
    )


@query
def drift_report(spark, folder):
    return _report(spark, folder).withColumns({"statistic": rounded("statistic"), "p_value": rounded("p_value")})


@query
def drift_verdict(spark, folder):
    return drift.drift_verdict(_report(spark, folder))


@query
def retrain_gate(spark, folder):
    """The decision for a model path that holds no model."""
    exists = models.model_exists(spark, scratch.new_path(spark, "no-model"))
    return drift.retrain_gate(drift.drift_verdict(_report(spark, folder)), exists)


@query
def retrain_gate_skip(spark, folder):
    """The decision for a table without drift and a path that holds a model."""
    training, _ = _rule_parts(spark, folder)
    path = scratch.new_path(spark, "model")
    models.save_model(tuning.fit_family(training, src.RULE_TRAINING, "LogisticRegression", regParam=0.01), path)
    rows = src.events(spark, folder)
    report = drift.drift_report(rows, rows, ["v", "user_id"], ["event_type"])
    return drift.retrain_gate(drift.drift_verdict(report), models.model_exists(spark, path))


# ---- evaluation


def _pairs(spark, folder):
    return metrics.pair_counts(src.scored_documents(spark, folder))


@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_pairs(spark, folder))


@query
def classification_metrics(spark, folder):
    result = metrics.classification_metrics(_pairs(spark, folder))
    return result.select(*[rounded(c).alias(c) for c in result.columns])


@query
def classification_report(spark, folder):
    result = metrics.classification_report(_pairs(spark, folder))
    return result.select(*[rounded(c).alias(c) for c in result.columns])


@query
def metrics_long(spark, folder):
    """The metrics as a stored document, read back."""
    path = scratch.new_path(spark, "metrics")
    documents.write_document(metrics.to_long(metrics.classification_metrics(_pairs(spark, folder))), path)
    return documents.read_document(spark, path).select("name", rounded("value").alias("value"))


@query
def roc_curve(spark, folder):
    curve = curves.roc_curve(src.scored_documents(spark, folder), "score", "label")
    return curve.select("threshold", rounded("fpr").alias("fpr"), rounded("tpr").alias("tpr"))


@query
def pr_curve(spark, folder):
    curve = curves.pr_curve(src.scored_documents(spark, folder), "score", "label")
    return curve.select("threshold", rounded("recall").alias("recall"), rounded("precision").alias("precision"))


@query
def auc_roc(spark, folder):
    return curves.auc_roc(src.scored_documents(spark, folder), "score", "label").select(
        rounded("auc_roc").alias("auc_roc")
    )


@query
def auc_pr(spark, folder):
    return curves.auc_pr(src.scored_documents(spark, folder), "score", "label").select(rounded("auc_pr").alias("auc_pr"))


@query
def auc_lineitem_bucketed(spark, folder):
    """Both areas on a larger table, by the form large tables get."""
    lines = src.table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("score"), (F.col("l_quantity") > 25).cast("int").alias("label")
    )
    result = curves.areas(lines, "score", "label", rows_per_bucket=5_000)
    return result.select(*[rounded(c).alias(c) for c in result.columns])


# ---- encoding


def _priority_index(spark, folder):
    """Indexer fitted without one priority, so that this one is unseen later."""
    orders = src.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    spec = encode.FeatureSpec(numeric=(), categorical=("o_orderpriority",))
    fitted = encode.indexer(spec).fit(orders.where(F.col("o_orderpriority") != "5-LOW"))
    return spec, fitted.transform(orders)


@query
def string_index(spark, folder):
    _, indexed = _priority_index(spark, folder)
    return indexed.select("o_orderkey", "o_orderpriority", "o_orderpriority_index")


@query
def one_hot(spark, folder):
    spec, indexed = _priority_index(spark, folder)
    encoded = encode.encoder(spec).fit(indexed).transform(indexed)
    slots = F.transform(vector_to_array("o_orderpriority_vec"), lambda x: x.cast("int"))
    return encoded.select("o_orderkey", F.array_join(slots, ",").alias("slots"))


def _wide(spark, folder, column, fit_on="o_orderkey % 5 <> 0", **options):
    """Orders with the index of a column of many categories, some of them unseen when the dictionary was made."""
    orders = src.wide_orders(spark, folder)
    known = dictionary.build_dictionary(orders.where(fit_on), column, rows_per_part=500)
    return known, dictionary.with_index(orders, known, f"{column}_index", **options)


@query
def string_index_wide(spark, folder):
    _, indexed = _wide(spark, folder, "customer")
    return indexed.select("o_orderkey", "customer", "customer_index")


@query
def string_index_wide_shuffled(spark, folder):
    """The form for dictionaries too large to broadcast."""
    _, indexed = _wide(spark, folder, "customer", broadcast_bytes=0, target_rows=15)
    return indexed.select("o_orderkey", "customer", "customer_index")


@query
def sparse_vectors(spark, folder):
    """Vectors of a number and of all customers: the number of slots, and the sums of their indices and values."""
    known, indexed = _wide(spark, folder, "customer")
    vectors = dictionary.with_sparse_vector(indexed, ["price"], [("customer_index", known)])
    parts = vectors.select("o_orderkey", vector_parts("features").alias("v"))
    total = F.aggregate("v.values", F.lit(0.0), lambda total, x: total + x)
    return parts.select("o_orderkey", F.col("v.size").alias("n_slots"), F.array_join("v.indices", ",").alias("slots"), rounded(total, 2).alias("total"))


@query
def assembled_rows(spark, folder):
    orders = src.model_orders(spark, folder)
    assembled = encode.fit_features(orders, src.ORDER_FEATURES).transform(orders)
    slots = vector_to_array("features")
    return assembled.select(
        "o_orderkey",
        F.size(slots).alias("n_slots"),
        rounded(F.aggregate(slots, F.lit(0.0), lambda total, x: total + x), 2).alias("total"),
    )


@query
def feature_info(spark, folder):
    orders = src.model_orders(spark, folder)
    return encode.feature_info(encode.fit_features(orders, src.ORDER_FEATURES), src.ORDER_FEATURES, orders)


@query
def model_signature(spark, folder):
    orders = src.model_orders(spark, folder)
    fitted = encode.fit_features(orders, src.ORDER_FEATURES)
    return encode.signature(orders, fitted.transform(orders)).select("io", "position", "name", "type")


# ---- models


def _training_and_held_out(spark, folder):
    return sampling.hash_split(src.model_orders(spark, folder), "o_orderkey", [0.8, 0.2])


def _fit_and_count(spark, folder, family, **params):
    """Confusion matrix of one classifier on the held-out orders."""
    training, held_out = _training_and_held_out(spark, folder)
    model = tuning.fit_family(training, src.ORDER_TRAINING, family, **params)
    return metrics.confusion_matrix(metrics.pair_counts(model.transform(held_out)))


@query
def fit_dt(spark, folder):
    return _fit_and_count(spark, folder, "DecisionTree", maxDepth=5)


@query
def fit_rf(spark, folder):
    return _fit_and_count(spark, folder, "RandomForest", numTrees=20, maxDepth=5)


@query
def fit_lr(spark, folder):
    return _fit_and_count(spark, folder, "LogisticRegression", regParam=0.1)


@query
def fit_gbt(spark, folder):
    return _fit_and_count(spark, folder, "GBTClassifier", maxDepth=3, maxIter=10)


def _rule_parts(spark, folder):
    return sampling.hash_split(src.rule_training(spark, folder), "o_orderkey", [0.8, 0.2], method="multiplicative")


def _fit_rule(spark, folder, family, **params):
    """Confusion matrix on held-out orders of a classifier that has to find a rule."""
    training, held_out = _rule_parts(spark, folder)
    model = tuning.fit_family(training, src.RULE_TRAINING, family, **params)
    return metrics.confusion_matrix(metrics.pair_counts(model.transform(held_out)))


@query
def fit_dt_rule(spark, folder):
    return _fit_rule(spark, folder, "DecisionTree", maxDepth=5)


@query
def fit_rf_rule(spark, folder):
    return _fit_rule(spark, folder, "RandomForest", numTrees=50, maxDepth=10)


@query
def fit_lr_rule(spark, folder):
    return _fit_rule(spark, folder, "LogisticRegression", regParam=0.01)


@query
def fit_gbt_rule(spark, folder):
    return _fit_rule(spark, folder, "GBTClassifier", maxDepth=3, maxIter=10)


def _rule_model(spark, folder):
    training, _ = _rule_parts(spark, folder)
    path = scratch.new_path(spark, "model")
    models.save_model(tuning.fit_family(training, src.RULE_TRAINING, "LogisticRegression", regParam=0.01), path)
    return models.load_model(path)


@query
def score_batch_rule(spark, folder):
    """Predictions of the stored model for every order, by key."""
    scored = score(_rule_model(spark, folder), src.rule_training(spark, folder), "urgent", "other")
    return scored.select("o_orderkey", "prediction", "prediction_label")


@query
def score_accounted(spark, folder):
    """Every order by key: scored, rejected by a rule, or skipped for want of a number."""
    orders = src.rule_training(spark, folder)
    found = score_all(_rule_model(spark, folder), orders, src.RULE_FEATURES, [quality.Rule.between("price", 2000, 400000)])
    return found.select("o_orderkey", "outcome", F.array_join("violations", ",").alias("violations"), "prediction")


def _tuned(spark, folder):
    """The tuning table of the orders."""
    training, _ = _training_and_held_out(spark, folder)
    return tuning.tuning_table(tuning.cross_validate(training, src.ORDER_TRAINING))


@query
def best_model_given(spark, folder):
    """Selection over a table of uneven scores, as the tables of tuning have them."""
    return tuning.best_model(src.given_scores(spark, folder))


@query
def best_params_given(spark, folder):
    return tuning.best_params(tuning.best_model(src.given_scores(spark, folder)))


@query
def best_per_family_given(spark, folder):
    return tuning.best_per_family(src.given_scores(spark, folder))


@query
def tuning_table(spark, folder):
    return _tuned(spark, folder)


@query
def tuning_table_rule(spark, folder):
    """The whole grid on a label that every family finds."""
    training, _ = _rule_parts(spark, folder)
    tuned = tuning.tuning_table(tuning.cross_validate(training, src.RULE_TRAINING))
    return tuned.withColumn("f1", rounded("f1"))


@query
def best_model(spark, folder):
    return tuning.best_model(_tuned(spark, folder))


@query
def best_params(spark, folder):
    return tuning.best_params(tuning.best_model(_tuned(spark, folder)))


@query
def feature_importance(spark, folder):
    training, _ = _training_and_held_out(spark, folder)
    model = tuning.fit_family(training, src.ORDER_TRAINING, "RandomForest", numTrees=20, maxDepth=5)
    return encode.feature_importance(model.stages[-1], model.transform(training))


@query
def feature_importance_rule(spark, folder):
    """Importances out of the stored nodes of a tree that finds the rule, of the slots that it splits by."""
    training, _ = _rule_parts(spark, folder)
    model = tuning.fit_family(training, src.RULE_TRAINING, "DecisionTree", maxDepth=5)
    nodes = trees.tree_nodes(spark, model.stages[-1])
    found = encode.named_importance(trees.slot_importance(nodes, True), encode.feature_names(model.transform(training)))
    return found.select("feature", rounded("importance").alias("importance"))


def _saved_model(spark, folder):
    """A logistic model of the orders, stored and loaded again."""
    training, _ = _training_and_held_out(spark, folder)
    path = scratch.new_path(spark, "model")
    models.save_model(tuning.fit_family(training, src.ORDER_TRAINING, "LogisticRegression", regParam=0.1), path)
    return models.load_model(path)


@query
def score_batch(spark, folder):
    orders = src.model_orders(spark, folder)
    return score(_saved_model(spark, folder), orders, "high", "low").drop("label")


@query
def probability_given(spark, folder):
    """Probabilities and predictions of a logistic model given by its weights, as arithmetic over the columns."""
    orders = src.rule_training(spark, folder)
    return orders.select(
        "o_orderkey",
        rounded(src.GIVEN_WEIGHTS.probability(), 9).alias("probability"),
        src.GIVEN_WEIGHTS.prediction().alias("prediction"),
    )


@query
def score_skipped(spark, folder):
    return incomplete_rows(src.model_orders(spark, folder), src.ORDER_FEATURES).select("o_orderkey")


def _logged(spark, folder, path, run_id):
    with runlog.Run(spark, path, "evaluation", run_id=run_id) as run:
        run.params({"threshold": 1000})
        with run.child("areas") as child:
            child.metric_table(metrics.to_long(curves.areas(src.scored_documents(spark, folder), "score", "label")))
        run.metric_table(metrics.to_long(metrics.classification_metrics(_pairs(spark, folder))))


@query
def run_log(spark, folder):
    """A run with a nested one, replayed under its id: one copy of both."""
    path = scratch.new_path(spark, "runs")
    for _ in range(2):
        _logged(spark, folder, path, "evaluation-1")
    logged = runlog.read_runs(spark, path)
    return logged.select(
        F.col("parent_run_id").isNotNull().alias("nested"), "kind", "key", "text", rounded("number").alias("number")
    )


# ---- streams


@query
def stream_score(spark, folder):
    """The orders arrive as files and are scored by the stored model."""
    orders = src.model_orders(spark, folder)
    arriving, scored, progress = (scratch.new_path(spark, n) for n in ("arriving", "scored", "progress"))
    tables.write_parquet(orders, arriving)
    model = _saved_model(spark, folder)
    run = scoring_stream.stream_score(
        spark, arriving, orders.schema, lambda df: score(model, df, "high", "low"), scored, progress
    )
    run.awaitTermination()
    return tables.read_parquet(spark, scored).drop("label")


@query
def stream_score_rule(spark, folder):
    """The same predictions, from orders that arrive as files."""
    orders = src.rule_training(spark, folder)
    arriving, scored, progress = (scratch.new_path(spark, n) for n in ("arriving", "scored", "progress"))
    tables.write_parquet(orders, arriving)
    model = _rule_model(spark, folder)
    run = scoring_stream.stream_score(
        spark, arriving, orders.schema, lambda df: score(model, df, "urgent", "other"), scored, progress
    )
    run.awaitTermination()
    return tables.read_parquet(spark, scored).select("o_orderkey", "prediction", "prediction_label")


@query
def stream_score_accounted(spark, folder):
    """Every arriving order by key: scored, rejected by a rule, or skipped for want of a number."""
    orders = src.rule_training(spark, folder)
    arriving, scored, progress = (scratch.new_path(spark, n) for n in ("arriving", "scored", "progress"))
    tables.write_parquet(orders, arriving)
    model, rules = _rule_model(spark, folder), [quality.Rule.between("price", 2000, 400000)]
    run = scoring_stream.stream_score(
        spark, arriving, orders.schema, lambda df: score_all(model, df, src.RULE_FEATURES, rules), scored, progress
    )
    run.awaitTermination()
    found = tables.read_parquet(spark, scored)
    return found.select("o_orderkey", "outcome", F.array_join("violations", ",").alias("violations"), "prediction")


@query
def stream_features(spark, folder):
    """Unlabelled raw rows arrive as files and get the features and fills of the batch table."""
    training, scoring = src.raw_events(spark, folder)
    _, fills = build_features(training, scoring, src.EVENT_TABLE)
    arriving, prepared, progress = (scratch.new_path(spark, n) for n in ("arriving", "prepared", "progress"))
    tables.write_parquet(scoring, arriving)
    run = scoring_stream.stream_score(
        spark,
        arriving,
        scoring.schema,
        lambda df: fills.apply(derive(df, src.EVENT_TABLE)).drop(*src.EVENT_TABLE.dropped),
        prepared,
        progress,
    )
    run.awaitTermination()
    return _rounded_features(tables.read_parquet(spark, prepared))


@query
def stream_drift(spark, folder):
    """Events arrive in two batches, by date, each tested against the earliest ones."""
    rows = src.events(spark, folder).select("event_id", "ts", "v", "user_id", "event_type")
    baseline = rows.where(F.col("ts") < F.lit(src.CUT))
    batches = [
        rows.where((F.col("ts") >= F.lit(src.CUT)) & (F.col("ts") < F.lit(src.LATE_CUT))),
        rows.where(F.col("ts") >= F.lit(src.LATE_CUT)).withColumn("v", F.col("v") * 3),
    ]
    arriving, stored, reports, decisions, progress = (
        scratch.new_path(spark, n) for n in ("arriving", "stored", "reports", "decisions", "progress")
    )
    counts = StoredBaseline.build(baseline, ["v", "user_id"], ["event_type"])
    handler = drift_stream.batch_handler(counts, stored, reports, decisions, rows.schema, lambda: False)
    for batch in batches:
        batch.write.mode("append").parquet(arriving)
        drift_stream.stream_drift(spark, arriving, rows.schema, handler, progress).awaitTermination()
    report = drift_stream.read_batches(spark, reports)
    return report.withColumns({"statistic": rounded("statistic"), "p_value": rounded("p_value")})

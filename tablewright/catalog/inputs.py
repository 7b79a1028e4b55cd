"""Views on the shared test tables: gaps, malformed text and labels made by key arithmetic."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.encode import FeatureSpec
from tablewright.operators.impute import FillSpec
from tablewright.operators.linear import LinearModel
from tablewright.operators.quality import Rule
from tablewright.operators.tuning import TrainingSpec
from tablewright.plans.preprocess import TableSpec

CUT = datetime.datetime(2024, 1, 16)
LATE_CUT = datetime.datetime(2024, 1, 24)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def gap(condition: str, value: str):
    return F.expr(f"CASE WHEN {condition} THEN NULL ELSE {value} END")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a gappy number ``v`` and category ``g``, a partial label, and malformed number text."""
    return table(spark, folder, "events").withColumns(
        {
            "v": gap("event_id % 7 = 0", "value"),
            "g": gap("event_id % 11 = 0", "event_type"),
            "label": F.expr("CASE WHEN event_id % 10 < 7 THEN user_id % 2 END"),
            "raw_text": F.expr(
                "CASE WHEN event_id % 5 = 0 THEN event_type ELSE regexp_extract(props, '([0-9]+)', 1) END"
            ),
        }
    )


def raw_events(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Events as two raw tables of text columns: labelled ones before the cut, unlabelled ones from it."""
    raw = events(spark, folder).select(
        "event_id",
        "ts",
        F.expr("CASE WHEN event_id % 10 < 7 THEN CAST(user_id % 2 AS STRING) ELSE 'n/a' END").alias("label"),
        F.expr(
            "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 11 = 0 THEN event_type "
            "ELSE concat('Name, ', event_type, '. Given') END"
        ).alias("name"),
        F.col("raw_text").alias("amount"),
        F.col("v").cast("string").alias("fare"),
        F.expr("CAST(user_id % 3 AS STRING)").alias("siblings"),
        F.expr("CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 2 AS STRING) END").alias("parents"),
        F.col("g").alias("port"),
        "props",
    )
    before = F.col("ts") < F.lit(CUT)
    return raw.where(before).drop("ts"), raw.where(~before).drop("ts", "label")


EVENT_TABLE = TableSpec(
    key="event_id",
    label="label",
    numeric=("amount", "fare", "siblings", "parents"),
    name="name",
    size_parts=("siblings", "parents"),
    fills=FillSpec(group_mean={"amount_filled": ("title", "amount")}, mean=("fare",), mode=("port",)),
    dropped=("name", "props", "amount"),
    title="title",
    size="family_size",
    single="is_alone",
)


def rule_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumn("o_custkey", gap("o_orderkey % 13 = 0", "o_custkey"))


def order_rules() -> list[Rule]:
    return [
        Rule.required("o_custkey"),
        Rule.between("o_totalprice", 2000, 400000),
        Rule.one_of("o_orderstatus", ("F", "O")),
        Rule.one_of("o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")),
    ]


def model_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a label and features that tell something about it; some numbers are missing."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.expr("CAST(o_totalprice > 250000 AS DOUBLE)").alias("label"),
        F.expr(
            "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice + (o_orderkey * 7919) % 200000 END"
        ).alias("noisy_price"),
        F.month("o_orderdate").cast("double").alias("order_month"),
        (F.col("o_custkey") % 100).cast("double").alias("cust_mod"),
        "o_orderpriority",
        "o_orderstatus",
    )


ORDER_FEATURES = FeatureSpec(
    numeric=("noisy_price", "order_month", "cust_mod"), categorical=("o_orderpriority", "o_orderstatus")
)
ORDER_TRAINING = TrainingSpec(features=ORDER_FEATURES, label="label", key="o_orderkey")


def rule_training(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose label is a rule on one category, so that a right fit finds it exactly."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.expr("CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS DOUBLE)").alias("label"),
        gap("o_orderkey % 17 = 0", "o_totalprice").alias("price"),
        "o_orderpriority",
    )


RULE_FEATURES = FeatureSpec(numeric=("price",), categorical=("o_orderpriority",))
RULE_TRAINING = TrainingSpec(features=RULE_FEATURES, label="label", key="o_orderkey")


GIVEN_WEIGHTS = LinearModel(
    intercept=-1.5,
    numeric={"price": 0.00001},
    categorical={"o_orderpriority": {"1-URGENT": 1.25, "2-HIGH": 0.5, "5-LOW": -2.0}},
)


def wide_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer as text, a category of many values and some nulls."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        gap("o_orderkey % 13 = 0", "concat('Customer ', o_custkey)").alias("customer"),
        gap("o_orderkey % 17 = 0", "o_totalprice").alias("price"),
    )


def write_lines(part: DataFrame, path: str) -> None:
    """Parts as lines of a CSV, some of them malformed, by key arithmetic."""
    line = F.expr(
        "CASE WHEN p_partkey % 7 = 0 THEN concat(p_partkey, ',', p_name) "
        "WHEN p_partkey % 11 = 0 THEN concat(p_partkey, ',', p_name, ',', p_size, ',more') "
        "WHEN p_partkey % 13 = 0 THEN concat(p_partkey, ',', p_name, ',', p_name) "
        "ELSE concat(p_partkey, ',', p_name, ',', p_size) END"
    )
    # One column under a separator that no line has, so that lines and header stand as they are.
    lines = part.select(line.alias(",".join(part.columns)))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0002").csv(path)


def given_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A tuning table made of the orders: priorities as families, key remainders as grid points."""
    point = (F.col("o_orderkey") % 5).cast("int")
    return (
        table(spark, folder, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("family"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("family_rank"),
            point.alias("point"),
            F.concat(F.lit('{"maxDepth": '), point.cast("string"), F.lit("}")).alias("params"),
        )
        .agg(F.round(F.avg((F.col("o_totalprice") > 200000).cast("double")), 6).alias("f1"))
    )


def scored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with a rule's prediction and a score."""
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").select(
        "doc_id",
        F.col("quality").cast("double").alias("label"),
        (F.col("n_chars") > 1000).cast("double").alias("prediction"),
        F.col("n_chars").cast("double").alias("score"),
    )


def two_samples(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Events before the cut as baseline, the later ones as new data, with two forced drifts in the latter."""
    both = events(spark, folder).select("ts", "v", "user_id", "event_type", "g", "value")
    baseline = both.where(F.col("ts") < F.lit(CUT)).select(
        "v", "user_id", "event_type", "g", F.col("value").alias("tripled"), F.col("event_type").alias("one_type")
    )
    new = both.where(F.col("ts") >= F.lit(CUT)).select(
        "v", "user_id", "event_type", "g", (F.col("value") * 3).alias("tripled"), F.lit("click").alias("one_type")
    )
    return new, baseline


def order_samples(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Every fifth order as new data, the others as baseline."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        "o_orderstatus",
        F.expr("CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END").alias("price_class"),
        F.expr("CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END").alias("gappy_priority"),
        F.lit("same").alias("constant"),
    )
    return orders.where("o_orderkey % 5 = 0"), orders.where("o_orderkey % 5 <> 0")

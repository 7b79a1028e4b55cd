"""From raw documents to packed training sequences: every stage works on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import quality
from tablewright.llm.decontaminate import leaks
from tablewright.llm.lines import without_repeated_lines
from tablewright.llm.minhash import near_duplicates
from tablewright.llm.packing import Packing, pack, piece_checksum
from tablewright.llm.queries import quality_model
from tablewright.scratch import write_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model doesn't reject (score of 0.5 or more)."""
    return quality.score(docs.select(*COLUMNS), quality_model(spark, sf_dir)).where("score >= 0.5").select(*COLUMNS)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of windows that stand earlier; n_chars is the length that is left (null stays null)."""
    cut = without_repeated_lines(docs.select(*COLUMNS))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*COLUMNS)


def with_row_key(docs: DataFrame) -> DataFrame:
    """The documents with a number for each row, stored: decisions are made by row, as ids can be null or repeated."""
    return write_table(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row_key")), "rows", "zstd")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id (rows without a doc_id come last).

    Groups are made of rows, so repeated rows and rows without a doc_id are compared like all others. Shingles have five
    words here; the query of the operator has four.
    """
    rows = with_row_key(docs)
    groups = near_duplicates(rows.select("row_key", "text"), id_column="row_key").select(F.col("doc_id").alias("row_key"), "component_id")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    kept = rows.select("row_key", "doc_id").join(groups, "row_key").groupBy("component_id").agg(F.min_by("row_key", place).alias("row_key"))
    return rows.join(kept.select("row_key"), "row_key", "left_semi").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark, whatever their doc_id."""
    rows = with_row_key(docs)
    found = leaks(rows.select("row_key", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_column="row_key")
    return rows.join(found.select(F.col("doc_id").alias("row_key")).distinct(), "row_key", "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences, with their ids."""
    return pack(docs, Packing(codec="zstd")).withColumn("ids_crc32", piece_checksum())


STAGES = [
    ("quality", keep_quality),
    ("lines", cut_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: SQL can't express the quality model, signatures, latent search and tokenizer; tests/llm has plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = write_table(docs, f"stage-{name}")
    return docs

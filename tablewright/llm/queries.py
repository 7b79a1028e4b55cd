"""The corpus operators as queries over the shared test tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import bpe, language, licenses, quality, toxicity, vector_codes
from tablewright.llm.decontaminate import leaks
from tablewright.llm.forest import near_vectors
from tablewright.llm.labelled import remainder
from tablewright.llm.lines import without_repeated_lines
from tablewright.llm.minhash import NearDuplicates, near_duplicates
from tablewright.llm.packing import pack, piece_checksum
from tablewright.llm.tokens import token_counts
from tablewright.llm.whitening import whiten


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digest(licenses.scan(_table(spark, folder, "documents")))


def op3_forest(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(_table(spark, folder, "embeddings"))


def op4_lines(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeated_lines(_table(spark, folder, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    filters = language.fit(documents.where(~held_out))
    return language.detect(documents, filters).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(_table(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", piece_checksum().alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"))


def _held_out():
    return F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))


def _labelled(spark: SparkSession, folder: str, label: str) -> DataFrame:
    """Texts with a label, without the rows held out."""
    labels = _table(spark, folder, "labels").select("doc_id", F.col(label).alias("label")).where(~_held_out() & F.col("label").isNotNull())
    return _table(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id")


def quality_model(spark: SparkSession, folder: str) -> quality.Quality:
    return quality.fit(_labelled(spark, folder, "quality"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.score(_table(spark, folder, "documents").select("doc_id", "text"), quality_model(spark, folder))
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(_table(spark, folder, "documents").select("doc_id", "text"), toxicity.fit(_labelled(spark, folder, "toxic")))
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(_table(spark, folder, "documents"), NearDuplicates(shingle=4))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(_table(spark, folder, "embeddings"))


def op12_bpe(spark: SparkSession, folder: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(_table(spark, folder, "documents")))
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_codes.compress(_table(spark, folder, "embeddings"))
    digest = F.lit(vector_codes.codebook_digest(found.codebooks))
    rows = vector_codes.with_group_error(found.rows)
    return rows.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_licenses": op2_licenses,
    "op3_forest": op3_forest,
    "op4_lines": op4_lines,
    "op5_language": op5_language,
    "op6_packing": op6_packing,
    "op7_tokens": op7_tokens,
    "op8_quality": op8_quality,
    "op9_minhash": op9_minhash,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_bpe": op12_bpe,
    "op13_vector_codes": op13_vector_codes,
}



def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, size: int = 8) -> str:
    """The rounds of the vector codes one after the other, every part against every entry."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        pick_{r} AS MATERIALIZED (
            SELECT vec_id, p, any_value(v) AS v, min(CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * {entries} + e) AS k
            FROM part JOIN book_{r} USING (p) GROUP BY vec_id, p
        )""")
        if r < rounds:
            steps.append(f"""
        mean_{r} AS (SELECT p, e, list(m ORDER BY i) AS m FROM (
            SELECT p, k % {entries} AS e, i, CAST(floor(CAST(sum(v[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM pick_{r}, range(1, {size + 1}) AS t(i) GROUP BY p, k % {entries}, i
        ) GROUP BY p, e),
        book_{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c FROM book_{r} LEFT JOIN mean_{r} USING (p, e))""")
    cut = f"x[p * {size} + 1 : p * {size} + {size}]"
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))
        ),
        part AS MATERIALIZED (SELECT vec_id, p, {cut} AS v FROM kept, range({parts}) AS t(p)),
        first AS (SELECT x, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept),
        book_0 AS MATERIALIZED (SELECT p, e, {cut} AS c FROM first, range({parts}) AS t(p) WHERE e < {entries}),{",".join(steps)},
        coded AS (
            SELECT vec_id, string_agg(format('{{:02x}}', k % {entries}), '' ORDER BY p) AS code, CAST(sum((k - k % {entries}) // {entries}) AS BIGINT) AS error
            FROM pick_{rounds} GROUP BY vec_id
        ),
        digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book_{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM coded JOIN kept USING (vec_id), digest
    """


ORACLES: dict[str, str] = {
    "op13_vector_codes": _codes_sql(),
    "op4_lines": """
        WITH whole AS (SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents),
        line AS (SELECT doc_id, text, unnest(lines) AS l, generate_subscripts(lines, 1) AS i FROM whole),
        span AS (
            SELECT doc_id, text, i, l AS a, lead(l) OVER w AS b, lead(l, 2) OVER w AS c FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY i)
        ),
        told AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS n
            FROM span WHERE c IS NOT NULL AND trim(a || b || c) <> ''
        ),
        gone AS (SELECT DISTINCT doc_id, i + k AS i FROM told, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1),
        marked AS (SELECT line.doc_id, line.i, line.l, gone.i IS NOT NULL AS out FROM line LEFT JOIN gone USING (doc_id, i))
        SELECT w.doc_id, CAST(len(w.lines) AS BIGINT) AS n_lines, CAST(coalesce(m.n, 0) AS BIGINT) AS n_removed,
            CASE WHEN w.text IS NOT NULL THEN coalesce(m.kept, '') END AS text
        FROM whole w LEFT JOIN (
            SELECT doc_id, count(*) FILTER (WHERE out) AS n, string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT out) AS kept FROM marked GROUP BY doc_id
        ) m USING (doc_id)
    """,
}

"""Driver-facing queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import licenses
from .common import work_folder


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .elias_fano import read_corpus, write_corpus

    folder = work_folder(spark, "ids")
    write_corpus(_documents(spark, sf_dir), folder)
    return read_corpus(spark, folder)


def op2_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ogg import media_digest

    return media_digest(_documents(spark, sf_dir))


def op3_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(_documents(spark, sf_dir))


def op4_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import digest, scan

    return digest(scan(_documents(spark, sf_dir)))


def op5_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import scored, train

    docs = _documents(spark, sf_dir)
    return scored(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op6_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def op7_bigru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import predicted, train

    docs = _documents(spark, sf_dir)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = predicted(docs, train(docs, docs.where(~held)))
    return found.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_documents(spark, sf_dir))


def op9_dual_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .covertree import top_k, whole_vectors

    vectors = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import schedule

    return schedule(_documents(spark, sf_dir))


QUERIES = {
    "op1_elias_fano": op1_elias_fano,
    "op2_ogg": op2_ogg,
    "op3_simhash_neardup": op3_simhash_neardup,
    "op4_secret_battery": op4_secret_battery,
    "op5_ordinal_toxicity": op5_ordinal_toxicity,
    "op6_license_join": op6_license_join,
    "op7_bigru_language": op7_bigru_language,
    "op8_residual_packing": op8_residual_packing,
    "op9_dual_cover_tree": op9_dual_cover_tree,
    "op10_temperature_mixing": op10_temperature_mixing,
}
ORACLES: dict[str, str] = {
    "op6_license_join": licenses.oracle(),
    "op9_dual_cover_tree": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
    """,
}

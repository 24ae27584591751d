"""From raw documents to packed training sequences: a chain of the training-data operators.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; run() applies them to the documents table.
In every stage a null text counts as empty, texts are read whole however long they are, an empty table gives an empty table, columns that
aren't needed are passed on as they are whatever their names, and each row of several equal ones is judged like the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import stored
from granary.llm.mixing import mixed
from granary.llm.packing import pack
from granary.llm.secrets import masked
from granary.llm.simhash import keep_one
from granary.llm.toxicity import accepted


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected grade isn't toxic, by a model of the labelled documents.

    Null and empty texts have no mark of toxicity and stay; labels that are null or of no document teach nothing; without labels of both classes
    all rows stay; equal rows stay or go together.
    """
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: word five-shingles alike by 0.8 or more, directly or through others.

    The smallest doc_id stays (a null one last, of equal rows one); all null, empty and blank texts are one group.
    """
    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked.

    Null texts stay null, texts without a secret stay as they are, overlapping spans get one mark; equal texts are masked alike.
    """
    return masked(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, those of small sources repeated towards even weights.

    A null source is a source; a source without any token is there once; equal rows are repeated equally often.
    """
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences.

    Null and empty texts have their end id alone; each of several equal rows, and each repetition, is packed.
    """
    return pack(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]
#: No stage but the fourth can be said in SQL; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir).select(*[F.col(c) for c in docs.columns]), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Small relational building blocks used by many operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only where it is unset and all runs in one process, as in tests."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if top:
        return top
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"file://{tempfile.gettempdir()}/{name}"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder."""
    return f"{shared_folder(spark, 'granary-work').rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage: written to the cluster's shared folder and read again, so that its size is what was written.

    A checkpoint() keeps the plan's estimate, and joins multiply estimates: over rounds of a loop they become numbers of megabytes.
    """
    folder = work_folder(df.sparkSession, "cut")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small_side(df: DataFrame, limit: int = 500_000) -> DataFrame:
    """df marked for broadcast if it has few rows, else as it is; df should be stored, as its rows are counted."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in order. The order must be total; Spark keeps one row a key before the shuffle."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


def duplicates(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """What latest() leaves out."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rn > 1").drop("_rn")


def record_hash(columns: list[Column]) -> Column:
    """SHA-256 over the columns' texts; a missing value is told from an empty one."""
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns]), 256)


def ranked(df: DataFrame, value: str, tie: str, place: str = "place", ranges: int = 256) -> DataFrame:
    """df with each row's place (from 1) by value, highest first, nulls last, then by tie.

    Rows are dealt to ranges between quantiles; a place is the count of rows in higher ranges and the place within its own.
    """
    cuts = df.agg(F.percentile_approx(value, [i / ranges for i in range(1, ranges)])).first()[0] or []
    limits = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    dealt = df.withColumn("_range", F.when(F.col(value).isNull(), -1).otherwise(F.size(F.filter(limits, lambda c: c <= F.col(value)))))
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_rows"))  # as many rows as there are ranges
    ahead = counts.select("_range", F.coalesce(F.sum("_rows").over(Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(value).desc_nulls_last(), tie))
    return dealt.withColumn("_within", within).join(F.broadcast(ahead), "_range").withColumn(place, (F.col("_ahead") + F.col("_within")).cast("long")).drop("_range", "_within", "_ahead")


def as_of(versions: DataFrame, day: Column | str, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """The versions in force on a day."""
    d = F.lit(day).cast("date") if isinstance(day, str) else day
    return versions.where((F.col(start) <= d) & (F.col(end) >= d))


def join_as_of(facts: DataFrame, versions: DataFrame, key: str, day: str, how: str = "left") -> DataFrame:
    """Facts with the version of their key in force on their day: an equality join with a range residual."""
    v = versions.withColumnRenamed(key, "_key")
    return facts.join(v, (facts[key] == v["_key"]) & (v["effective_from"] <= facts[day]) & (v["effective_to"] >= facts[day]), how).drop("_key")

"""Checks of one layer against another, with differences that a known cause explains."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import duplicates

TOLERANCE = 0.005


def status(expected: Column, actual: Column, explained: Column) -> Column:
    """MATCHED, EXPLAINED (the difference is what its cause accounts for) or MISMATCH."""
    diff = F.round(actual - expected, 2)
    return F.when(F.abs(diff) <= TOLERANCE, "MATCHED").when((F.abs(explained) > TOLERANCE) & (F.abs(diff - explained) <= TOLERANCE), "EXPLAINED").otherwise("MISMATCH")


def check(name: str, expected: DataFrame, actual: DataFrame, explained: DataFrame | None = None) -> DataFrame:
    """One row from frames of one number each."""
    e, a = expected.toDF("expected"), actual.toDF("actual")
    x = explained.toDF("explained") if explained is not None else e.select(F.lit(0.0).alias("explained")).limit(1)
    one = e.crossJoin(a).crossJoin(x)  # single rows
    nums = one.select(F.lit(name).alias("check_name"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ("expected", "actual", "explained")])
    return nums.withColumn("status", status(F.col("expected"), F.col("actual"), F.col("explained")))


def run_checks(runs: DataFrame, entities: DataFrame) -> DataFrame:
    """batch_status, and load_status of each expected entity, from a stage's latest run (entity, status; "*" is the run itself).

    An entity counts as loaded if that run committed it, or skipped it because an earlier attempt had.
    """
    own = runs.where("entity = '*'").agg(F.coalesce(F.max("status"), F.lit("NOT RUN")).alias("status")).select(F.lit("batch_status").alias("check_name"), (F.col("status") == "COMPLETED").cast("double").alias("actual"))
    loaded = entities.select("entity").join(runs.where("entity <> '*'"), "entity", "left").select(F.concat_ws(" ", F.lit("load_status"), "entity").alias("check_name"), F.coalesce(F.col("status").isin("COMMITTED", "SKIPPED"), F.lit(False)).cast("double").alias("actual"))
    rows = own.unionByName(loaded).select("check_name", F.lit(1.0).alias("expected"), "actual", F.lit(0.0).alias("explained"))
    return rows.withColumn("status", status(F.col("expected"), F.col("actual"), F.col("explained")))


def deduplicated_total(name: str, before: DataFrame, after: DataFrame, keys: list[str], order: list[Column], amount: str, total: str | None = None) -> DataFrame:
    """The sum of an amount before and after one row a key stays; what the others had explains the difference."""
    out = duplicates(before, keys, order).agg(-F.coalesce(F.sum(amount), F.lit(0)).cast("double"))
    return check(name, before.agg(F.sum(amount)), after.agg(F.sum(total or amount)), out)


def truth_checks(planted: DataFrame, due: Column, alerts: DataFrame, today: Column) -> DataFrame:
    """Alerts (rule_code, subject) against what was planted: how many that are due were found, and how many of today's nobody planted.

    Both sides are compared by distinct keys, by anti-joins.
    """
    keys = ["rule_code", "subject"]
    wanted = planted.where(due).select(*keys).distinct()
    missed = wanted.join(alerts.select(*keys).distinct(), keys, "left_anti")
    counts = wanted.agg(F.count("*").alias("n")).crossJoin(missed.agg(F.count("*").alias("m"))).select(F.col("n") - F.col("m"))  # single rows
    extra = alerts.where(today).select(*keys).distinct().join(planted.select(*keys), keys, "left_anti")
    nothing = extra.sparkSession.createDataFrame([(0.0,)], "v double")
    return check("truth_planted", wanted.agg(F.count("*")), counts).unionByName(check("truth_unexpected", nothing, extra.agg(F.count("*"))))


def report(results: DataFrame, folder: str) -> str:
    """The mismatches as one CSV file in a folder of any file system; results are a few rows a batch."""
    text = io.StringIO()
    out = csv.writer(text)
    out.writerow(results.columns)
    out.writerows(results.where("status = 'MISMATCH'").orderBy(*results.columns).collect())
    spark = results.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/mismatch_report.csv")
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(text.getvalue().encode()))
    stream.close()
    return str(target)

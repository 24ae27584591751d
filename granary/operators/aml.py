"""Money-laundering alert rules over payments, and the alert table's keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.banking import evidence

#: The rules' codes, severities and parameters.
STRUCTURING = {"rule_code": "AML-STR-01", "severity": "HIGH", "band_from": 40_000.0, "band_to": 49_999.99, "min_count": 3, "days": 3}
PASS_THROUGH = {"rule_code": "AML-PTH-01", "severity": "HIGH", "min_credits": 8, "min_credit_total": 50_000.0, "min_out_ratio": 0.9}


def last_days(facts: DataFrame, day: str, n: int, column: str = "business_date") -> DataFrame:
    """The last n dates that the facts have, up to day: one narrow column."""
    return facts.where(F.col(column) <= F.lit(day).cast("date")).select(column).distinct().orderBy(F.desc(column)).limit(n)


def _placed(rows: DataFrame) -> DataFrame:
    """With each payment's place in its account, in order of ids."""
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy("account_key").orderBy(F.asc_nulls_last("msg_id"))))


def structuring(payments: DataFrame, day: str, rule: dict = STRUCTURING) -> DataFrame:
    """Accounts with several cash credits just under a threshold within the last dates of the facts."""
    window = F.broadcast(last_days(payments, day, rule["days"]))  # as many rows as the rule has days
    hits = payments.where((F.col("direction") == "CR") & (F.col("channel") == "CASH") & (F.col("status") == "SETTLED") & F.col("amount").between(rule["band_from"], rule["band_to"]))
    found = _placed(hits.join(window, "business_date", "left_semi")).groupBy("account_key").agg(F.count("*").alias("hits"), F.sum("amount").alias("amount"), F.min("value_date").alias("first_date"), F.max("value_date").alias("last_date"), evidence(F.col("msg_id"), F.col("_place")).alias("evidence"))
    return found.where(F.col("hits") >= rule["min_count"]).withColumn("rule_code", F.lit(rule["rule_code"]))


def pass_through(payments: DataFrame, day: str, rule: dict = PASS_THROUGH) -> DataFrame:
    """Accounts that on one date take many credits and send nearly all on; no debit never alerts."""
    credit = F.col("direction") == "CR"
    found = _placed(payments.where((F.col("status") == "SETTLED") & (F.col("business_date") == F.lit(day).cast("date")))).groupBy("account_key").agg(F.count_if(credit).alias("hits"), F.sum(F.when(credit, F.col("amount"))).alias("amount"), F.sum(F.when(F.col("direction") == "DR", F.col("amount"))).alias("sent"), evidence(F.col("msg_id"), F.col("_place")).alias("evidence"))
    return found.where((F.col("hits") >= rule["min_credits"]) & (F.col("amount") >= rule["min_credit_total"]) & (F.col("sent") >= rule["min_out_ratio"] * F.col("amount"))).withColumn("rule_code", F.lit(rule["rule_code"]))


def watchlist(parties: DataFrame, entries: DataFrame, day: str) -> DataFrame:
    """Parties that an active entry names by PAN, or by name and date of birth; PAN counts where both do."""
    d = F.lit(day).cast("date")
    active = entries.where((F.col("listed_on") <= d) & (F.col("delisted_on").isNull() | (F.col("delisted_on") > d)))
    by_pan = parties.join(active.select("entry_id", "pan_std"), "pan_std").select("party_id", "entry_id", F.lit("AML-WL-01").alias("rule_code"))
    by_name = parties.join(active.select("entry_id", "name_key", "dob"), ["name_key", "dob"]).select("party_id", "entry_id", F.lit("AML-WL-02").alias("rule_code"))
    ranked = by_pan.unionByName(by_name).withColumn("_rn", F.row_number().over(Window.partitionBy("party_id", "entry_id").orderBy("rule_code")))
    return ranked.where("_rn = 1").drop("_rn")


def alert_id(rule: Column, subject: Column, day: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", rule, subject, day.cast("string")), 256), 1, 16)


def with_novelty(alerts: DataFrame, earlier: DataFrame) -> DataFrame:
    """is_new: no earlier alert of the rule on the subject."""
    seen = earlier.select("rule_code", "subject").distinct().withColumn("_seen", F.lit(True))
    return alerts.join(seen, ["rule_code", "subject"], "left").withColumn("is_new", F.col("_seen").isNull()).drop("_seen")

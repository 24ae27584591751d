"""Consumers of the gold layer: parameters, regulatory loads, dashboard views, checks against planted truth.

Each function takes the lakehouse, and reads certified tables only.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import banking
from ..operators import audit, reconcile
from ..operators.relational import as_of, cut, ranked

#: Rates and spreads of the indicators.
SPREADS = {"casa_spread": 0.030, "td_spread": 0.015, "fee_window_days": 30.0, "annualisation_factor": 12.0}
MARGINS = {"HL01": 0.020, "AL01": 0.030, "PL01": 0.050, "BL01": 0.040}
DEFINITIONS = [("NPA", "NPA exposure", "kpi_npa_exposure"), ("CASA", "CASA ratio", "kpi_casa_ratio"), ("CRV", "Customer relationship value", "kpi_customer_relationship_value")]
LAYERS = {"bronze": "1 Bronze", "silver": "2 Silver", "gold": "3 Gold", "semantic": "4 Semantic"}


def parameters(house) -> DataFrame:
    """(kpi_code, parameter, value): nested settings by dotted names."""
    rows = [("NPA", f"provision_rate.{k}", float(v)) for k, v in banking.PROVISION.items()] + [("NPA", "npa_dpd", float(banking.NPA_DPD))]
    rows += [("CRV", k, float(v)) for k, v in SPREADS.items()] + [("CRV", f"lending_margin.{k}", float(v)) for k, v in MARGINS.items()]
    return house.spark.createDataFrame(rows, "kpi_code string, parameter string, value double")


def definitions(house) -> DataFrame:
    return house.spark.createDataFrame(DEFINITIONS, "kpi_code string, name string, certified_view string")


def asset_classification(house, day: str) -> DataFrame:
    """Loans of a reporting date with the version of their dimension that was in force."""
    loans = house.slice("gold", "fact_loan_position_daily", day)
    dims = as_of(house.read("gold", "dim_loan"), day).select("loan_key", "loan_id", F.col("loan_status"))
    return loans.join(dims, "loan_key", "left").select(F.col("business_date").alias("reporting_date"), "loan_id", "party_id", "product_code", "branch_code", "dpd", "sma_status", "asset_class", "is_npa", "npa_since", "loan_status", "principal_outstanding", (F.col("principal_outstanding") * F.col("provision_rate")).cast("decimal(18,2)").alias("provision_amount"))


def deposit_composition(house, day: str) -> DataFrame:
    b = F.col("balance_inr")
    band = F.when(b < 100_000, "UNDER_1_LAKH").when(b < 1_000_000, "1_TO_10_LAKH").when(b < 10_000_000, "10_LAKH_TO_1_CRORE").otherwise("OVER_1_CRORE")
    return house.slice("gold", "fact_deposit_balance_daily", day).groupBy(F.col("business_date").alias("reporting_date"), "branch_code", "product_code", "deposit_type", band.alias("size_band")).agg(F.count("*").alias("accounts"), F.sum(b).cast("decimal(18,2)").alias("balance"))


def relationship_value(house, day: str) -> DataFrame:
    """Annual value of each resolved party: deposits at their spread, performing loans at their margin, fees of the window."""
    d = F.lit(day).cast("date")
    known = F.col("party_id") != "UNKNOWN"
    margin = F.coalesce(*[F.when(F.col("product_code") == k, v) for k, v in MARGINS.items()], F.lit(0.0))
    deposits = house.slice("gold", "fact_deposit_balance_daily", day).where(known).select("party_id", (F.col("balance_inr") * F.when(F.col("is_casa"), SPREADS["casa_spread"]).otherwise(SPREADS["td_spread"])).alias("v"))
    loans = house.slice("gold", "fact_loan_position_daily", day).where(known & ~F.col("is_npa")).select("party_id", (F.col("principal_outstanding") * margin).alias("v"))
    window = F.datediff(d, "business_date")
    first = str(date.fromisoformat(day) - timedelta(days=int(SPREADS["fee_window_days"]) - 1))
    fees = house.table("gold", "fact_payment").read(between=("business_date", first, day)).where(known & (F.col("status") == "SETTLED") & (F.col("fee_amount") > 0) & (window >= 0) & (window < SPREADS["fee_window_days"])).select("party_id", (F.col("fee_amount") * SPREADS["annualisation_factor"]).alias("v"))
    return deposits.unionByName(loans).unionByName(fees).groupBy("party_id").agg(F.sum(F.col("v").cast("decimal(18,2)")).cast("decimal(18,2)").alias("crv")).withColumn("reporting_date", d)


def profitability(house, day: str) -> DataFrame:
    """Parties by annual value, with their place among all.

    A place is what stands in higher ranges of values and the place within its own range, so no task holds all parties.
    """
    parties = as_of(house.read("gold", "dim_party"), day).select("party_id", F.coalesce("segment", F.lit("UNRESOLVED")).alias("segment"))
    return ranked(cut(relationship_value(house, day).join(parties, "party_id", "left")), "crv", "party_id")


def load(house, day: str) -> None:
    """Reference tables and the day's partition of every regulatory table."""
    batch = house.batch(day)
    house._all("ref", "kpi_parameter", parameters(house), batch)
    house._all("ref", "kpi_definition", definitions(house), batch)
    for name, build in (("reg_asset_classification", asset_classification), ("reg_deposit_composition", deposit_composition), ("rpt_customer_profitability", profitability)):
        house._put(house.table("semantic", name), build(house, day), ["reporting_date"], day, batch)


def dash_recon(house) -> DataFrame:
    r = house.read("ref", "recon_results")
    newest = r.agg(F.max("batch_id").alias("newest"))
    label = F.coalesce(*[F.when(F.col("layer") == k, v) for k, v in LAYERS.items()], F.col("layer"))
    flags = {f"is_{s.lower()}": (F.col("status") == s).cast("int") for s in ("MATCHED", "EXPLAINED", "MISMATCH")}
    return r.join(F.broadcast(newest)).withColumns({"layer_label": label, **flags, "is_latest": (F.col("batch_id") == F.col("newest")).cast("int")}).drop("newest")  # one row


def dash_load_audit(house) -> DataFrame:
    return audit.last_attempts(house.audit())


def dash_match_pair(house) -> DataFrame:
    return house.read("mdm", "match_pair").withColumns({"for_review": (F.col("decision") == "REVIEW").cast("int"), "is_merge": (F.col("decision") == "MERGE").cast("int")})


def dash_party_xref(house) -> DataFrame:
    return house.read("mdm", "party_xref").withColumns({"is_active": F.col("is_active").cast("int"), "moved_party": F.col("previous_party_id").isNotNull().cast("int")})


def dash_golden_party(house) -> DataFrame:
    return house.read("mdm", "golden_party").withColumns({"is_merged": (F.col("member_count") > 1).cast("int"), "has_pan_conflict": F.col("has_pan_conflict").cast("int")})


def dash_aml_alert(house) -> DataFrame:
    alerts = house.read("gold", "fact_aml_alert")
    return alerts.join(house.read("gold", "dim_party").where("is_current").select("party_id", "full_name", "segment"), "party_id", "left")


def dash_match_quality(house) -> DataFrame:
    """Entity resolution against the generator's truth, as each batch left it."""
    t = house.table("mdm", "match_quality")
    batches = sorted({r.batch_id for r in t.history().select("batch_id").collect() if r.batch_id})
    rows = [t.read(batch=b).select("batch_id", F.col("precision").alias("match_precision"), F.col("recall").alias("match_recall"), "split_persons", "merged_parties") for b in batches]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("is_latest", (F.col("batch_id") == batches[-1]).cast("int"))


def batch_snapshots(table) -> DataFrame:
    """A table's snapshot before and after every committed step of a batch."""
    return table.history().where("batch_id IS NOT NULL").select("batch_id", "operation", F.col("parent").alias("snapshot_before"), F.col("version").alias("snapshot_after"), "committed_at")


def ratio_as_reported(table, version: int) -> DataFrame:
    """The share of current and savings balances that a submitted dataset (reporting_date, deposit_type, balance) said at a version, whatever restated it later."""
    rows = table.read(version=version).groupBy("reporting_date").agg(F.sum(F.when(F.col("deposit_type").isin("SAVINGS", "CURRENT"), F.col("balance")).otherwise(0)).cast("double").alias("casa_balance"), F.sum("balance").cast("double").alias("deposits"))
    return rows.withColumn("casa_ratio", F.round(F.col("casa_balance") / F.col("deposits"), 6))


def versions_of(dimension: DataFrame, keys: list[str], **values) -> DataFrame:
    """Every business version of a key, as rows of the current snapshot, in order."""
    found = dimension
    for k in keys:
        found = found.where(F.col(k) == values[k])
    return found.orderBy("version")


def kpi_checks(house, day: str) -> DataFrame:
    """Every consumer's figures of a date against gold's: a row each.  A table is read once; a row of sums of each reaches the driver."""
    d = F.lit(day).cast("date")

    def sums(df: DataFrame, **columns) -> dict[str, float]:
        return {k: float(v or 0) for k, v in df.agg(*[F.coalesce(c.cast("double"), F.lit(0.0)).alias(k) for k, c in columns.items()]).first().asDict().items()}

    on = lambda condition, value: F.sum(F.when(condition, value))
    principal, rate, balance = F.col("principal_outstanding"), F.col("provision_rate"), F.col("balance_inr")
    bad, kept = F.col("is_npa"), F.col("deposit_type").isin("SAVINGS", "CURRENT")
    loans = sums(house.slice("gold", "fact_loan_position_daily", day), all=F.sum(principal), bad=on(bad, principal), loans=F.count("*"), bad_loans=F.count_if(bad), standard=on(F.col("asset_class") == "STANDARD", principal), loss=F.sum((principal * rate).cast("decimal(18,2)")), exact=F.sum(principal * rate))
    reg = sums(house.read("semantic", "reg_asset_classification").where(F.col("reporting_date") == d), all=F.sum(principal), bad=on(bad, principal), loans=F.count("*"), bad_loans=F.count_if(bad), standard=on(F.col("asset_class") == "STANDARD", principal), loss=F.sum("provision_amount"))
    deposits = sums(house.slice("gold", "fact_deposit_balance_daily", day), all=F.sum(balance), casa=on(F.col("is_casa"), balance), accounts=F.count("*"))
    comp = sums(house.read("semantic", "reg_deposit_composition").where(F.col("reporting_date") == d), all=F.sum("balance"), casa=on(kept, F.col("balance")), accounts=F.sum("accounts"))
    trend = sums(house.read("semantic", "kpi_trend").where(F.col("business_date") == d), **{c: F.sum(c) for c in ("gross_advances", "gross_npa", "provision", "gross_npa_ratio", "deposits", "casa", "casa_ratio")})
    value = relationship_value(house, day)
    certified = sums(value, all=F.sum("crv"), parties=F.count("*"), best=F.max("crv"), unknown=F.count_if(F.col("party_id") == "UNKNOWN"))
    certified["top"] = sums(value.orderBy(F.desc("crv"), "party_id").limit(25), top=F.sum("crv"))["top"]
    place = F.col("place")
    said = sums(house.read("semantic", "rpt_customer_profitability").where(F.col("reporting_date") == d), all=F.sum("crv"), parties=F.count("*"), distinct=F.countDistinct("party_id"), last=F.max("place"), best=on(place == 1, F.col("crv")), top=on(place <= 25, F.col("crv")), unknown=F.count_if(F.col("party_id") == "UNKNOWN"))
    ratio = lambda part, whole: round(part / whole, 6) if whole else 0.0
    rows = [(f"npa reg_asset_classification {k}", loans[k], reg[k]) for k in ("all", "bad", "loans", "bad_loans", "standard", "loss")]
    rows += [("npa kpi_trend gross_advances", loans["all"], trend["gross_advances"]), ("npa kpi_trend gross_npa", loans["bad"], trend["gross_npa"]), ("npa kpi_trend provision", loans["exact"], trend["provision"]), ("npa kpi_trend ratio", ratio(loans["bad"], loans["all"]), trend["gross_npa_ratio"])]
    rows += [(f"casa reg_deposit_composition {k}", deposits[k], comp[k]) for k in ("all", "casa", "accounts")]
    rows += [("casa kpi_trend deposits", deposits["all"], trend["deposits"]), ("casa kpi_trend casa", deposits["casa"], trend["casa"]), ("casa kpi_trend ratio", ratio(deposits["casa"], deposits["all"]), trend["casa_ratio"])]
    rows += [(f"crv rpt_customer_profitability {k}", certified[k], said[k]) for k in ("all", "parties", "best", "top", "unknown")]
    rows += [("crv rpt_customer_profitability distinct", certified["parties"], said["distinct"]), ("crv rpt_customer_profitability last place", certified["parties"], said["last"])]
    checks = house.spark.createDataFrame([(n, e, a, 0.0) for n, e, a in rows], "check_name string, expected double, actual double, explained double")
    # ratios have more places than amounts
    fine = F.when(F.col("check_name").endswith("ratio"), F.when(F.abs(F.col("expected") - F.col("actual")) < 5e-6, "MATCHED").otherwise("MISMATCH"))
    return checks.withColumn("status", F.coalesce(fine, reconcile.status(F.col("expected"), F.col("actual"), F.col("explained"))))


def unresolved(house, day: str) -> DataFrame:
    """Accounts without a party, and why: their owner is in quarantine or hasn't come yet; NULL where the owner is there."""
    facts = house.slice("gold", "fact_deposit_balance_daily", day).where("party_id = 'UNKNOWN'").select("account_key").distinct()
    owners = house.read("silver", "cbs_account").select("account_key", F.col("cust_id").cast("string").alias("cust_id"))
    held = house.read("bronze", "quarantine").where((F.col("_entity") == "cbs_customer") & (F.col("_business_date") <= F.lit(day).cast("date"))).select(F.get_json_object("_record", "$.cust_id").alias("cust_id"), F.lit("QUARANTINED").alias("why")).distinct()
    there = house.read("silver", "cbs_customer", house.batch(day)).where("NOT _is_deleted").select(F.col("cust_id").cast("string").alias("cust_id"), F.lit(True).alias("there"))
    return facts.join(owners, "account_key", "left").join(held, "cust_id", "left").join(there, "cust_id", "left").select("account_key", "cust_id", F.when(F.col("there").isNull(), F.coalesce("why", F.lit("NOT_YET_RECEIVED"))).alias("why"))


def mapping_gaps(df: DataFrame, mapped: list[str]) -> list[str]:
    """Columns that no row of the source mapping names: a build with any must fail."""
    return sorted(set(df.columns) - set(mapped))

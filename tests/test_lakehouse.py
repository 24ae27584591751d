"""Five days of a small bank from landing files to indicators, with every planted fault accounted for."""

import pytest
from pyspark.sql import functions as F

from granary.operators import audit
from granary.plans import consumers
from granary.plans.lakehouse import Lakehouse, live_match
from granary.sources.generator import DATES


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("bank")
    h = Lakehouse(spark, f"file://{top}/warehouse", f"file://{top}/landing", customers=24)
    h.run(DATES[0])
    with pytest.raises(Exception, match="planted failure"):
        h.run(DATES[1], ("land", "bronze"), "fail-during:pay_transaction")
    with pytest.raises(audit.StageNotReady):
        h.run(DATES[1], ("silver",))
    h.run(DATES[1], ("bronze",), "resume")
    h.run(DATES[1], ("silver", "mdm", "gold", "recon", "semantic"))
    return h


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_bronze_quarantine(house):
    q = house.read("bronze", "quarantine").where(F.col("_business_date") == DATES[0])
    found = rows(q, "_entity", F.array_join("_reject_reasons", ","))
    assert ("cbs_customer", "last_name:REQUIRED") in found and ("cbs_customer", "dob:INVALID_DATE") in found and ("pay_transaction", "amount:REQUIRED") in found
    second = {x for x in rows(house.read("bronze", "quarantine").where(F.col("_business_date") == DATES[1]), "_entity", F.array_join("_reject_reasons", ","))}
    assert ("cbs_eod_balance", "ledger_balance:NOT_DECIMAL") in second and ("lms_loan", "dpd:NOT_INTEGER") in second and ("pay_transaction", "currency:NOT_ALLOWED") in second


def test_resume_skips_what_was_committed(house):
    last = house.audit().where((F.col("batch_id") == Lakehouse.batch(DATES[1])) & (F.col("stage") == "bronze"))
    status = {r.entity: r.status for r in audit.last_attempts(last).collect()}
    assert status["cbs_eod_balance"] == "SKIPPED" and status["pay_transaction"] == "COMMITTED" and status["*"] == "COMPLETED"


def test_change_capture(house):
    x = rows(house.read("silver", "cdc_exception"), "exception", "action")
    assert ("UPSERT_UNKNOWN_KEY", "INSERTED") in x
    c = house.read("silver", "cbs_customer").where("cust_id = 100001").first()
    assert c.last_name == "Corrected" and not c._is_deleted


def test_master_data(house):
    q = house.read("mdm", "match_quality").first()
    assert q.precision >= 0.95 and q.recall >= 0.6
    g = house.read("mdm", "golden_party")
    assert g.count() == g.select("party_id").distinct().count() and g.where("full_name IS NULL").count() == 0


def test_history_and_facts(house):
    p = house.read("gold", "dim_party")
    assert p.groupBy("party_id").agg(F.count_if("is_current").alias("n")).where("n > 1").count() == 0
    assert p.where("party_id = 'UNKNOWN'").count() >= 1
    facts = house.read("gold", "fact_loan_position_daily")
    assert facts.where("asset_class = 'LOSS'").count() > 0 and facts.where("is_npa AND npa_since IS NULL").count() == 0
    assert house.read("gold", "fact_aml_alert").where("rule_code = 'AML-WL-01'").count() >= 1


def test_reconciliation(house):
    r = house.read("ref", "recon_results")
    bad = rows(r.where("status = 'MISMATCH'"), "batch_id", "check_name")
    assert bad == []
    assert r.where("status = 'EXPLAINED'").count() > 0


def test_runs_totals_and_truth(house):
    r = {(x.batch_id, x.check_name): x for x in house.read("ref", "recon_results").collect()}
    second = house.batch(DATES[1])
    assert r[second, "batch_status"].status == r[second, "load_status pay_transaction"].status == "MATCHED"
    assert r[second, "silver_total pay_transaction"].status == "EXPLAINED"  # a message stands twice
    assert r[second, "truth_planted"].expected == 1 and r[second, "truth_unexpected"].actual == 0
    assert r[second, "party_resolved fact_deposit_balance_daily"].status in ("MATCHED", "EXPLAINED")


def test_transform_log(house):
    log = house.read("ref", "transform_log")
    kinds = {x.transform_type for x in log.select("transform_type").distinct().collect()}
    assert kinds <= set(audit.TRANSFORM_TYPES) and {"ingest", "validate", "standardise", "deduplicate", "match", "survive", "historise", "enrich", "aggregate", "consume"} <= kinds
    # what the failed attempt did before it failed is there too
    assert log.where(f"stage = 'bronze' AND batch_id = '{house.batch(DATES[1])}' AND transform_type = 'ingest'").groupBy("step").count().where("count > 1").count() == 0
    with pytest.raises(ValueError):
        audit.TransformLog("b", "s").add("x", "nonsense", "", "")


def test_snapshots_and_versions(house):
    steps = consumers.batch_snapshots(house.table("mdm", "golden_party")).orderBy("snapshot_after").collect()
    assert [s.batch_id for s in steps] == [house.batch(d) for d in DATES[:2]] and steps[1].snapshot_before == steps[0].snapshot_after
    t = house.table("semantic", "reg_deposit_composition")
    said = {x.reporting_date: x.casa_ratio for x in consumers.ratio_as_reported(t, t.versions()[-1]).collect()}
    trend = {x.business_date: x.casa_ratio for x in house.read("semantic", "kpi_trend").collect()}
    assert said.keys() == trend.keys() and all(abs(said[d] - trend[d]) < 1e-6 for d in said)
    versions = consumers.versions_of(house.read("gold", "dim_party"), ["party_id"], party_id="UNKNOWN").collect()
    assert [v.version for v in versions] == list(range(1, len(versions) + 1))
    q = consumers.dash_match_quality(house)
    assert q.count() == 2 and q.where("is_latest = 1").count() == 1


def test_time_travel(house):
    t = house.table("gold", "dim_party")
    assert t.read(batch=Lakehouse.batch(DATES[0])).count() <= t.read().count()
    k = house.read("semantic", "kpi_trend")
    assert k.count() == 2 and k.where("casa_ratio BETWEEN 0 AND 1").count() == 2


def test_consumers(house):
    checks = house.read("ref", "recon_results").where("layer = 'semantic'")
    assert checks.count() == 46 and checks.where("status <> 'MATCHED'").count() == 0
    for view in (consumers.dash_recon, consumers.dash_load_audit, consumers.dash_match_pair, consumers.dash_party_xref, consumers.dash_golden_party, consumers.dash_aml_alert):
        assert view(house).count() > 0
    why = rows(consumers.unresolved(house, DATES[0]), "why")
    assert set(why) <= {("QUARANTINED",), ("NOT_YET_RECEIVED",)} and why
    assert house.read("semantic", "reg_asset_classification").select("reporting_date").distinct().count() == 2
    assert consumers.mapping_gaps(house.read("gold", "dim_branch"), ["branch_code"]) != []


def test_live_match(spark):
    a = {"src_system": "CBS", "src_key": "1", "full_name": "Mr. Ravi Kumar Sharma", "dob": "1980-01-02", "address": "1 MG Rd. Pune 411001"}
    b = {"src_system": "CRM", "src_key": "2", "full_name": "Sharma Ravi Kumer", "dob": "1980-01-02", "address": "1 MG Road, Pune 411001"}
    c = {"src_system": "LMS", "src_key": "3", "full_name": "Someone Else", "dob": "1980-01-02", "address": "9 X Pune 411001"}
    assert live_match([a, b, c], spark).count() == 2


def test_a_day_run_again_without_rows_loses_its_old_ones(spark, tmp_path):
    house = Lakehouse(spark, f"file://{tmp_path}/w", f"file://{tmp_path}/l")
    t = house.table("silver", "x")
    day = lambda d, *v: spark.createDataFrame([(x, d) for x in v], "v int, business_date string").selectExpr("v", "CAST(business_date AS DATE) AS business_date")
    house._put(t, day("2026-01-01", 1, 2), ["business_date"], "2026-01-01", "a")
    house._put(t, day("2026-01-02", 3), ["business_date"], "2026-01-02", "b")
    house._put(t, day("2026-01-01"), ["business_date"], "2026-01-01", "a")
    assert rows(t.read(), "v") == [(3,)]
    house._put(t, day("2026-01-02", 4, 5), ["business_date"], "2026-01-02", "b")
    assert rows(t.read(), "v") == [(4,), (5,)] and rows(t.read(version=1), "v") == [(1,), (2,), (3,)]


def test_places_of_customers_are_global(house):
    r = house.read("semantic", "rpt_customer_profitability").where(F.col("reporting_date") == DATES[1])
    got = [(-x.crv, x.party_id) for x in r.orderBy("place").collect()]
    assert got == sorted(got) and [x.place for x in r.orderBy("place").collect()] == list(range(1, len(got) + 1))


def test_report_of_mismatches(house, tmp_path):
    from granary.operators import reconcile

    results = house.read("ref", "recon_results")
    assert open(reconcile.report(results, f"file://{tmp_path}/r").removeprefix("file:")).read().splitlines() == [",".join(results.columns)]

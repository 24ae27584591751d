"""The driver's customers, orders and nations landed as one business date of a bank, and what the batch makes of it.

Faults are planted by key: customers without a last name, balances that aren't numbers or come twice, payments of unknown
channels and currencies.  All queries read one run of the batch a session and folder of tables;
it goes as far as the stage that they read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relational
from ..ship import ship
from ..sources import writers
from ..sources.contracts import CONTRACTS
from .files import landed
from .lakehouse import Lakehouse
from .registry import Registry

_r = Registry()
QUERIES, ORACLES = _r.queries, _r.oracles
DAY = "2024-01-15"
PRODUCTS = [("SA01", "Savings", "SA", "DEPOSITS", "3"), ("CA01", "Current", "CA", "DEPOSITS", "0"), ("TD01", "Term", "TD", "DEPOSITS", "7"), ("HL01", "Home loan", "HL", "LENDING", "8")]

#: Each entity's columns as expressions over its table; others are NULL.
#: A person's PAN: four digits of the key and six letters for the rest of it, so that keys below 26 ** 6 * 10000 have one each and all have the form.
_LETTER = lambda place, first: f"char(65 + cast(({first} + c_custkey DIV {10000 * 26**place}) % 26 AS int))"
_PAN = f"concat({', '.join(_LETTER(i, i) for i in range(5))}, lpad(cast(c_custkey % 10000 AS string), 4, '0'), {_LETTER(5, 25)})"
_PERSON = {"pan": _PAN, "mobile": "concat('9', lpad(cast(c_custkey AS string), 9, '0'))", "dob": "date_add(DATE '1950-01-01', cast(c_custkey % 20000 AS int))"}
_BRANCH = "concat('BR', lpad(cast(c_nationkey AS string), 3, '0'))"
ROWS: dict[str, tuple[str, str, dict[str, str]]] = {
    "cbs_branch": ("nation", "true", {"branch_code": "concat('BR', lpad(cast(n_nationkey AS string), 3, '0'))", "ifsc": "concat('NORB0', lpad(cast(n_nationkey AS string), 6, '0'))", "branch_name": "n_name", "city": "n_name", "region": "'WEST'", "opened_on": "'2001-04-01'"}),
    "cbs_customer": ("customer", "true", {"cust_id": "100000 + c_custkey", "title": "'MS'", "first_name": "initcap(c_mktsegment)", "last_name": "CASE WHEN c_custkey % 50 <> 7 THEN translate(cast(c_custkey AS string), '0123456789', 'abcdefghij') END", "dob": _PERSON["dob"], "gender": "'F'", "pan": _PERSON["pan"], "mobile": _PERSON["mobile"], "addr_line1": "concat(c_custkey, ' MG Rd.')", "city": "'Pune'", "pincode": "'411001'", "kyc_status": "'VERIFIED'", "segment": "'MASS'", "home_branch": _BRANCH, "updated_at": "'2024-01-14 10:00:00'"}),
    "cbs_account": ("customer", "true", {"acct_no": "10000000000000 + c_custkey", "cust_id": "100000 + c_custkey", "product_code": "element_at(array('SA01', 'CA01', 'TD01'), cast(c_custkey % 3 + 1 AS int))", "branch_code": _BRANCH, "currency": "'INR'", "open_date": "'2020-01-15'", "status": "'ACTIVE'", "interest_rate": "'3.50'", "updated_at": "'2024-01-14 10:00:00'"}),
    "cbs_eod_balance": ("customer", "true", {"acct_no": "10000000000000 + c_custkey", "bal_date": f"'{DAY}'", "ledger_balance": "CASE WHEN c_custkey % 97 = 5 THEN 'N/A' ELSE cast(cast(c_acctbal AS decimal(18,2)) AS string) END", "available_balance": "'0.00'", "currency": "'INR'"}),
    "lms_borrower": ("customer", "c_custkey % 3 = 0", {"borrower_id": "concat('LB', lpad(cast(c_custkey AS string), 6, '0'))", "full_name": "concat(initcap(c_mktsegment), ' ', translate(cast(c_custkey AS string), '0123456789', 'abcdefghij'))", "dob": f"date_format({_PERSON['dob']}, 'dd/MM/yyyy')", "pan": f"lower({_PERSON['pan']})", "mobile": _PERSON["mobile"], "address": "'MG Rd.'", "updated_on": "'15/01/2024'"}),
    "lms_loan": ("customer", "c_custkey % 3 = 0", {"loan_id": "concat('LN', lpad(cast(c_custkey AS string), 8, '0'))", "borrower_id": "concat('LB', lpad(cast(c_custkey AS string), 6, '0'))", "product_code": "'HL01'", "branch_code": _BRANCH, "sanction_date": "'01/04/2022'", "sanction_amount": "'900000.00'", "principal_outstanding": "concat(100000 + c_custkey, '.25')", "dpd": "c_custkey % 1800", "loan_status": "'ACTIVE'", "loss_flag": "CASE WHEN c_custkey % 33 = 0 THEN 'Y' ELSE 'N' END", "as_of_date": "'15/01/2024'"}),
    "lms_repayment": ("customer", "c_custkey % 6 = 0", {"txn_id": "concat('T', c_custkey)", "loan_id": "concat('LN', lpad(cast(c_custkey AS string), 8, '0'))", "payment_date": "'15/01/2024'", "amount": "'9000.50'", "mode": "'NACH'"}),
    "aml_watchlist": ("supplier", "true", {"entry_id": "concat('WL', lpad(cast(s_suppkey AS string), 6, '0'))", "list_name": "'OFAC_SDN'", "entry_type": "'SANCTION'", "full_name": "'Nobody Known'", "pan": f"CASE WHEN s_suppkey % 5 = 0 THEN {_PERSON['pan'].replace('c_custkey', 's_suppkey')} END", "listed_on": "'01/01/2024'", "delisted_on": "CASE WHEN s_suppkey % 10 = 0 THEN '02/01/2024' END", "updated_on": "'01/01/2024'"}),
}
_PAYMENT = """to_json(struct(concat('M', o_orderkey) AS msg_id, '2024-01-15T09:00:00+05:30' AS created_at, '2024-01-15' AS value_date, CASE WHEN o_orderkey % 101 = 0 THEN 'PIGEON' ELSE 'NEFT' END AS channel,
    CASE WHEN o_orderkey % 2 = 0 THEN 'DR' ELSE 'CR' END AS direction, 'SETTLED' AS status, struct(cast(o_totalprice AS decimal(18,2)) AS value, CASE WHEN o_orderkey % 103 = 1 THEN 'XYZ' ELSE 'INR' END AS ccy) AS amount,
    CASE WHEN o_orderkey % 2 = 0 THEN own ELSE other END AS debtor, CASE WHEN o_orderkey % 2 = 0 THEN other ELSE own END AS creditor, array(struct('FEE' AS type, 5.0D AS amount), struct('GST' AS type, 0.9D AS amount)) AS charges))"""
_CRM = f"to_json(struct(concat('CRM-', lpad(lower(hex(c_custkey)), 8, '0')) AS crm_id, struct(initcap(c_mktsegment) AS full_name, {_PERSON['dob']} AS date_of_birth, 'F' AS gender) AS profile, struct({_PERSON['mobile']} AS mobile) AS contacts, '2024-01-15T08:00:00+05:30' AS updated_at))"


def _frame(t, entity: str) -> DataFrame:
    table, where, columns = ROWS[entity]
    rows = t(table).where(where).selectExpr(*[f"cast({columns.get(c['name'], 'NULL')} AS string) AS {c['name']}" for c in CONTRACTS[entity]["columns"]])
    if entity == "cbs_eod_balance":
        return rows.unionByName(rows.where("right(acct_no, 2) = '03'"))
    return rows


def _psv(columns: list[str], control: str | None) -> Callable[[Iterator[tuple]], Iterator[str]]:
    def lines(values: Iterator[tuple]) -> Iterator[str]:
        yield "|".join(columns)
        count, total = 0, Decimal(0)
        for row in values:
            count += 1
            if control and row[columns.index(control)] != "N/A":
                total += Decimal(row[columns.index(control)])
            yield "|".join("" if v is None else v for v in row)
        yield f"T|{count}|{total if control else ''}"

    return lines


def _array(values: Iterator[tuple]) -> Iterator[str]:
    yield "["
    for n, (item,) in enumerate(values):
        yield ("," if n else "") + item
    yield "]"


def _manifest(spark: SparkSession, folder: str, source: str, entities: list[dict]) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_manifest.json")
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(json.dumps({"source": source, "business_date": DAY, "batch_id": Lakehouse.batch(DAY), "entities": entities, "files": []}).encode()))
    stream.close()


def land(t, landing: str) -> None:
    """Every source's files of the day; each entity is a folder of files that its contract's pattern finds."""
    spark = t("nation").sparkSession
    at = lambda entity: f"{landing}/{CONTRACTS[entity]['source']}/{DAY}/" + CONTRACTS[entity]["files"].replace("*", CONTRACTS[entity]["table"] or "0")
    frames = {entity: _frame(t, entity) for entity in ROWS}
    own, other = "struct(struct(cast(10000000000000 + o_custkey AS string) AS number, 'NORB0000001' AS ifsc) AS account)", "struct(struct('77' AS number, CASE WHEN o_orderkey % 3 = 0 THEN 'NORB0000002' ELSE 'HDFC0000009' END AS ifsc) AS account)"
    frames["pay_transaction"] = t("orders").selectExpr("*", f"{own} AS own", f"{other} AS other").selectExpr(f"{_PAYMENT} AS payload")
    frames["crm_customer"] = t("customer").where("c_custkey % 4 = 1").selectExpr(f"{_CRM} AS payload")
    frames["cbs_product"] = spark.createDataFrame(PRODUCTS, ", ".join(f"{c['name']} string" for c in CONTRACTS["cbs_product"]["columns"]))
    frames["doc_document"] = t("region").selectExpr("concat('KYC declaration, customer ID: ', 100000 + r_regionkey) AS value")

    def write(entity: str, rows: DataFrame) -> dict:
        c, columns = CONTRACTS[entity], rows.columns
        if entity == "doc_document":
            rows.coalesce(1).write.text(f"{landing}/documents/{DAY}/notes")
            return {"entity": entity, "records": 1}
        lines = {"mysqldump": lambda v, c=c, columns=columns: writers.dump_lines({}, c["table"], columns, v), "psv": _psv(columns, c["control"]), "jsonl": lambda v: (x for (x,) in v), "json_array": _array}[c["format"]]
        landed(rows, lines, at(entity))
        entry = {"entity": entity, "records": rows.count()}
        if c["control"]:
            amount = F.get_json_object("payload", "$.amount.value") if "payload" in columns else F.col(c["control"])
            entry |= {"control_field": c["control"], "control_total": str(rows.agg(F.sum(amount.try_cast("decimal(18,2)"))).first()[0] or 0)}
        return entry

    ship(spark)
    found: dict[str, list[dict]] = {}
    with ThreadPoolExecutor(4) as pool:  # many are one task each
        for entity, entry in zip(frames, pool.map(write, frames, frames.values()), strict=True):
            found.setdefault(CONTRACTS[entity]["source"], []).append(entry)
    for source, entities in found.items():
        _manifest(spark, f"{landing}/{source}/{DAY}", source, entities)


_STAGES = ("bronze", "silver", "mdm", "gold", "recon")
_houses: dict[tuple[str, str], tuple[Lakehouse, list[str]]] = {}


def _house(spark: SparkSession, sf_dir: str, stage: str) -> Lakehouse:
    """The batch after a stage at least: those up to it that didn't run yet run now."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _houses:
        top = relational.work_folder(spark, "bank")
        land(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"), f"{top}/landing")
        _houses[key] = Lakehouse(spark, f"{top}/warehouse", f"{top}/landing"), []
    house, done = _houses[key]
    for s in _STAGES[len(done) : _STAGES.index(stage) + 1]:
        house.run(DAY, (s,))
        done.append(s)
    return house


def add(oracle: str, stage: str):
    """A query of what the batch has written after a stage."""

    def register(plan: Callable[[Lakehouse], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(_house(spark, sf_dir, stage))

        run.__name__ = plan.__name__
        QUERIES[plan.__name__], ORACLES[plan.__name__] = run, oracle
        return plan

    return register


_TWICE = "right(CAST(10000000000000 + c_custkey AS VARCHAR), 2) = '03'"


@add("""SELECT 'cbs_branch' AS entity, count(*) AS row_count FROM nation UNION ALL SELECT 'cbs_product', 4 UNION ALL SELECT 'cbs_customer', count(*) FROM customer WHERE c_custkey % 50 <> 7 UNION ALL SELECT 'cbs_account', count(*) FROM customer
    UNION ALL SELECT 'cbs_eod_balance', count(*) FROM customer WHERE c_custkey % 97 <> 5 UNION ALL SELECT 'lms_borrower', count(*) FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'lms_loan', count(*) FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT 'lms_repayment', count(*) FROM customer WHERE c_custkey % 6 = 0 UNION ALL SELECT 'crm_customer', count(*) FROM customer WHERE c_custkey % 4 = 1 UNION ALL SELECT 'aml_watchlist', count(*) FROM supplier UNION ALL SELECT 'doc_document', 1
    UNION ALL SELECT 'pay_transaction', count(*) FROM orders WHERE o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 1""", stage="silver")
def batch_silver(house):
    names = ["cbs_branch", "cbs_product", "cbs_customer", "cbs_account", "cbs_eod_balance", "lms_borrower", "lms_loan", "lms_repayment", "crm_customer", "aml_watchlist", "doc_document", "pay_transaction"]
    counts = [house.read("silver", n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("entity"), "row_count") for n in names]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@add(f"""SELECT 'cbs_customer' AS entity, 'last_name:REQUIRED' AS reasons, count(*) AS row_count FROM customer WHERE c_custkey % 50 = 7 HAVING count(*) > 0
    UNION ALL SELECT 'cbs_eod_balance', 'ledger_balance:NOT_DECIMAL', sum(CASE WHEN {_TWICE} THEN 2 ELSE 1 END)::BIGINT FROM customer WHERE c_custkey % 97 = 5 HAVING count(*) > 0
    UNION ALL SELECT 'pay_transaction', reasons, count(*) FROM (SELECT array_to_string(list_filter([CASE WHEN o_orderkey % 101 = 0 THEN 'channel:NOT_ALLOWED' END, CASE WHEN o_orderkey % 103 = 1 THEN 'currency:NOT_ALLOWED' END], lambda x: x IS NOT NULL), ',') AS reasons FROM orders) x WHERE reasons <> '' GROUP BY reasons""", stage="bronze")
def batch_quarantine(house):
    return house.read("bronze", "quarantine").groupBy(F.col("_entity").alias("entity"), F.array_join("_reject_reasons", ",").alias("reasons")).agg(F.count("*").alias("row_count"))


@add("""SELECT 'ACC:CBS:' || CAST(10000000000000 + c_custkey AS VARCHAR) AS account_key, CASE c_custkey % 3 WHEN 0 THEN 'SAVINGS' WHEN 1 THEN 'CURRENT' ELSE 'TERM' END AS deposit_type, c_custkey % 3 < 2 AS is_casa, 'BR' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS branch_code, CAST(round(c_acctbal * 100) AS BIGINT) AS cents, c_custkey % 50 <> 7 AS known_party, true AS linked FROM customer WHERE c_custkey % 97 <> 5""", stage="gold")
def batch_deposit_fact(house):
    return house.read("gold", "fact_deposit_balance_daily").select("account_key", "deposit_type", "is_casa", "branch_code", (F.col("balance_inr") * 100).cast("bigint").alias("cents"), (F.col("party_id") != "UNKNOWN").alias("known_party"), (F.col("party_sk").isNotNull() & F.col("account_sk").isNotNull()).alias("linked"))


@add("""SELECT loan_key, sma_status, asset_class, asset_class <> 'STANDARD' AS is_npa, CASE WHEN asset_class <> 'STANDARD' THEN DATE '2024-01-15' - CAST(dpd - 90 AS INTEGER) END AS npa_since, cents,
    CAST(CASE asset_class WHEN 'STANDARD' THEN 0.004 WHEN 'SUBSTANDARD' THEN 0.15 WHEN 'DOUBTFUL_1' THEN 0.25 WHEN 'DOUBTFUL_2' THEN 0.4 ELSE 1.0 END AS DOUBLE) AS provision_rate
    FROM (SELECT 'LN:LMS:LN' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS loan_key, c_custkey % 1800 AS dpd, (100000 + c_custkey) * 100 + 25 AS cents, CASE WHEN c_custkey % 1800 = 0 THEN 'REGULAR' WHEN c_custkey % 1800 <= 30 THEN 'SMA-0' WHEN c_custkey % 1800 <= 60 THEN 'SMA-1' WHEN c_custkey % 1800 <= 90 THEN 'SMA-2' ELSE 'NPA' END AS sma_status,
    CASE WHEN c_custkey % 33 = 0 THEN 'LOSS' WHEN c_custkey % 1800 <= 90 THEN 'STANDARD' WHEN c_custkey % 1800 <= 455 THEN 'SUBSTANDARD' WHEN c_custkey % 1800 <= 820 THEN 'DOUBTFUL_1' WHEN c_custkey % 1800 <= 1550 THEN 'DOUBTFUL_2' ELSE 'DOUBTFUL_3' END AS asset_class FROM customer WHERE c_custkey % 3 = 0) x""", stage="gold")
def batch_loan_fact(house):
    return house.read("gold", "fact_loan_position_daily").select("loan_key", "sma_status", "asset_class", "is_npa", "npa_since", (F.col("principal_outstanding") * 100).cast("bigint").alias("cents"), F.col("provision_rate").cast("double").alias("provision_rate"))


@add("""SELECT 'ACC:CBS:' || CAST(10000000000000 + o_custkey AS VARCHAR) AS account_key, CASE WHEN o_orderkey % 2 = 0 THEN 'DR' ELSE 'CR' END AS direction, count(*) AS payments, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, CAST(count(*) * 500 AS BIGINT) AS fee_cents, CAST(sum(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS on_us
    FROM orders WHERE o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 1 GROUP BY 1, 2""", stage="gold")
def batch_payment_fact(house):
    return house.read("gold", "fact_payment").groupBy("account_key", "direction").agg(F.count("*").alias("payments"), (F.sum("amount") * 100).cast("bigint").alias("cents"), F.round(F.sum("fee_amount") * 100).cast("bigint").alias("fee_cents"), F.count_if("is_on_us").alias("on_us"))


@add("""WITH r AS (SELECT c_custkey, 'CBS' AS s FROM customer WHERE c_custkey % 50 <> 7 UNION ALL SELECT c_custkey, 'LMS' FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'CRM' FROM customer WHERE c_custkey % 4 = 1)
    SELECT source_systems, count(*) AS parties FROM (SELECT c_custkey, array_to_string(list_sort(list(s)), ',') AS source_systems FROM r GROUP BY c_custkey) x GROUP BY source_systems""", stage="mdm")
def batch_parties(house):
    """Records of one person in several systems are one party, and of different persons never."""
    return house.read("mdm", "golden_party").groupBy("source_systems").agg(F.count("*").alias("parties"))


@add("""SELECT 'ACC:CBS:' || CAST(10000000000000 + c_custkey AS VARCHAR) AS account_key, 'PRIMARY' AS role, 'DEPOSITS' AS domain, c_custkey % 50 <> 7 AS known_party FROM customer UNION ALL SELECT 'LN:LMS:LN' || lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 'BORROWER', 'LENDING', true FROM customer WHERE c_custkey % 3 = 0""", stage="gold")
def batch_bridge(house):
    return house.read("gold", "bridge_party_account").select("account_key", "role", "domain", (F.col("party_id") != "UNKNOWN").alias("known_party"))


@add("""SELECT 'dim_account' AS dimension, 'NEW' AS change_reason, CAST(1 AS INTEGER) AS version, count(*) AS row_count FROM customer UNION ALL SELECT 'dim_loan', 'NEW', 1, count(*) FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT 'dim_party', 'NEW', 1, 1 + count(*) FROM customer WHERE c_custkey % 50 <> 7 OR c_custkey % 3 = 0 OR c_custkey % 4 = 1""", stage="gold")
def batch_dimensions(house):
    counted = lambda n: house.read("gold", n).where("is_current").groupBy(F.lit(n).alias("dimension"), "change_reason", "version").agg(F.count("*").alias("row_count"))
    return counted("dim_account").unionByName(counted("dim_loan")).unionByName(counted("dim_party"))


@add("""SELECT 'WL' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS entry_id, 'AML-WL-01' AS rule_code, 'CRITICAL' AS severity, true AS is_new FROM supplier WHERE s_suppkey % 5 = 0 AND s_suppkey % 10 <> 0 AND s_suppkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 50 <> 7 OR c_custkey % 3 = 0)""", stage="gold")
def batch_watchlist(house):
    return house.read("gold", "fact_aml_alert").where("subject_type = 'PARTY'").select(F.col("evidence").alias("entry_id"), "rule_code", "severity", "is_new")


@add("""WITH e(entity) AS (VALUES ('cbs_branch'), ('cbs_product'), ('cbs_customer'), ('cbs_account'), ('cbs_eod_balance'), ('lms_borrower'), ('lms_loan'), ('lms_repayment'), ('crm_customer'), ('aml_watchlist'), ('doc_document'), ('pay_transaction')),
    k(entity) AS (VALUES ('cbs_eod_balance'), ('lms_loan'), ('lms_repayment'), ('pay_transaction')), p(entity) AS (VALUES ('cbs_eod_balance'), ('lms_borrower'), ('lms_loan'), ('lms_repayment'), ('aml_watchlist')), f(fact) AS (VALUES ('fact_deposit_balance_daily'), ('fact_loan_position_daily'), ('fact_payment'))
    SELECT 'bronze' AS layer, 'batch_status' AS check_name, 'MATCHED' AS status UNION ALL SELECT 'bronze', 'load_status ' || entity, 'MATCHED' FROM e UNION ALL SELECT 'bronze', 'landed_records ' || entity, 'MATCHED' FROM e
    UNION ALL SELECT 'bronze', 'control_total ' || entity, 'MATCHED' FROM k UNION ALL SELECT 'bronze', 'file_trailer ' || entity, 'MATCHED' FROM p
    UNION ALL SELECT 'silver', 'silver_records ' || entity, CASE entity WHEN 'cbs_eod_balance' THEN 'EXPLAINED' ELSE 'MATCHED' END FROM k UNION ALL SELECT 'silver', 'silver_total ' || entity, CASE entity WHEN 'cbs_eod_balance' THEN 'EXPLAINED' ELSE 'MATCHED' END FROM k
    UNION ALL SELECT 'gold', c || fact, 'MATCHED' FROM f, (VALUES ('gold_records '), ('gold_total '), ('dimension_link ')) x(c) UNION ALL SELECT 'gold', 'party_resolved fact_deposit_balance_daily', 'EXPLAINED'""", stage="recon")
def batch_recon(house):
    """Every check of the layers against each other; what was left out on purpose is explained."""
    return house.read("ref", "recon_results").select("layer", "check_name", "status")


@add("""SELECT 'cbs_customer' AS entity, 'COMMITTED' AS status, count(*) AS rows_in, count(*) FILTER (c_custkey % 50 <> 7) AS rows_ok, count(*) FILTER (c_custkey % 50 = 7) AS rows_bad FROM customer
    UNION ALL SELECT 'pay_transaction', 'COMMITTED', count(*), count(*) FILTER (o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 1), count(*) FILTER (o_orderkey % 101 = 0 OR o_orderkey % 103 = 1) FROM orders""", stage="bronze")
def batch_load_audit(house):
    return house.audit().where("stage = 'bronze' AND entity IN ('cbs_customer', 'pay_transaction')").select("entity", "status", "rows_in", "rows_ok", "rows_bad")

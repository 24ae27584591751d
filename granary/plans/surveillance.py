"""Alert rules, reconciliation, audit trails, masks, profiles and visuals on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aml, audit, governance, reconcile
from ..operators.relational import duplicates, latest
from . import semantic
from .registry import Registry

_r = Registry()
QUERIES, ORACLES, add = _r.queries, _r.oracles, _r.add

#: Events as payments: purchases are cash credits, views debits, all of the event's day.
STRUCTURING = aml.STRUCTURING | {"band_from": 20.0, "band_to": 100.0, "min_count": 2}
PASS_THROUGH = aml.PASS_THROUGH | {"min_credits": 2, "min_credit_total": 20.0}


def payments(t):
    kind = F.col("event_type")
    return t("events").select(
        F.lpad(F.col("event_id").cast("string"), 8, "0").alias("msg_id"),
        F.col("user_id").alias("account_key"),
        F.col("ts").cast("date").alias("business_date"),
        F.col("ts").cast("date").alias("value_date"),
        F.when(kind == "purchase", "CR").when(kind == "view", "DR").otherwise("NA").alias("direction"),
        F.when(kind == "purchase", "CASH").otherwise("UPI").alias("channel"),
        F.lit("SETTLED").alias("status"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )


def _day(t):
    return str(t("events").agg(F.max(F.col("ts").cast("date"))).first()[0])


_PAY_SQL = "SELECT lpad(CAST(event_id AS VARCHAR), 8, '0') AS msg_id, user_id AS account_key, CAST(ts AS DATE) AS day, event_type, CAST(value AS DECIMAL(18,2)) AS amount FROM events"
_STR_SQL = f"""SELECT account_key, COUNT(*) AS hits, CAST(SUM(amount) AS DOUBLE) AS amount, MIN(day) AS first_date, MAX(day) AS last_date, array_to_string(list_slice(list_sort(list(msg_id)), 1, 20), ',') AS evidence FROM ({_PAY_SQL}) p
    WHERE event_type = 'purchase' AND amount BETWEEN 20 AND 100 AND day IN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 3) GROUP BY account_key HAVING COUNT(*) >= 2"""


@add(_STR_SQL)
def aml_structuring(t):
    return aml.structuring(payments(t), _day(t), STRUCTURING).select("account_key", "hits", F.col("amount").cast("double").alias("amount"), "first_date", "last_date", "evidence")


@add(f"""SELECT account_key, hits, CAST(credited AS DOUBLE) AS amount, CAST(sent AS DOUBLE) AS sent FROM (SELECT account_key, SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS hits, SUM(CASE WHEN event_type = 'purchase' THEN amount END) AS credited, SUM(CASE WHEN event_type = 'view' THEN amount END) AS sent
    FROM ({_PAY_SQL}) p WHERE event_type IN ('purchase', 'view') GROUP BY account_key) x WHERE hits >= 2 AND credited >= 20 AND sent >= 0.9 * credited""")
def aml_pass_through(t):
    """All of an account's events as one date's, so that some take and send enough."""
    one_date = payments(t).withColumn("business_date", F.to_date(F.lit("2024-01-15")))
    return aml.pass_through(one_date, "2024-01-15", PASS_THROUGH).select("account_key", "hits", F.col("amount").cast("double").alias("amount"), F.col("sent").cast("double").alias("sent"))


@add("""SELECT c_custkey AS party_id, s_suppkey AS entry_id, CASE WHEN c_custkey % 50 = s_suppkey % 50 AND c_custkey % 3 = 0 THEN 'AML-WL-01' ELSE 'AML-WL-02' END AS rule_code FROM customer JOIN supplier ON s_suppkey % 4 <> 0
    WHERE (c_custkey % 3 = 0 AND c_custkey % 50 = s_suppkey % 50) OR (c_nationkey = s_nationkey AND c_custkey // 100 = s_suppkey)""")
def aml_watchlist(t):
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    parties = t("customer").select(k.alias("party_id"), F.when(k % 3 == 0, F.concat(F.lit("PAN"), (k % 50).cast("string"))).alias("pan_std"), F.concat(F.lit("N"), "c_nationkey").alias("name_key"), F.floor(k / 100).alias("dob"))
    entries = t("supplier").select(s.alias("entry_id"), F.concat(F.lit("PAN"), (s % 50).cast("string")).alias("pan_std"), F.concat(F.lit("N"), "s_nationkey").alias("name_key"), s.alias("dob"), F.to_date(F.lit("2024-01-01")).alias("listed_on"), F.when(s % 4 == 0, F.to_date(F.lit("2024-01-10"))).alias("delisted_on"))
    return aml.watchlist(parties, entries, "2024-01-15").select("party_id", "entry_id", "rule_code")


@add(f"""SELECT a.account_key AS subject, substr(sha256('AML-STR-01|' || CAST(a.account_key AS VARCHAR) || '|' || CAST((SELECT MAX(CAST(ts AS DATE)) FROM events) AS VARCHAR)), 1, 16) AS alert_id, a.account_key % 2 <> 0 AS is_new FROM ({_STR_SQL}) a""")
def aml_is_new(t):
    day = _day(t)
    alerts = aml.structuring(payments(t), day, STRUCTURING).withColumnRenamed("account_key", "subject")
    earlier = t("events").where("user_id % 2 = 0").select(F.lit("AML-STR-01").alias("rule_code"), F.col("user_id").alias("subject"))
    return aml.with_novelty(alerts, earlier).select("subject", aml.alert_id(F.col("rule_code"), F.col("subject").cast("string"), F.lit(day)).alias("alert_id"), "is_new")


@add("""SELECT 'orders' AS check_name, CAST((SELECT COUNT(*) FROM orders) AS DOUBLE) AS expected, CAST((SELECT COUNT(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)) AS DOUBLE) AS actual,
    CASE WHEN (SELECT COUNT(*) FROM orders) = (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)) THEN 'MATCHED' ELSE 'MISMATCH' END AS status""")
def recon_counts(t):
    used = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").agg(F.count("*"))
    return reconcile.check("orders", t("orders").agg(F.count("*")), used).select("check_name", "expected", "actual", "status")


@add("""SELECT n_name AS nation, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS expected, CAST(SUM(CAST(l AS DECIMAL(18,2))) AS DOUBLE) AS actual, CASE WHEN abs(round(CAST(SUM(CAST(l AS DECIMAL(18,2))) AS DOUBLE) - CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2)) <= 0.005 THEN 'MATCHED' ELSE 'MISMATCH' END AS status
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey LEFT JOIN (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS l FROM lineitem GROUP BY l_orderkey) x ON l_orderkey = o_orderkey GROUP BY n_name""")
def recon_totals(t):
    lines = t("lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("l"))
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    sums = rows.groupBy(F.col("n_name").alias("nation")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("expected"), F.sum("l").cast("double").alias("actual"))
    return sums.withColumn("status", reconcile.status(F.col("expected"), F.col("actual"), F.lit(0.0)))


@add("""SELECT 'lineitem' AS check_name, CAST(COUNT(*) AS DOUBLE) AS expected, CAST(COUNT(DISTINCT (l_orderkey, l_linenumber)) AS DOUBLE) AS actual, CAST(COUNT(DISTINCT (l_orderkey, l_linenumber)) - COUNT(*) AS DOUBLE) AS explained, CASE WHEN COUNT(*) = COUNT(DISTINCT (l_orderkey, l_linenumber)) THEN 'MATCHED' ELSE 'EXPLAINED' END AS status FROM lineitem""")
def recon_explained(t):
    """Fewer rows after deduplication, explained by the duplicates that were left out."""
    rows = t("lineitem")
    kept = rows.dropDuplicates(["l_orderkey", "l_linenumber"]).agg(F.count("*"))
    out = duplicates(rows, ["l_orderkey", "l_linenumber"], [F.col("l_partkey")]).agg(-F.count("*"))
    return reconcile.check("lineitem", rows.agg(F.count("*")), kept, out)


@add("SELECT batch_id, stage, entity, status FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, stage, entity ORDER BY ts DESC) AS rn FROM (SELECT strftime(ts, '%Y%m%d') AS batch_id, CASE WHEN user_id % 2 = 0 THEN 'bronze' ELSE 'silver' END AS stage, CAST(user_id AS VARCHAR) AS entity, CASE event_type WHEN 'click' THEN 'STARTED' WHEN 'error' THEN 'FAILED' ELSE 'COMMITTED' END AS status, ts FROM events) e WHERE status <> 'STARTED') x WHERE rn = 1")
def last_attempt(t):
    return audit.last_attempts(_audit(t)).select("batch_id", "stage", "entity", "status")


def _audit(t):
    kind = F.col("event_type")
    return t("events").select(F.date_format("ts", "yyyyMMdd").alias("batch_id"), F.when(F.col("user_id") % 2 == 0, "bronze").otherwise("silver").alias("stage"), F.col("user_id").cast("string").alias("entity"), F.when(kind == "click", "STARTED").when(kind == "error", "FAILED").otherwise("COMMITTED").alias("status"), F.col("ts").alias("at"))


@add("SELECT batch_id, stage, status FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, stage ORDER BY ts DESC, event_id DESC) AS rn FROM (SELECT event_id, strftime(ts, '%Y%m%d') AS batch_id, CASE WHEN user_id % 2 = 0 THEN 'bronze' ELSE 'silver' END AS stage, CASE event_type WHEN 'click' THEN 'STARTED' WHEN 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS status, ts FROM events) e) x WHERE rn = 1")
def stage_gate(t):
    """The state that the gate of the next stage looks at."""
    return audit.stage_status(_audit(t).withColumn("status", F.when(F.col("status") == "COMMITTED", "COMPLETED").otherwise(F.col("status"))))


_AUDIT_SQL = "SELECT strftime(ts, '%Y%m%d') AS batch_id, CASE WHEN user_id % 2 = 0 THEN 'bronze' ELSE 'silver' END AS stage, CAST(user_id AS VARCHAR) AS entity, CASE event_type WHEN 'click' THEN 'STARTED' WHEN 'error' THEN 'FAILED' ELSE 'COMMITTED' END AS status, ts FROM events"
_RUNS_SQL = f"""SELECT batch_id, stage, entity, arg_max(status, ts) AS status FROM ({_AUDIT_SQL}) e
    WHERE status <> 'STARTED' AND ts >= (SELECT max(s.ts) FROM ({_AUDIT_SQL}) s WHERE s.batch_id = e.batch_id AND s.stage = e.stage AND s.status = 'STARTED') GROUP BY ALL"""


@add(_RUNS_SQL)
def latest_run(t):
    return audit.latest_runs(_audit(t))


@add(f"""WITH last AS (SELECT max(strftime(ts, '%Y%m%d')) AS b FROM events), runs AS (SELECT entity, status FROM ({_RUNS_SQL}) r WHERE batch_id = (SELECT b FROM last) AND stage = 'bronze'),
    wanted AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS entity FROM events WHERE user_id % 2 = 0), ok AS (SELECT 'load_status ' || wanted.entity AS check_name, CASE WHEN runs.status = 'COMMITTED' THEN 1.0 ELSE 0.0 END AS actual FROM wanted LEFT JOIN runs ON runs.entity = wanted.entity)
    SELECT check_name, CAST(1 AS DOUBLE) AS expected, CAST(actual AS DOUBLE) AS actual, CASE actual WHEN 1 THEN 'MATCHED' ELSE 'MISMATCH' END AS status FROM (SELECT * FROM ok UNION ALL SELECT 'batch_status', 0.0) x""")
def recon_load_status(t):
    """Every user as an entity that the last date's bronze run should have loaded; the run itself has no end."""
    last = t("events").agg(F.max(F.date_format("ts", "yyyyMMdd"))).first()[0]
    runs = audit.latest_runs(_audit(t)).where((F.col("batch_id") == last) & (F.col("stage") == "bronze")).select("entity", "status")
    wanted = t("events").where("user_id % 2 = 0").select(F.col("user_id").cast("string").alias("entity")).distinct()
    return reconcile.run_checks(runs, wanted).select("check_name", "expected", "actual", "status")


@add("""WITH l AS (SELECT l_orderkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) = 1 AS first FROM lineitem)
    SELECT 'first lines' AS check_name, sum(c) / 100.0 AS expected, (sum(c) FILTER (first)) / 100.0 AS actual, -(sum(c) FILTER (NOT first)) / 100.0 AS explained, 'EXPLAINED' AS status FROM l""")
def recon_silver_total(t):
    """Only an order's first line stays; what the others had explains the difference."""
    rows = t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    return reconcile.deduplicated_total("first lines", rows, latest(rows, ["l_orderkey"], [F.col("l_linenumber"), F.col("amount")]), ["l_orderkey"], [F.col("l_linenumber"), F.col("amount")], "amount")


@add(f"""WITH alerts AS (SELECT account_key FROM ({_STR_SQL}) a), planted AS (SELECT DISTINCT user_id FROM events WHERE user_id % 3 = 0)
    SELECT 'truth_planted' AS check_name, CAST((SELECT count(*) FROM planted) AS DOUBLE) AS expected, CAST((SELECT count(*) FROM planted WHERE user_id IN (SELECT account_key FROM alerts)) AS DOUBLE) AS actual
    UNION ALL SELECT 'truth_unexpected', 0.0, CAST((SELECT count(*) FROM alerts WHERE account_key % 3 <> 0) AS DOUBLE)""")
def recon_truth(t):
    """As if every third user's structuring had been planted."""
    alerts = aml.structuring(payments(t), _day(t), STRUCTURING).select("rule_code", F.col("account_key").alias("subject"))
    planted = t("events").where("user_id % 3 = 0").select(F.lit(STRUCTURING["rule_code"]).alias("rule_code"), F.col("user_id").alias("subject")).distinct()
    return reconcile.truth_checks(planted, F.lit(True), alerts, F.lit(True)).select("check_name", "expected", "actual")


@add(r"""SELECT c_custkey, regexp_replace(regexp_replace(substr(c_name, 1, length(c_name) - 4), '[A-Za-z]', 'x', 'g'), '[0-9]', 'n', 'g') || substr(c_name, length(c_name) - 3) AS last_4, sha256(c_name) AS hashed, regexp_replace(regexp_replace(c_name, '[A-Za-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS redacted, NULL::VARCHAR AS nothing FROM customer""")
def mask_columns(t):
    rows = t("customer").select("c_custkey", *[F.col("c_name").alias(c) for c in ("last_4", "hashed", "redacted", "nothing")])
    return governance.secured(rows, {"last_4": "LAST_4", "hashed": "HASH", "redacted": "REDACT", "nothing": "NULL"})


@add("SELECT o_orderkey, date_trunc('year', o_orderdate)::DATE AS year_only FROM orders")
def mask_year(t):
    return governance.secured(t("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("year_only")), {"year_only": "YEAR"})


@add("""SELECT column_name, tag, share, score FROM (SELECT 'c_name' AS column_name, 'NAME' AS tag, round(avg(CASE WHEN regexp_matches(c_name, '^Customer#[0-9]+$') THEN 1.0 ELSE 0.0 END), 6) AS share, round(70 * avg(CASE WHEN regexp_matches(c_name, '^Customer#[0-9]+$') THEN 1.0 ELSE 0.0 END) + 30, 1) AS score FROM customer) x WHERE score >= 70
    UNION ALL SELECT 'c_mktsegment', 'SEGMENT', round(avg(CASE WHEN regexp_matches(c_mktsegment, '^[A-Z]+$') THEN 1.0 ELSE 0.0 END), 6), round(80 * avg(CASE WHEN regexp_matches(c_mktsegment, '^[A-Z]+$') THEN 1.0 ELSE 0.0 END) + 20, 1) FROM customer""")
def profiler_score(t):
    rules = {"NAME": {"pattern": "^Customer#[0-9]+$", "name": "name", "value_weight": 70}, "SEGMENT": {"pattern": "^[A-Z]+$", "name": "segment", "value_weight": 80}}
    return governance.profile(t("customer").select("c_name", "c_mktsegment"), rules)


_VISUAL = semantic.visual_sql("{npa}", {"region": "[region]", "asset_class": "[asset_class]"}, {"gross": "ROUND(SUM([gross_npa]) / 100000, 2)", "loans": "SUM([loans])"}, ["[gross_npa] > 0"])


@add()
def visual_query(t):
    tables = {n: t(n) for n in semantic.TABLES}
    view = semantic.run(t("region").sparkSession, "npa_breakdown", tables)
    return view.sparkSession.sql(_VISUAL, npa=view)


@add("SELECT DISTINCT CAST(user_id AS VARCHAR) AS entity FROM events WHERE event_type IN ('view', 'purchase', 'signup') AND event_id % 3000 <> 7 AND ts > (SELECT max(ts) FROM events WHERE event_id % 3000 = 7)")
def resume_skips(t):
    """Every user as an entity of one stage that completed now and then: those committed since needn't run again."""
    status = F.when(F.col("event_id") % 3000 == 7, "COMPLETED").when(F.col("event_type").isin("view", "purchase", "signup"), "COMMITTED").otherwise("FAILED")
    trail = t("events").select(F.lit("B1").alias("batch_id"), F.lit("bronze").alias("stage"), F.col("user_id").cast("string").alias("entity"), status.alias("status"), F.col("ts").alias("at"))
    return audit.resume_set(trail, "B1", "bronze")
